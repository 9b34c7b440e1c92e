import math

import numpy as np
import pytest

from encore.llm import maxscore
from encore.llm.maxscore import integer_vectors, top_k
from encore.llm.queries import QUERIES
from encore.sources.tables import read_table

VEC = "vec_id long, embedding array<float>, label int"


def plain(rows, k, is_query):
    vecs = {}
    for i, v, *_ in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [math.floor(1024 * float(np.float32(x))) for x in v]
        vecs[i] = min(vecs.get(i, w), w)
    out = []
    for q, a in vecs.items():
        if is_query(q):
            best = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in vecs.items() if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def got(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


def test_query_on_all_vectors(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in read_table(spark, sf, "embeddings").collect()]
    assert got(QUERIES["op4_maxscore_top_k"](spark, sf)) == plain(rows, 10, lambda q: q % 100 == 0)


@pytest.mark.parametrize("block,cell", [(7, 20), (1024, 8192)])
def test_edge_cases_and_pruning(spark, frame, monkeypatch, block, cell):
    monkeypatch.setattr(maxscore, "BLOCK", block)
    monkeypatch.setattr(maxscore, "CANDIDATES", cell)
    monkeypatch.setattr(maxscore, "QUERIES", 3)
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.2, 6) * (rng.random(6) < 0.6)], 0) for i in range(150)]
    rows += [(200 + i, rows[5][1], 0) for i in range(12)]  # ties
    rows += [(300, None, 0), (301, [], 0), (302, [1.0, None], 0), (303, [float("nan")] * 6, 0), (304, [float("inf")] * 6, 0),
             (None, [1.0] * 6, 0), (305, [0.0] * 6, 0), (306, [1.0, 2.0], 0), (5, rows[5][1], 0), (7, [9.0] * 6, 0), (400, [-3.0] * 6, 0)]
    df = frame(rows, VEC).selectExpr("*", "1 as v", "2 as rank", "3 as score")
    v = integer_vectors(df)
    assert got(top_k(v.where("vec_id % 5 = 0"), v, 4)) == plain(rows, 4, lambda q: q % 5 == 0)


def test_few_rows_and_empty_tables(spark, frame):
    one = integer_vectors(frame([(100, [0.5], 0)], VEC))
    none = integer_vectors(frame([], VEC))
    assert got(top_k(one, one)) == [] and got(top_k(one, none)) == [] and got(top_k(none, one)) == []
    two = integer_vectors(frame([(100, [0.5], 0), (1, [-0.5], 0)], VEC))
    assert got(top_k(two.where("vec_id = 100"), two)) == [(100, 1, 1, -512 * 512)]


def test_probing_prunes():
    """With a score to beat, the essential lists alone decide which vectors are looked at."""
    rng = np.random.default_rng(1)
    rows = rng.integers(-400, 400, (2000, 16))
    index = maxscore.Index(np.arange(2000), rows)
    q = rng.integers(-400, 400, 16)
    score = rows @ q
    beat = int(np.sort(score)[-10])
    at, s = index.search(q, beat)
    assert set(at) == set(np.flatnonzero(score >= beat)) and (s == score[at]).all()


def test_a_known_score_leaves_out_only_lower_ones():
    """A score reached elsewhere drops what is below it and keeps what equals it; sparse and dense lists agree."""
    rng = np.random.default_rng(2)
    rows = rng.integers(-300, 300, (3000, 12)) * (rng.random((3000, 12)) < rng.random(12) * 0.5)
    qid, qs, ids = np.arange(5), rows[:5], np.arange(3000)
    free = maxscore.search_cell((qid, qs), (ids, rows), 4)
    kth = np.array([min(s for q, _, s in free if q == i) for i in qid], float)
    assert maxscore.search_cell((qid, qs), (ids, rows), 4, kth) == free
    above = maxscore.search_cell((qid, qs), (ids, rows), 4, kth + 1)
    assert above == [r for r in free if r[2] > kth[r[0]]]


def test_products_are_exact_for_large_components():
    big = np.array([[(1 << 28) + 1, 3], [-(1 << 28), 5]])
    assert (maxscore.products(big, big) == [[sum(int(x) * int(y) for x, y in zip(a, b, strict=True)) for b in big] for a in big]).all()
