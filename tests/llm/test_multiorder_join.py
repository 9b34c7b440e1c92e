import itertools
import random

from encore.llm.graph import components
from encore.llm.multiorder_join import JoinParams, _apart, keep_one_per_group, near_duplicates
from encore.sources.tables import read_table
from llm.conftest import doc, prose

TO_LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text):
    import re
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(TO_LOWER))
    return {tuple(w)} if 0 < len(w) < 5 else set(zip(*(w[k:] for k in range(5)), strict=False))


def plain(docs):
    """{key: (size, least id)} of (key, id, text) by comparing all pairs."""
    sets = {k: shingles(t) for k, _, t in docs}
    group = {k: k for k, _, _ in docs}

    def top(x):
        while group[x] != x:
            x = group[x]
        return x
    for a, b in itertools.combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            group[top(a)] = top(b)
    least = {}
    for k, i, _ in docs:
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    return {k: (len(sets[k]), least.get(top(k))) for k, _, _ in docs}


def check(df, rows, params=JoinParams()):
    found = near_duplicates(df, params).collect()
    want = plain([(k, r[0], r[1]) for k, r in enumerate(rows)])
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == sorted(((rows[k][0], *v) for k, v in want.items()), key=str)


def edited(text, every, word):
    w = text.split()
    return " ".join(f"{word}{i}" if i % every == every - 1 else x for i, x in enumerate(w))


def test_all_documents_against_all_pairs(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(docs, rows)


def test_edge_cases(frame):
    base = prose(5, 400)
    rows = [doc(7, base), doc(3, base), doc(3, base), doc(9, base.upper()), doc(None, base), doc(20, edited(base, 60, "q")),
            doc(21, edited(base, 25, "r")), doc(30, None), doc(31, ""), doc(32, " \n"), doc(33, "Few words"), doc(34, "few  WORDS"),
            doc(35, "few words more"), doc(36, "É x"), doc(37, "é x"), doc(40, prose(6, 30000)), doc(41, prose(6, 30000) + " end"),
            doc(None, prose(8, 50)), doc(50, prose(9, 50)), doc(50, prose(10, 50)), doc(51, prose(10, 50) + " tail")]
    check(frame(rows), rows)


def test_exact_limit(frame):
    """Three of four shingles shared in the union is a link, one less is none."""
    a = "a b c d e f g"  # 3 shingles
    b = "a b c d e f g h"  # 4 shingles, 3 shared: 75 %
    c = "a b c d e f g h i j"  # 6 shingles: 4 of 6 with b
    rows = [doc(5, a), doc(4, b), doc(3, c)]
    check(frame(rows), rows)


def test_near_copies_of_a_common_passage_and_small_batches(frame):
    """Shingles common in a batch travel pre-aggregated; the result does not depend on batches."""
    passage = prose(11, 60)
    rows = [doc(i, f"{passage} {prose(100 + i, 30 if i % 3 else 2)}") for i in range(60)]
    rows += [doc(100 + i, edited(prose(12, 120), 30 + i, "z")) for i in range(40)]
    for p in (JoinParams(batch_tokens=500, common=3, pieces=3), JoinParams(pieces=1), JoinParams()):
        check(frame(rows), rows, p)


def test_pages_of_one_template(frame):
    """Pages share a template and differ in the rest: the lesser rests link, the greater ones do not, and a few copies of both."""
    template = prose(21, 100)
    rows = [doc(i, f"{template} {prose(300 + i, 5 + i)}") for i in range(60)]
    rows += [doc(100 + i, edited(f"{template} {prose(300 + 50 + i, 55 + i)}", 100, "v")) for i in range(8)]
    check(frame(rows), rows)


def test_second_round_pairs_against_all_pairs(spark):
    """Every pair of one list that positions and sizes allow, in different components, is formed, and no other."""
    rng = random.Random(4)
    rows = []
    for sig in range(300):
        n = rng.choice([rng.randint(1, 12), rng.randint(90, 130), rng.randint(500, 900)])
        m = rng.randint(-(-3 * n // 4), n)
        prefix = m - -(-75 * n // 100) + 1
        component = sig if rng.random() < 0.4 else -rng.randint(1, 3)
        rows += [(val, sig, n, m, pos, component) for pos, val in enumerate(rng.sample(range(40), min(prefix, 4)))]
    want = set()
    for a, b in itertools.combinations(rows, 2):
        if a[0] == b[0] and a[5] != b[5] and 100 * min(a[2], b[2]) >= 75 * max(a[2], b[2]) and \
                175 * min(a[3] - a[4], b[3] - b[4]) >= 75 * (a[2] + b[2]):
            want.add((min(a[1], b[1]), max(a[1], b[1])))
    got = [tuple(r) for r in _apart(spark.createDataFrame(rows, "val long, sig long, n long, m long, pos int, component long"), JoinParams()).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 100


def test_one_large_component_keeps_its_least_id(frame):
    """A component of many classes gets its id back over many salts."""
    base = prose(31, 200)
    rows = [doc(1000 - i, f"{base} end{i}") for i in range(150)]
    check(frame(rows), rows)


def test_keep_one(frame):
    base = prose(5, 100)
    rows = [doc(7, base), doc(3, base), doc(3, base), doc(9, base + " x"), doc(None, base), doc(30, None), doc(31, ""), doc(31, ""), doc(None, "a b")]
    df = frame(rows).selectExpr("*", "1 as _uid", "2 as row", "3 as sig")
    kept = keep_one_per_group(df)
    assert kept.columns == df.columns
    out = sorted(((r.doc_id, r.text, r._uid) for r in kept.collect()), key=str)
    assert out == sorted([(3, base, 1), (30, None, 1), (31, "", 1), (None, "a b", 1)], key=str)


def test_empty_table(frame):
    assert near_duplicates(frame([])).count() == 0 and keep_one_per_group(frame([])).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(50)] + [(200, 200), (300, None), (1, 0), (1, 0)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
