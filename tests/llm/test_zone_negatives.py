import math

import numpy as np
import pytest

from encore.llm import zone_negatives as Z
from encore.llm.queries import ORACLE_SQL, QUERIES
from encore.sources.tables import read_table

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, anchors, n_pos=5, n_neg=10):
    """rows: {id: (label, vector)}."""
    out = []
    for a in sorted(anchors & set(rows)):
        label, v = rows[a]
        score = {i: sum(x * y for x, y in zip(v, w, strict=False)) for i, (_, w) in rows.items() if i != a}
        order = lambda ids: sorted(ids, key=lambda i: (-score[i], i))
        for p in order(i for i in score if rows[i][0] == label)[:n_pos]:
            fits = [i for i in score if rows[i][0] != label and 30 * score[p] <= 100 * score[i] <= 90 * score[p]]
            out += [(a, p, k + 1, n, score[p], score[n]) for k, n in enumerate(order(fits)[:n_neg])]
    return sorted(out)


def clean(rows, scale=256):
    fine = [(i, label, [math.floor(scale * x) for x in v]) for i, v, label in rows
            if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for i, label, v in sorted(fine):
        out.setdefault(i, (label, v))
    return out


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_query_on_all_vectors(spark):
    sf = "/root/testdata/sf0.01"
    rows = {}
    for r in read_table(spark, sf, "embeddings").collect():
        rows[r.vec_id] = ((r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, [math.floor(256 * float(x)) for x in r.embedding])
    want = plain(rows, {i for i in rows if i % 100 == 0})
    assert got(QUERIES["op11_zone_negatives"](spark, sf)) == want and len(want) > 100
    assert "op11_zone_negatives" in ORACLE_SQL


@pytest.mark.parametrize("block,group,cell,zones", [(1024, 4096, 64, 4096), (3, 2, 2, 4), (10, 5, 1, 2)])
def test_blocks_cells_and_zone_parts_change_nothing(frame, monkeypatch, block, group, cell, zones):
    for name, value in (("BLOCK", block), ("GROUP", group), ("CELL", cell), ("ZONES", zones)):
        monkeypatch.setattr(Z, name, value)
    rng = np.random.default_rng(block)
    centres = rng.normal(0, 1, (6, 7))
    rows = [(i, (centres[i % 6] + rng.normal(0, 0.4, 7)).tolist(), int(rng.integers(0, 3))) for i in range(150)]
    rows += [(1000 + i, rows[0][1], i % 4) for i in range(60)]  # one very common vector
    rows += [(2000, None, 1), (2001, [1.0, None, 1.0], 1), (2002, [math.nan] * 7, 1), (2003, [math.inf] * 7, 1), (2004, [1.0] * 7, None), (None, [1.0] * 7, 1),
             (2005, [], 1), (2006, [1.0, 1.0], 2), (2007, [0.0] * 7, 77), (5, rows[9][1], 0), (5, rows[5][1], 2)]
    df = frame(rows, SCHEMA).selectExpr("*", "'x' as v", "1 as place", "2 as block", "3 as low")
    vectors = Z.integer_rows(df)
    want = clean(rows)
    assert {r.vec_id: (r.label, list(r.v)) for r in vectors.collect()} == want
    asked = {i for i in want if i % 7 == 0 or i >= 1055}
    anchors = frame([(i,) for i in asked] * 2, "vec_id long")
    assert got(Z.mine(vectors, anchors)) == plain(want, asked)


def test_empty_tables(frame):
    none = Z.integer_rows(frame([], SCHEMA))
    assert Z.mine(none, none).count() == 0
    one = Z.integer_rows(frame([(1, [1.0, 2.0], 3)], SCHEMA))
    assert Z.mine(one, one).count() == 0 and Z.mine(one, none).count() == 0


def test_neighbours_on_the_curve_are_neighbours_in_space():
    for dims, bits in ((2, 4), (3, 3), (5, 2)):
        side = 1 << bits
        points = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), -1).reshape(-1, dims)
        at = Z.hilbert(points, bits)
        assert sorted(at.tolist()) == list(range(side ** dims))
        walk = points[np.argsort(at)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_bounds_hold():
    rng = np.random.default_rng(2)
    q, rows = rng.integers(-300, 300, (20, 9)).astype(float), rng.integers(-300, 300, (40, 9)).astype(float)
    least, most = Z.bounds(q, rows.min(0)[None], rows.max(0)[None])
    score = q @ rows.T
    assert (least[:, 0] <= score.min(1)).all() and (score.max(1) <= most[:, 0]).all()


def test_zone_maps_leave_blocks_unread(frame, monkeypatch):
    monkeypatch.setattr(Z, "BLOCK", 20)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(0, 0.1, 4) + 5 * np.eye(4)[i % 4]], i % 2) for i in range(800)]
    vectors = Z.integer_rows(frame(rows, SCHEMA))
    order, width = Z.curve_order(vectors)
    blocks, zones = Z.write_blocks(order, width)
    asked = order.where("vec_id in (0, 4, 8)")
    groups = Z.packed(asked, width, 4).selectExpr("block as grp", "ids", "labels", "vectors")
    need = Z._needed(Z._with_windows(groups, Z._own_floors(blocks, asked, width, 5)), zones, width, True)
    assert need.select("block").distinct().count() <= zones.count() / 3
