import re

import numpy as np
import pytest

from encore.llm.queries import MIX, QUERIES
from encore.llm.raking import MixTargets, mix, probabilities, rake, with_topics
from encore.sources.tables import read_table
from llm.conftest import doc

COLUMNS = "doc_id long, text string, source string, lang string, topic string, n_tokens long"
TARGETS = MixTargets({"a": 0.5, "b": 0.5}, {"x": 0.7, "y": 0.3}, {"p": 0.4, "q": 0.6}, other=0.1, budget=0.5)


def plain_rake(cells, targets, rounds=3000):
    """cells {(s, l, t): tokens}; textbook proportional fitting with dictionaries."""
    w = {c: v for c, v in cells.items() if v > 0}
    total = sum(w.values())
    w = {c: v / total for c, v in w.items()}
    for _ in range(rounds):
        for d, t in enumerate(targets):
            have = {}
            for c, v in w.items():
                have[c[d]] = have.get(c[d], 0) + v
            scale = sum(t.get(k, 0) for k in have)
            w = {c: v * t.get(c[d], 0) / scale / have[c[d]] for c, v in w.items()}
    return w


def test_rake_against_plain_version_and_marginals():
    rng = np.random.default_rng(2)
    tokens = rng.integers(1, 1000, (4, 3, 2)).astype(float)
    shares = [np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.5, 0.25, 0.25]), np.array([0.35, 0.65])]
    w = rake(tokens, [s.copy() for s in shares], 1e-13, 5000)
    for d, s in enumerate(shares):
        assert np.allclose(w.sum(tuple(i for i in range(3) if i != d)), s, atol=1e-9)
    want = plain_rake({i: float(v) for i, v in np.ndenumerate(tokens)}, [dict(enumerate(s)) for s in shares], 400)
    assert all(abs(w[i] - v) < 1e-9 for i, v in want.items())
    odds = np.log(w / tokens)  # one factor a dimension: no interaction is left
    assert np.allclose(odds[0, 0, 0] + odds[1, 1, 0], odds[0, 1, 0] + odds[1, 0, 0], atol=1e-6)


def test_probabilities_meet_the_budget():
    rng = np.random.default_rng(3)
    tokens, w = rng.integers(0, 100, 50).astype(float), rng.random(50) ** 4
    for budget in (0.01, 0.3, 0.7, 0.95, 1.0):
        p = probabilities(tokens, w / w.sum(), budget)
        assert ((p >= 0) & (p <= 1)).all() and p @ tokens == pytest.approx(budget * tokens.sum(), rel=1e-9)
        inner = (p < 1) & (tokens > 0)
        if inner.sum() > 1:
            c = (p * tokens / w)[inner]
            assert np.allclose(c, c[0])


def test_query_on_all_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in read_table(spark, sf, "documents").collect()}
    rows = QUERIES["op9_raked_mixture"](spark, sf).collect()
    assert len(rows) == len(docs)
    cells = {}
    for r in rows:
        assert r.n_tokens == len(re.findall("[^\x20\x09-\x0d]+", docs[r.doc_id].text)) and r.cell_source == docs[r.doc_id].source
        c = (r.cell_source, r.cell_lang, r.cell_topic)
        cells[c] = cells.get(c, 0) + r.n_tokens
    want = plain_rake(cells, [{**t, "other": MIX.other} for t in (MIX.source, MIX.lang, MIX.topic)])
    keys = sorted(want)
    p = dict(zip(keys, probabilities(np.array([cells[k] for k in keys], float), np.array([want[k] for k in keys]), MIX.budget), strict=True))
    assert all(abs(r.probability - p.get((r.cell_source, r.cell_lang, r.cell_topic), 1.0)) < 1e-6 for r in rows)
    kept, whole = sum(r.n_tokens for r in rows if r.sampled), sum(r.n_tokens for r in rows)
    assert abs(kept / whole - MIX.budget) < 0.08


def test_edge_cases(frame):
    rows = [(i, f"t{i}", "ab"[i % 2], "xy"[i % 3 == 0], "pq"[i % 5 == 0], 10 + i) for i in range(200)]
    rows += [(200, None, None, None, None, None), (201, "", "z", "x", "p", -5), (None, "n", "a", "x", "p", 3), (5, "t5", "b", "x", "q", 15), (202, "t", "a", "x", "p", 0)]
    df = frame(rows, COLUMNS).selectExpr("*", "'c' as cell_source", "2D as probability", "'no' as sampled", "7 as w")
    out = mix(df, TARGETS)
    got = out.collect()
    assert len(got) == len(rows) and set(df.columns) <= set(out.columns) and all(r.w == 7 for r in got)
    by = {r.doc_id: r for r in got}
    assert by[200].cell_source == by[200].cell_lang == by[200].cell_topic == "other" and by[200].probability == 1.0 and by[201].cell_source == "other"
    assert len({r.sampled for r in got if r.doc_id == 5}) == 1  # repeated rows share their lot
    again = mix(df.repartition(7), TARGETS).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(str(tuple(r)) for r in again)


def test_empty_tables_and_no_tokens(frame):
    assert mix(frame([], COLUMNS), TARGETS).count() == 0
    assert [r.sampled for r in mix(frame([(1, "a", "a", "x", "p", None)], COLUMNS), TARGETS).collect()] == [True]


def test_topics(frame):
    texts = [None, "", " \n", "plain words in a row here and there", "a | b | c", "a\nb\nc\nd", "*** $$$ %%% word", "x " * 100_000]
    got = {r.doc_id: (r.topic, r.n_tokens) for r in with_topics(frame([doc(i, t) for i, t in enumerate(texts)])).collect()}
    assert got == {0: ("empty", 0), 1: ("empty", 0), 2: ("empty", 0), 3: ("prose", 8), 4: ("table", 5), 5: ("list", 4), 6: ("markup", 4), 7: ("prose", 100_000)}
