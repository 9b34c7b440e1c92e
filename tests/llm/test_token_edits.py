import random

import public_tokenizers
import pytest

from encore.llm.queries import BYTE_RANKS, QUERIES
from encore.llm.token_edits import Counter, Tree, build_trees, count_edited, drawn_edits, read_ranks
from encore.sources.tables import read_table
from llm.conftest import doc, prose

RANKS = read_ranks(BYTE_RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def counter():
    return Counter(RANKS)


def applied(text, edits):
    for pos, removed, put in edits:
        pos = min(max(pos, 0), len(text))
        text = text[:pos] + put + text[min(pos + max(removed, 0), len(text)):]
    return text


def whole(counter, text):
    return len(counter.encoding.encode_ordinary(text)), len(counter.pattern.findall(text))


def test_random_edits_against_counting_anew(counter):
    rng = random.Random(7)
    parts = ["a", "b", "'", " ", "  ", "\n", " \n ", "1", "23", "é", "ll", "'s", "!", "漢", "\t", "the ", "\U0001F600"]
    draw = lambda n: "".join(rng.choice(parts) for _ in range(n))
    for round_ in range(1500):
        text = draw(rng.randrange(0, 600 if round_ % 40 == 0 else 40))
        tree = Tree.of(text, counter)
        for _ in range(5):
            e = (rng.randrange(-2, len(text) + 4), rng.choice([0, 0, 1, 3, 20, 500]), draw(rng.choice([0, 1, 2, 5, 700 if round_ % 100 == 0 else 1])))
            new, _ = tree.edit(text, *e, counter)
            text = applied(text, [e])
            assert new == text
            assert (tree.total, sum(len(x[0]) for x in tree.leaves), int(tree.chars[1])) == (*whole(counter, text), len(text))
            tree = Tree.unpack(tree.pack()) if rng.random() < 0.2 else tree


def test_only_the_region_is_encoded(counter):
    text = prose(1, 20_000)
    tree = Tree.of(text, counter)
    for k in range(50):
        text, n = tree.edit(text, 997 * k, 5, "new words", counter)
        assert 0 < n < 20
    assert tree.total == whole(counter, text)[0]


def test_query_against_counting_anew(spark, counter):
    sf = "/root/testdata/sf0.001"
    docs = read_table(spark, sf, "documents").withColumn("edits", drawn_edits())
    want = {r.doc_id: (whole(counter, r.text)[0], *whole(counter, applied(r.text, [tuple(e) for e in r.edits]))) for r in docs.collect()}
    rows = QUERIES["op3_edit_aware_counts"](spark, sf).collect()
    assert {r.doc_id: (r.n_tokens, r.n_tokens_edited, r.n_pieces) for r in rows} == want
    assert all(r.n_edits == 3 for r in rows)


def test_edge_cases(frame, counter):
    kind = "doc_id long, text string, edits array<struct<pos:long,removed:long,put:string>>, tree string, n_tokens string"
    rows = [(1, None, [(0, 1, "x")]), (2, "", [(5, 9, "put in")]), (3, "some text", None), (4, "some text", []), (5, "some text", [None, (None, None, None)]),
            (6, "some text", [(4, 100, "")]), (6, "some text", [(4, 100, "")]), (None, "x", [(-3, 1, "y")]), (7, "é" * 50_000 + " end", [(25_000, 3, " ")]),
            (8, "<|endoftext|> plain", [(0, 0, "<|endoftext|>")])]
    df = frame([(*r, "a", "b") for r in rows], kind)
    clean = lambda es: [(e[0] or 0, e[1] or 0, e[2] or "") for e in es or [] if e is not None]
    want = sorted(str((i, None, None) if t is None else (i, whole(counter, t)[0], whole(counter, applied(t, clean(es)))[0])) for i, t, es in rows)
    assert sorted(str((r.doc_id, r.n_tokens, r.n_tokens_edited)) for r in count_edited(df, RANKS).collect()) == want
    stored = build_trees(df, RANKS)
    assert stored.columns == ["doc_id", "text", "edits", "tree", "n_tokens"]
    again = count_edited(stored, RANKS, tree_col="tree", keep_text=True).collect()
    assert sorted(str((r.doc_id, r.n_tokens, r.n_tokens_edited)) for r in again) == want
    for r in again:
        assert r.text is None or Tree.unpack(r.tree).total == whole(counter, r.text)[0]


def test_empty_table(frame):
    df = frame([]).withColumn("edits", drawn_edits())
    assert count_edited(df, RANKS).count() == 0 and build_trees(frame([]), RANKS).count() == 0
    nulls = frame([doc(None, None)]).withColumn("edits", drawn_edits())
    assert count_edited(nulls, RANKS).first().n_tokens is None
