from encore.llm.preference import preference_examples, swapped_answers
from encore.llm.queries import ORACLE_SQL, QUERIES
from oracle_harness import compare, duck

TURNS = "pair_id long, side string, turn long, role string, text string"


def show(turns):
    return "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in turns)


def plain(rows):
    pairs = {}
    for p, side, turn, role, text, *_ in rows:
        if p is not None and side in ("chosen", "rejected"):
            own = pairs.setdefault(p, {"chosen": set(), "rejected": set()})
            own[side].add((-1 if turn is None else turn, role or "unknown" if role is None else role, "" if text is None else text))
    out = {}
    for p, own in pairs.items():
        c, r = ([x[1:] for x in sorted(own[s])] for s in ("chosen", "rejected"))
        n = 0
        while n < min(len(c), len(r)) and c[n] == r[n]:
            n += 1
        out[p] = (n, show(c[:n]), show(c[n:]), show(r[n:]), len(c) - n, len(r) - n)
    return out


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    name = "op1_preference_pairs"
    problems, n, m = compare(spark, duck(sf), QUERIES[name], ORACLE_SQL[name], sf)
    assert not problems and n == m > 0


def test_edge_cases(frame):
    long = "x" * 500_000
    rows = [(1, s, t, r, x) for s in ("chosen", "rejected") for t, r, x in ((0, "system", "be kind"), (1, "user", "hé"), (2, "assistant", "same"))]
    rows += [(1, "chosen", 3, "user", "more"), (1, "chosen", 4, "assistant", "good"), (1, "rejected", 3, "user", "more"), (1, "rejected", 4, "assistant", "bad"),
             (1, "rejected", 4, "assistant", "bad"),  # a repeated row
             (2, "chosen", 0, "user", None), (2, "rejected", 0, "user", ""), (3, "chosen", 0, "user", "only"), (4, "rejected", 0, None, long),
             (5, "chosen", 0, "user", "a"), (5, "rejected", 0, "user", "a"), (5, "rejected", 1, "assistant", "b"),
             (6, "chosen", None, "user", "first"), (6, "chosen", 0, "assistant", "z"), (6, "rejected", 0, "assistant", "z"),
             (None, "chosen", 0, "user", "lost"), (7, "third", 0, "user", "lost"), (8, "chosen", 0, "b", "x"), (8, "chosen", 0, "a", "y"), (8, "rejected", 0, "a", "y")]
    got = {r.pair_id: r for r in preference_examples(frame(rows, TURNS).selectExpr("*", "1 as t", "2 as c", "3 as prompt")).collect()}
    assert {p: (r.n_prompt_turns, r.prompt, r.chosen, r.rejected, r.n_chosen_turns, r.n_rejected_turns) for p, r in got.items()} == plain(rows)
    assert [got[p].status for p in (1, 2, 3, 4, 5)] == ["pair", "identical", "missing_rejected", "missing_chosen", "chosen_ends"]
    for r in got.values():
        for text, spans in ((r.chosen, r.chosen_spans), (r.rejected, r.rejected_spans)):
            assert [text[s.start:s.end] for s in spans] == [x for x in ("good", "bad", "b", "z", "same") if f"<|assistant|>\n{x}<" in text]


def test_empty_tables(frame):
    assert preference_examples(frame([], TURNS)).count() == 0
    conv = "conv_id long, turn long, role string, text string"
    assert swapped_answers(frame([], conv)).count() == 0


def test_swapped_answers(frame):
    conv = "conv_id long, turn long, role string, text string, side string"
    rows = [(1, 0, "user", "q", "?"), (1, 1, "assistant", "a1", "?"), (1, 2, "user", "bye", "?"), (2, 0, "user", "q2", "?"), (2, 1, "assistant", "a2", "?"),
            (3, 0, "user", "no answer", "?"), (None, 0, "assistant", "x", "?")]
    got = {r.pair_id: r for r in preference_examples(swapped_answers(frame(rows, conv))).collect()}
    assert set(got) == {1, 2}
    assert (got[1].prompt, got[1].chosen, got[1].rejected) == (show([("user", "q")]), show([("assistant", "a1"), ("user", "bye")]), show([("assistant", "a2")]))
    assert got[2].status == "rejected_ends"
