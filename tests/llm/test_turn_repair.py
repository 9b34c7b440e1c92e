import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from encore.llm import turn_repair as T
from encore.llm.queries import QUERIES
from encore.sources.tables import read_table

SOLID = re.compile(r"[^\x20\x09-\x0D]")
TURNS = "conv_id long, turn long, role string, text string"


def plain_damage(rows):
    out = []
    for c, t, role, text in rows:
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h:
            text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
            out += [(c, t, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


def faults(rows):
    """[(fault)] of rows in order."""
    seen, out = set(), []
    for role, text in rows:
        solid = SOLID.findall(text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired) by Dijkstra over (row, initials written): least cost, then least audit."""
    fault = faults(rows)
    heap, done = [(0, "", 0, "", ())], set()
    follow = lambda state, i: {"": "su", "s": "u", "u": "a", "a": "u"}[state].find(i) >= 0 and i != ""
    while heap:
        cost, audit, k, state, lines = heapq.heappop(heap)
        if k == len(rows) and state in ("", "a"):
            return cost, audit, list(lines)
        if (k, state) in done:
            continue
        done.add((k, state))
        push = lambda c, e, k2, s, line: heapq.heappush(heap, (cost + c, audit + e, k2, s, lines + line))
        for role in ("user", "assistant"):
            if follow(state, role[0]):
                push(2, "I", k, role[0], (f"{role}:",))
        if k < len(rows):
            (role, text), cut = rows[k], fault[k] == "truncated"
            push(3, "D", k + 1, state, ())
            if fault[k] not in ("blank", "duplicate"):
                if follow(state, role[:1]):
                    push(cut, "K", k + 1, role[:1], (f"{role}:{text}",))
                for r in ("user", "assistant"):
                    if follow(state, r[0]):
                        push(2 + cut, "R", k + 1, r[0], (f"{r}:{text}",))


def plain(rows, ids):
    """{conv_id: digest columns}; rows of one turn by role and hash must not differ in these tests, or be given in order."""
    out = {}
    for c in ids:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        turns = [r[1] for r in own if r[1] is not None]
        pairs = [(r[2], r[3]) for r in own]
        fault = faults(pairs)
        cost, audit, lines = cheapest(pairs)
        initials = "".join(x.split(":")[0][:1] for x in lines)
        assert re.fullmatch("(s?(ua)+)?", initials)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:], strict=False))
        out[c] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, fault.count("blank"), fault.count("duplicate"),
                  fault.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def got(df):
    rows = df.collect()
    assert len(rows) == len({r.conv_id for r in rows})
    return {r.conv_id: tuple(r)[1:] for r in rows}


def test_query_on_all_conversations(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in read_table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    want = plain(plain_damage(rows), {r[0] for r in rows})
    assert got(QUERIES["op13_turn_repair"](spark, sf)) == want
    assert sum(w[5] for w in want.values()) > 50


def drawn(rng, c, n):
    texts = ["Ja.", "Nein!", "offen", "", " \n", "Gut?  ", "x", "é."]
    return [(c, t, rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", "agent"]), rng.choice(texts) + (str(t) + "." if rng.random() < 0.6 else ""))
            for t in range(n) if rng.random() < 0.9]


def test_odd_conversations(frame):
    rng = random.Random(5)
    rows = [r for c in range(60) for r in drawn(rng, c, rng.randrange(9))] + drawn(rng, 100, 120)
    rows += [(None, 1, "user", "a."), (None, 2, "assistant", "b."), (200, None, "user", "a."), (200, None, "user", "a."), (200, 9, "assistant", None), (201, 1, None, None),
             (202, 1, "system", "nur."), (203, 5, "user", "lang " * 50_000 + "."), (203, 6, "assistant", "x.")]
    rows = [r for r in rows if r]
    ids = {r[0] for r in rows} | {999}
    df = frame(rows, TURNS).selectExpr("*", "'x' as n", "1 as kind", "2 as d0", "3 as what")
    who = frame([(i,) for i in ids] * 2, "conv_id long")
    clean = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert got(T.audits(df, who)) == plain(clean, ids)
    damaged = plain_damage(rows)
    assert sorted(map(str, T.damaged(df).collect())) == sorted(str(r) for r in frame(damaged, TURNS).collect())
    assert got(T.audits(T.damaged(df), who)) == plain(damaged, ids)
    lines = {}
    for r in sorted(T.repaired(df).collect(), key=lambda r: r.position):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    want = plain(clean, ids)
    for c in ids:
        assert hashlib.sha256("\n".join(lines.get(c, [])).encode()).hexdigest() == want[c][-1]


def test_empty_table(frame):
    assert T.audits(frame([], TURNS)).count() == 0 and T.repaired(frame([], TURNS)).count() == 0
    only = got(T.audits(frame([], TURNS), frame([(1,)], "conv_id long")))
    assert only == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_a_conversation_over_many_tasks(spark, frame, partitions):
    rng = random.Random(partitions)
    rows = drawn(rng, 1, 900) + drawn(rng, 2, 3) + drawn(rng, 3, 40)
    want = plain(rows, {1, 2, 3})
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert got(T.audits(frame(rows, TURNS))) == want
        assert T.lay_out(frame(rows, TURNS)).select(F.spark_partition_id()).distinct().count() >= min(partitions, 30)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def sequential(kind, cut, tail):
    v, out = tail, []
    for k, c in zip(kind[::-1], cut[::-1], strict=True):
        out.append(v - v.min())
        v = T.step(v[None], np.array([k]), np.array([c]))[0]
    return np.array(out[::-1]).reshape(-1, 4), v


def test_chunks_converge_to_the_sequential_costs():
    rng = np.random.default_rng(3)
    for size in (1, 3, 16, 256):
        for d, draw in enumerate((lambda n: rng.integers(0, 4, n), lambda n: np.zeros(n, np.int64), lambda n: 2 + np.arange(n) % 2)):
            kind, cut = np.concatenate([draw(200), draw(1), draw(57)]), rng.integers(0, 2, 258)
            first = np.array([0, 200, 201, 258])
            tails = np.array([T.END, [9, 4, 0, 1], T.END, T.END])
            after, _, redone = T.costs(kind, cut, first, tails, size)
            want = np.concatenate([sequential(kind[a:b], cut[a:b], t)[0] for a, b, t in zip([0, 200, 201], [200, 201, 258], tails, strict=False)])
            assert (after == want).all()
            if size == 16 and d == 0:  # ordinary rows soon make all vectors parallel
                assert redone <= 130, redone
            m = T.matrix(kind, cut, size)
            for tail in (T.END, np.array([5, 0, 7, 2])):
                v = (tail[:, None] + m).min(0)
                assert (v == sequential(kind, cut, tail)[1]).all()
