"""Operator 13, conversation structure repair: rank-convergence parallel Viterbi.

A conversation shall read ``(s?(ua)+)?`` in the initials of its roles. The cheapest edits that get it there follow
from costs-to-go of four states (nothing written, s, u, a last), a min-plus recurrence from the last row to the first.
Rows are laid out in order over all tasks, so one conversation may cross many of them. In a task, its rows fall into
chunks that are swept in step: every chunk but a conversation's last starts from a speculative cost vector; fix-up
passes rerun the chunks whose following chunk gave another vector, and stop inside a chunk as soon as old and new
vectors differ only by a constant (vectors are kept with a least cost of 0, so such vectors are equal). Across tasks,
the part of a conversation that begins a task speculates on each of the four states at once; the driver stitches
these 4 x 4 results, one per task. With the stitched costs every row's edits are known for each state; states are
then passed on chunk by chunk and task by task, always along the cheapest edit with the least initial.

Forced deletions (blank and repeated rows) cost the same in every state and are no part of the recurrence.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 256
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
INF = 1 << 40
#: States: nothing written, system, user, assistant last. Costs at the end, and what the next inserted or reroled row is.
END = np.array([0, 2 * INSERT, INSERT, 0], np.int64)
NEXT = np.array([2, 2, 3, 2])
#: KEPT[initial, state]: 0 where a row of that initial (other, s, u, a) may follow the state.
KEPT = np.full((4, 4), INF, np.int64)
KEPT[1, 0] = KEPT[2, 0] = KEPT[2, 1] = KEPT[2, 3] = KEPT[3, 2] = 0
ROLES = {2: "user", 3: "assistant"}
LEGAL = ("su", "ua", "au")
SPACES = " \t\n\x0b\x0c\r"
KEYS = ["conv_id", "turn", "role", "d0", "d1"]


# --- the recurrence -----------------------------------------------------------------------------------

def _close(x: np.ndarray) -> np.ndarray:
    """Costs with rows inserted before the next one."""
    u, a = np.minimum(x[:, 2], x[:, 3] + INSERT), np.minimum(x[:, 3], x[:, 2] + INSERT)
    return np.stack([np.minimum(x[:, 0], u + INSERT), np.minimum(x[:, 1], u + INSERT), u, a], 1)


def _kept(n: np.ndarray, kind: np.ndarray, cut: np.ndarray) -> np.ndarray:
    return n[np.arange(len(n)), kind][:, None] + KEPT[kind] + cut[:, None] * TRUNCATED + KEEP


def step(n: np.ndarray, kind: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Cost vectors before rows of these initials (``cut``: truncated), from the vectors after them."""
    rerole = n[:, NEXT] + (REROLE + cut[:, None] * TRUNCATED)
    return _close(np.minimum(np.minimum(n + DELETE, rerole), _kept(n, kind, cut)))


def sweep(kind: np.ndarray, cut: np.ndarray, lo: np.ndarray, hi: np.ndarray, vec: np.ndarray, after: np.ndarray,
          out: np.ndarray, off: np.ndarray, fixing: bool) -> int:
    """Run chunks [lo, hi) from their last row to their first, all in step, starting from ``vec``.

    ``after`` receives the vector after each row, ``out`` that before each chunk, both less their least cost, which
    ``off`` adds up. ``fixing``: a chunk stops where it meets the vector that it had before. Returns rows visited.
    """
    cur, alive, t, seen = vec.copy(), np.flatnonzero(hi > lo), 0, 0
    empty = np.flatnonzero(hi <= lo)
    out[empty] = cur[empty]
    off[:] = 0
    while len(alive):
        i = hi[alive] - 1 - t
        if fixing:
            new = (after[i] != cur[alive]).any(1)
            alive, i = alive[new], i[new]
        after[i] = cur[alive]
        x = step(cur[alive], kind[i], cut[i])
        least = x.min(1)
        off[alive] += least
        cur[alive] = x - least[:, None]
        seen += len(alive)
        done = i == lo[alive]
        out[alive[done]] = cur[alive[done]]
        alive, t = alive[~done], t + 1
    return seen


def _chunks(first: np.ndarray, n: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lo, hi, owner, last) of the chunks of runs that begin at ``first`` (a run without rows has one empty chunk)."""
    ends = np.append(first[1:], n) if len(first) else first
    count = np.maximum(1, -(-(ends - first) // size))
    owner = np.repeat(np.arange(len(first)), count)
    rank = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    lo = first[owner] + rank * size
    hi = np.minimum(lo + size, ends[owner])
    return lo, hi, owner, rank == count[owner] - 1


def costs(kind: np.ndarray, cut: np.ndarray, first: np.ndarray, tail: np.ndarray, size: int = CHUNK) -> tuple[np.ndarray, tuple, int]:
    """The vector after every row of all runs, up to a constant; ``tail``: the vector after each run.

    Also the chunks, and the rows visited by fix-up passes.
    """
    n = len(kind)
    lo, hi, owner, last = chunks = _chunks(first, n, size)
    vec = np.where(last[:, None], tail[owner], END[None])  # speculation: the conversation ends here
    after, out, off = np.zeros((n, 4), np.int64), np.zeros((len(lo), 4), np.int64), np.zeros(len(lo), np.int64)
    sweep(kind, cut, lo, hi, vec, after, out, off, False)
    redone = 0
    while True:
        want = np.where(last[:, None], vec, np.roll(out, -1, 0))
        far = np.flatnonzero((want != vec).any(1))
        if not len(far):
            return after, chunks, redone
        vec[far] = want[far]
        again = out[far]
        redone += sweep(kind, cut, lo[far], hi[far], vec[far], after, again, np.zeros(len(far), np.int64), True)
        out[far] = again


def matrix(kind: np.ndarray, cut: np.ndarray, size: int = CHUNK) -> np.ndarray:
    """[j, state]: the cost before all rows, if the state after them is j; from all chunks at once, then joined."""
    n = len(kind)
    lo, hi, _, _ = _chunks(np.zeros(1, np.int64), n, size)
    c = len(lo)
    unit = np.full((4, 4), INF, np.int64)
    np.fill_diagonal(unit, 0)
    after, out, off = np.zeros((4 * n, 4), np.int64), np.zeros((4 * c, 4), np.int64), np.zeros(4 * c, np.int64)
    by = np.repeat(np.arange(4), c)
    sweep(np.tile(kind, 4), np.tile(cut, 4), np.tile(lo, 4) + by * n, np.tile(hi, 4) + by * n, unit[by], after, out, off, False)
    parts = np.minimum(out + off[:, None], INF).reshape(4, c, 4)
    m = unit
    for k in range(c - 1, -1, -1):
        m = np.minimum((m[:, :, None] + parts[:, k][None]).min(1), INF)
    return m


def decide(after: np.ndarray, kind: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows inserted before it, its edit, state after it) for every row and every state before it."""
    n = len(kind)
    before = step(after, kind, cut)
    kept, gone = _kept(after, kind, cut), after + DELETE
    ins, edit, out = np.zeros((n, 4), np.int64), np.full((n, 4), ord("R"), np.uint8), np.zeros((n, 4), np.int64)
    row = np.arange(n)
    for s in range(4):
        at, open_ = np.full(n, s), np.ones(n, bool)
        for _ in range(3):
            now = before[row, at]
            d = open_ & (now == gone[row, at])
            i = open_ & ~d & (now == before[row, NEXT[at]] + INSERT)
            k = open_ & ~d & ~i & (now == kept[row, at])
            r = open_ & ~d & ~i & ~k
            edit[d, s], edit[k, s] = ord("D"), ord("K")
            out[d, s], out[k, s], out[r, s] = at[d], kind[k], NEXT[at[r]]
            ins[i, s] += 1
            at = np.where(i, NEXT[at], at)
            open_ = i
    return ins, edit, out


def states(out: np.ndarray, chunks: tuple, n_runs: int, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(state before every row, [run, state]: the state after the run): chunks for all states in step, then joined."""
    lo, hi, owner, _ = chunks
    here, cur = np.zeros((len(out), 4), np.int64), np.tile(np.arange(4), (len(lo), 1))
    alive, t = np.flatnonzero(hi > lo), 0
    while len(alive):
        i = lo[alive] + t
        here[i] = cur[alive]
        cur[alive] = np.take_along_axis(out[i], cur[alive], 1)
        alive, t = alive[i + 1 < hi[alive]], t + 1
    through, begin = np.tile(np.arange(4), (n_runs, 1)), np.zeros(len(lo), np.int64)
    starts = np.searchsorted(owner, np.arange(n_runs))
    sizes = np.diff(np.append(starts, len(owner)))
    at = entry.copy()
    for r in range(int(sizes.max()) if n_runs else 0):
        run = np.flatnonzero(sizes > r)
        c = starts[run] + r
        begin[c] = at[run]
        at[run] = cur[c, at[run]]
        through[run] = np.take_along_axis(cur[c], through[run], 1)
    of = np.repeat(np.arange(len(lo)), np.maximum(hi - lo, 0))
    return here[np.arange(len(out)), begin[of]] if len(out) else np.zeros(0, np.int64), through


# --- rows of one task ---------------------------------------------------------------------------------

@dataclass
class Part:
    """The rows of one task: the live ones, and the runs (conversations) that begin among all rows."""

    kind: np.ndarray
    cut: np.ndarray
    live: np.ndarray
    first: np.ndarray  # live row at which each run begins
    run: np.ndarray  # run of every row
    ids: list  # conversation of the first and the last run


def _part(batches: list[pa.RecordBatch]) -> Part:
    t = pa.Table.from_batches(batches)
    conv = t["conv_id"].combine_chunks()
    ids, null = conv.fill_null(0).to_numpy(zero_copy_only=False), conv.is_null().to_numpy(zero_copy_only=False)
    new = np.concatenate(([True], (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])))
    live = t["live"].to_numpy().astype(bool)
    run = np.cumsum(new) - 1
    first = np.searchsorted(run[live], np.arange(run[-1] + 1))
    ends = [None if null[k] else int(ids[k]) for k in (0, -1)]
    return Part(t["kind"].to_numpy()[live].astype(np.int64), t["cut"].to_numpy()[live].astype(np.int64), live, first, run, ends)


def _solved(p: Part, tail: list[int] | None, entry: int) -> tuple:
    """(rows inserted, edit, state before, state after) of the live rows, and the last run's passage through."""
    n_runs = len(p.first)
    tails = np.tile(END, (n_runs, 1))
    if tail is not None:
        tails[-1] = tail
    after, chunks, _ = costs(p.kind, p.cut, p.first, tails)
    ins, edit, out = decide(after, p.kind, p.cut)
    entries = np.zeros(n_runs, np.int64)
    entries[0] = entry
    here, through = states(out, chunks, n_runs, entries)
    pick = lambda x: x[np.arange(len(here)), here]
    return pick(ins), pick(edit), here, pick(out), through


SEAM_SCHEMA = pa.schema([("pid", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("one", pa.bool_()), ("m", pa.list_(pa.int64()))])


@dataclass
class Seams:
    """What a task must know of its neighbours: the vector after its last run, the state before its first."""

    tail: dict[int, list[int]]
    entry: dict[int, int]


def _seams(laid: DataFrame) -> Seams:
    """Two small results a task, stitched on the driver."""
    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if own := [b for b in batches if b.num_rows]:
            p = _part(own)
            stop = p.first[1] if len(p.first) > 1 else len(p.kind)
            m = matrix(p.kind[:stop], p.cut[:stop])
            yield pa.RecordBatch.from_pylist([{"pid": own[0]["pid"][0].as_py(), "first": p.ids[0], "last": p.ids[1], "one": len(p.first) == 1, "m": m.ravel().tolist()}], SEAM_SCHEMA)

    cols = laid.select(F.spark_partition_id().alias("pid"), "conv_id", "kind", "cut", "live")
    parts = sorted(cols.mapInArrow(ends, "pid long, first long, last long, one boolean, m array<long>").collect(), key=lambda r: r.pid)
    tail: dict[int, list[int]] = {}
    vec = END
    for a, b in zip(parts[-2::-1], parts[:0:-1], strict=True):  # from the last task to the first
        vec = tail.get(b.pid, END) if b.one else END
        if a.last == b.first:
            v = (np.array(vec)[:, None] + np.array(b.m).reshape(4, 4)).min(0)
            tail[a.pid] = (v - v.min()).tolist()
    if not tail:
        return Seams({}, {})

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if own := [b for b in batches if b.num_rows]:
            pid = own[0]["pid"][0].as_py()
            if pid in tail:
                yield pa.RecordBatch.from_pylist([{"pid": pid, "out": _solved(_part(own), tail[pid], 0)[4][-1].tolist()}])

    passed = {r.pid: r.out for r in cols.mapInArrow(through, "pid long, out array<long>").collect()}
    entry: dict[int, int] = {}
    for a, b in zip(parts, parts[1:], strict=False):
        if a.pid in tail:
            entry[b.pid] = passed[a.pid][entry.get(a.pid, 0) if a.one else 0]
    return Seams(tail, entry)


# --- jobs ---------------------------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after damage by crc32(conv_id:turn) % 20; nulls of role and text become one space.

    0 drops a row, 1 empties its text, 2 removes ``.!?``, 3 repeats it, 4 makes its role user. In the hashed key a
    null is one space too; null ids and turns stay null in the rows.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                part("role").alias("role"), part("text").alias("text"), h.alias("h")).where("h <> 0")
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def _digest(salt: int) -> Column:
    return F.xxhash64(F.lit(salt), "role", "text").alias(f"d{salt}")


def _rows(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, d0, d1, text): nulls of role and text are one space; d0, d1 stand for role and text."""
    own = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))
    return own.select("conv_id", "turn", "role", _digest(0), _digest(1), "text")


def lay_out(turns: DataFrame) -> DataFrame:
    """One row per distinct row of a conversation, without its text, in order over all partitions.

    n (copies), blank, cut (truncated: last character not ``.!?``), live (its first copy is neither blank nor seen
    earlier), kind (initial: 1 s, 2 u, 3 a, 0 other). Order: conversation, turn (nulls first), role, digest of the text.
    """
    text = F.rtrim(F.col("text"), F.lit(SPACES))
    end = F.substring(text, -1, 1)
    rows = _rows(turns).select(*KEYS, (text == "").alias("blank"), (~end.isin(".", "!", "?")).alias("cut")) \
        .groupBy(*KEYS).agg(F.count("*").alias("n"), F.first("blank").alias("blank"), F.first("cut").alias("cut"))
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    firsts = rows.groupBy("conv_id", "d0", "d1").agg(F.min(at).alias("at")).select(
        F.col("conv_id").alias("c"), F.col("d0").alias("e0"), F.col("d1").alias("e1"), F.col("at.turn").alias("first_turn"))
    joined = rows.join(firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("d0") == F.col("e0")) & (F.col("d1") == F.col("e1")))
    kind = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for x in ("s", 1, "u", 2, "a", 3))), F.substring("role", 1, 1)), F.lit(0))
    return joined.select(*KEYS, "n", "blank", "cut", (~F.col("blank") & F.col("turn").eqNullSafe(F.col("first_turn"))).alias("live"), kind.alias("kind")) \
        .repartitionByRange(*KEYS).sortWithinPartitions(*KEYS).checkpoint()


EDITED = "conv_id long, turn long, role string, d0 long, d1 long, n long, blank boolean, cut boolean, live boolean, edit string, state int, next int, ins int"


def edits(turns: DataFrame) -> DataFrame:
    """The cheapest edits, one row per distinct row of a conversation: its keys, n (copies), blank, cut, live, and for
    live ones ins (rows inserted before it), edit (D, K or R of its first copy; all other copies are deleted), state and
    next (0 nothing, 1 system, 2 user, 3 assistant written last, before and after all of it).

    What follows the last row of a conversation follows from its last state: u lacks one row, s two.
    """
    laid = lay_out(turns)
    seams = _seams(laid)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [b for b in batches if b.num_rows]
        if not own:
            return
        p, pid = _part(own), own[0]["pid"][0].as_py()
        ins, edit, here, after, _ = _solved(p, seams.tail.get(pid), seams.entry.get(pid, 0))
        out = {"edit": np.full(len(p.live), "D", dtype="<U1"), "state": np.full(len(p.live), -1, np.int32),
               "next": np.full(len(p.live), -1, np.int32), "ins": np.zeros(len(p.live), np.int32)}
        at = np.flatnonzero(p.live)
        out["edit"][at], out["state"][at], out["next"][at], out["ins"][at] = edit.view("S1").astype("<U1"), here, after, ins
        k = 0
        for b in own:
            m = b.num_rows
            yield pa.RecordBatch.from_arrays([*(b[c] for c in (*KEYS, "n", "blank", "cut", "live")), *(pa.array(v[k:k + m]) for v in out.values())],
                                             names=[*KEYS, "n", "blank", "cut", "live", *out])
            k += m

    return laid.select(F.spark_partition_id().alias("pid"), *KEYS, "n", "blank", "cut", "live", "kind").mapInArrow(run, EDITED)


def _in_order(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """A conversation's edits in order, each before the row's text, in one partition; ``ids`` mark every conversation."""
    done = edits(turns)
    lacks = [F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in EDITED.split(", ")) if c not in KEYS]
    marks = ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().select(
        "conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(0).cast("long").alias("d0"), F.lit(0).cast("long").alias("d1"),
        *lacks, F.lit(None).cast("string").alias("text"), F.lit(0).alias("what"))
    texts = _rows(turns).select(*KEYS, *lacks, "text", F.lit(2).alias("what")).where(F.rtrim(F.col("text"), F.lit(SPACES)) != "")
    every = done.withColumns({"text": F.lit(None).cast("string"), "what": F.lit(1)}).unionByName(marks).unionByName(texts)
    return every.repartition("conv_id").sortWithinPartitions("conv_id", F.col("what") > 0, "turn", "role", "d0", "d1", "what")


class _Story:
    """One conversation as its edits and texts come by."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.blank, self.duplicate, self.truncated, self.illegal, self.cost = conv_id, 0, 0, 0, 0, 0
        self.low, self.high, self.turns, self.last, self.state, self.audit, self.waiting = None, None, 0, None, 0, [], None

    def edited(self, r: dict) -> Iterator[tuple[str, str]]:
        """Count a row's faults and edits; the rows written before its own text."""
        turn, n, initial = r["turn"], r["n"], r["role"][:1]
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        if self.last is not None:
            self.illegal += self.last + initial not in LEGAL
        self.illegal += (n - 1) * (initial * 2 not in LEGAL)
        self.last = initial
        if r["blank"]:
            self.blank += n
        else:
            self.duplicate += n - r["live"]
            self.truncated += r["live"] and r["cut"]
        self.waiting = None
        if not r["live"]:
            self.audit.append("D" * n)
            self.cost += DELETE * n
            return
        yield from self.inserted(r["ins"])
        self.audit.append(r["edit"] + "D" * (n - 1))
        self.cost += DELETE * (n - 1) + {"D": DELETE, "K": KEEP, "R": REROLE}[r["edit"]]
        if r["edit"] != "D":
            self.cost += TRUNCATED * r["cut"]
            self.waiting = (r["turn"], r["role"], r["d0"], r["d1"]), r["role"] if r["edit"] == "K" else ROLES[r["next"]]
        self.state = r["next"]

    def inserted(self, n: int) -> Iterator[tuple[str, str]]:
        for _ in range(n):
            self.state = int(NEXT[self.state])
            self.audit.append("I")
            self.cost += INSERT
            yield ROLES[self.state], ""

    def text(self, r: dict) -> Iterator[tuple[str, str]]:
        """The row's own text, once."""
        if self.waiting and self.waiting[0] == (r["turn"], r["role"], r["d0"], r["d1"]):
            yield self.waiting[1], r["text"]
            self.waiting = None

    def end(self) -> Iterator[tuple[str, str]]:
        yield from self.inserted({1: 2, 2: 1}.get(self.state, 0))

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def _stories(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Story, Iterator[tuple[str, str]] | None]]:
    """(story, rows written) for every input row, and (story, None) after a conversation's last."""
    story = None
    for b in batches:
        for r in b.to_pylist():
            if r["what"] == 0:
                if story:
                    yield story, story.end()
                    yield story, None
                story = _Story(r["conv_id"])
            else:
                yield story, story.edited(r) if r["what"] == 1 else story.text(r)
    if story:
        yield story, story.end()
        yield story, None


AUDIT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def audits(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Per conversation of ``ids`` (default: of ``turns``): its faults, cheapest edits and a digest of what they leave.

    gaps, blank, duplicate, truncated, illegal, cost (longs), audit (initials of the edits in order, ASCII-least among
    the cheapest), repaired_sha256 (SHA-256 of the repaired ``role:text`` lines, joined by newlines). Null roles and
    texts are one space; a null conv_id is a conversation like any other, a null turn comes first and opens no gap;
    rows of one turn are ordered by role, then by a hash of the text; equal rows are copies; other columns are ignored;
    a conversation without rows has zeros, an empty audit and the empty text's hash; an empty table gives no rows.
    The digest reads a conversation's lines in order, in one task, as a stream that keeps nothing of them; edits are
    found in many tasks, however long the conversation.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, sha, n = [], hashlib.sha256(), 0
        for s, lines in _stories(batches):
            if lines is not None:
                for role, text in lines:
                    sha.update(f"{chr(10) if n else ''}{role}:{text}".encode())
                    n += 1
                continue
            out.append({"conv_id": s.conv_id, "gaps": s.gaps, "blank": s.blank, "duplicate": s.duplicate, "truncated": s.truncated,
                        "illegal": s.illegal, "cost": s.cost, "audit": "".join(s.audit), "repaired_sha256": sha.hexdigest()})
            sha, n = hashlib.sha256(), 0
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, AUDIT_SCHEMA)
                out = []
        yield pa.RecordBatch.from_pylist(out, AUDIT_SCHEMA)

    return _in_order(turns, turns if ids is None else ids).mapInArrow(run, AUDIT)


AUDIT_SCHEMA = pa.schema([(c, pa.string() if t == "string" else pa.int64()) for c, t in (x.split() for x in AUDIT.split(", "))])
TURN_SCHEMA = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def repaired(turns: DataFrame) -> DataFrame:
    """(conv_id, position, role, text): the conversations after the cheapest edits; same cases as ``audits``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n = [], 0
        for s, lines in _stories(batches):
            if lines is None:
                n = 0
                continue
            for role, text in lines:
                out.append({"conv_id": s.conv_id, "position": n, "role": role, "text": text})
                n += 1
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, TURN_SCHEMA)
                out = []
        yield pa.RecordBatch.from_pylist(out, TURN_SCHEMA)

    return _in_order(turns, turns).mapInArrow(run, "conv_id long, position long, role string, text string")
