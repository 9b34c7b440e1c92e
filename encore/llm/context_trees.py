"""Operator 12, LM scoring: context-tree weighting over binary-decomposed bytes.

A byte is eight yes/no decisions, 255 nodes of a binary tree by the bits decided so far. Each node has a context tree:
its contexts are the 0 to 4 bytes before the byte. Every (context, node) holds the zeros and ones that followed in
training, with the Krichevsky-Trofimov estimate of their probability, and weighs stopping there against going one byte
deeper: P_w = (P_kt + product of P_w over the deeper contexts) / 2, at the greatest depth P_w = P_kt. With training done, a
bit's probability mixes the estimates (n_bit + 1/2) / (n + 1) of all depths on its path, each depth with the posterior
weight P_kt / (2 P_w) of stopping there; a context that training never saw has no estimate, the path ends above it.
Each text begins after ``START`` bytes and is closed by one ``END`` byte (neither occurs in UTF-8), so the
probabilities of all texts sum to 1.

Spark counts (context, byte) grams and words of all training texts; trees of contexts that share their last two bytes
are built in one task from these counts (a gram has five bytes, so such a tree is bounded), the two depths above are
summed into 65,280 nodes. The values of the most frequent keys, at most ``COMMON`` of each kind, go to all tasks; every
other key of a text is counted per text and joined with its value, so nothing is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.textops import LOWER, U64, slices, text_bytes, word_hashes, words

DEPTH = 4
START, END = 0xFE, 0xFF
#: Most keys of a kind whose values are sent to all tasks: 16 bytes each.
COMMON = 1 << 18
#: Distinct keys that a counting task holds before it hands them on.
HELD = 1 << 20
GRAM, WORD = 1, 2
LOG2, LOG10 = np.log(2.0), np.log(10.0)


# --- texts --------------------------------------------------------------------------------------------

def _grams(part: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The gram that ends at every byte and END of these texts, and each text's first gram.

    A gram is x1 x2 x3 x4 y from high to low byte: the byte y and the bytes before it, the nearest first.
    """
    n = len(own) - 1
    at = own + np.arange(n + 1) * (DEPTH + 1)
    buf = np.full(int(at[-1]), START, np.uint8)
    text = np.ones(len(buf), bool)
    for k in range(DEPTH):
        text[at[:-1] + k] = False
    text[at[1:] - 1] = False
    buf[text] = part[own[0]:own[-1]]
    buf[at[1:] - 1] = END
    key = np.zeros(max(len(buf) - DEPTH, 0), U64)
    for shift, back in ((0, 0), (32, 1), (24, 2), (16, 3), (8, 4)):
        key |= buf[DEPTH - back:len(buf) - back].astype(U64) << U64(shift)
    real = np.ones(len(buf), bool)
    for k in range(DEPTH):
        real[at[:-1] + k] = False
    return key[real[DEPTH:]], own - own[0] + np.arange(n + 1)


def _counted(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys in order, their counts)."""
    if n is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.diff(np.append(first, len(keys))) if n is None else np.add.reduceat(n, first)


def _pieces(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets in them) of about a megabyte each."""
    data, at = text_bytes(column)
    for lo, hi in slices(at, 1 << 20):
        yield lo, hi, data[int(at[lo]):int(at[hi])], at[lo:hi + 1] - int(at[lo])


def _word_keys(part: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every lower-cased word, and each text's first."""
    low = LOWER[part]
    starts, ends, first = words(low, own)
    return word_hashes(low, starts, ends), first


def count_keys(docs: DataFrame) -> DataFrame:
    """(kind, key, n) over the ``text`` of all rows: grams and word hashes, added up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {GRAM: [], WORD: []}

        def merged(kind: int) -> tuple[np.ndarray, np.ndarray]:
            k, n = zip(*held[kind], strict=True)
            return _counted(np.concatenate(k), np.concatenate(n))

        def out(kind: int) -> Iterator[pa.RecordBatch]:
            keys, n = held[kind].pop()
            for lo in range(0, len(keys), 100_000):
                k = keys[lo:lo + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int32)), pa.array(k.view(np.int64)), pa.array(n[lo:lo + 100_000])], names=["kind", "key", "n"])

        for b in batches:
            for _, _, part, own in _pieces(b.column(0)):
                for kind, keys in ((GRAM, _grams(part, own)[0]), (WORD, _word_keys(part, own)[0])):
                    held[kind].append(_counted(keys))
                    if sum(len(k) for k, _ in held[kind]) > HELD:
                        held[kind] = [merged(kind)]
                        if len(held[kind][0][0]) > HELD // 2:
                            yield from out(kind)
        for kind in (GRAM, WORD):
            if held[kind]:
                held[kind] = [merged(kind)]
                yield from out(kind)

    found = docs.select("text").mapInArrow(run, "kind int, key long, n long")
    return found.groupBy("kind", "key").agg(F.sum("n").alias("n"))


# --- trees --------------------------------------------------------------------------------------------

def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln(gamma(x)) for x >= 1/2: Stirling's series, after eight steps of the recurrence for small x."""
    x = np.asarray(x, np.float64)
    small = x < 8
    z = np.where(small, x + 8, x)
    out = (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + (1 / 12 - (1 / 360 - (1 / 1260 - (1 / 1680 - 1 / 1188 / z ** 2) / z ** 2) / z ** 2) / z ** 2) / z
    if small.any():
        s = x[small]
        down = s.copy()
        for k in range(1, 8):
            down *= s + k
        out[small] -= np.log(down)
    return out


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a sequence with these counts."""
    out = log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)
    return np.where(zeros + ones > 0, out, 0.0)


@dataclass
class Nodes:
    """Nodes of one depth and bit: their keys in order, estimate of a zero, posterior weight of stopping, training."""

    key: np.ndarray
    zero: np.ndarray
    stop: np.ndarray
    seen: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    log_w: np.ndarray


def _weighed(key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, deeper: np.ndarray | None) -> Nodes:
    """``deeper``: sum of ln P_w over each node's deeper contexts; None at the greatest depth."""
    kt = log_kt(zeros, ones)
    log_w = kt if deeper is None else np.logaddexp(kt, deeper) - LOG2
    stop = np.ones(len(kt)) if deeper is None else np.exp(kt - LOG2 - log_w)
    return Nodes(key, (zeros + 0.5) / (zeros + ones + 1.0), stop, zeros + ones > 0, zeros, ones, log_w)


def _level(pair: np.ndarray, n: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(node keys, zeros, ones, node of each pair) for sorted (context, byte) pairs and their counts."""
    g = pair >> U64(8 - bit)
    new = np.concatenate(([True], g[1:] != g[:-1]))
    first = np.flatnonzero(new)
    total = np.add.reduceat(n, first)
    ones = np.add.reduceat(n * ((pair >> U64(7 - bit)) & U64(1)).astype(np.int64), first)
    return g[first], total - ones, ones, np.cumsum(new) - 1


class Forest:
    """Depths 2 to 4 of the trees of some contexts, from all grams (sorted) that share them; counts may be 0."""

    def __init__(self, grams: np.ndarray, n: np.ndarray):
        self.pairs: dict[int, tuple[np.ndarray, np.ndarray]] = {DEPTH: (grams, n)}
        self.of = {DEPTH: np.arange(len(grams))}  # pair of each gram
        for d in range(DEPTH - 1, 1, -1):
            up, un = self.pairs[d + 1]
            short = ((up >> U64(16)) << U64(8)) | (up & U64(255))
            keys, back = np.unique(short, return_inverse=True)
            self.pairs[d] = (keys, np.bincount(back, weights=un, minlength=len(keys)).astype(np.int64))
            self.of[d] = back[self.of[d + 1]]

    def levels(self, bit: int) -> dict[int, tuple[Nodes, np.ndarray]]:
        """{depth: (nodes, node of each gram)} of one bit."""
        out: dict[int, tuple[Nodes, np.ndarray]] = {}
        for d in range(DEPTH, 1, -1):
            key, zeros, ones, node = _level(*self.pairs[d], bit)
            deeper = None
            if d < DEPTH:
                low = out[d + 1][0]
                # a deeper node's key without its farthest byte: context bytes lie above the bits decided
                parent = ((low.key >> U64(bit + 8)) << U64(bit)) | (low.key & U64((1 << bit) - 1))
                deeper = np.bincount(np.searchsorted(key, parent), weights=low.log_w, minlength=len(key))
            out[d] = (_weighed(key, zeros, ones, deeper), node[self.of[d]])
        return out

    def top_sums(self) -> dict[str, np.ndarray]:
        """zeros, ones and sum of ln P_w of the depth-2 nodes, added up for each (x1, node): arrays of 65,536."""
        out = {"zeros": np.zeros(1 << 16), "ones": np.zeros(1 << 16), "log_w": np.zeros(1 << 16)}
        for bit in range(8):
            two = self.levels(bit)[2][0]
            at = (((two.key >> U64(bit + 8)) << U64(8)) | U64(1 << bit) | (two.key & U64((1 << bit) - 1))).astype(np.int64)
            for c, v in (("zeros", two.zeros), ("ones", two.ones), ("log_w", two.log_w)):
                out[c] += np.bincount(at, weights=v, minlength=1 << 16)
        return out

    def log10_bytes(self, top: Top) -> np.ndarray:
        """log10 P(byte | the four bytes before it) of every gram."""
        grams = self.pairs[DEPTH][0]
        x1, y = (grams >> U64(32)).astype(np.int64), (grams & U64(255)).astype(np.int64)
        out = np.zeros(len(grams))
        for bit in range(8):
            one = (y >> (7 - bit)) & 1
            node = (1 << bit) | (y >> (8 - bit))
            path = [(top.zero0[node], top.stop0[node], top.seen0[node]), (top.zero1[x1, node], top.stop1[x1, node], top.seen1[x1, node])]
            low = self.levels(bit)
            path += [(low[d][0].zero[low[d][1]], low[d][0].stop[low[d][1]], low[d][0].seen[low[d][1]]) for d in range(2, DEPTH + 1)]
            p, below = np.full(len(grams), 0.5), np.zeros(len(grams), bool)
            for zero, stop, seen in reversed(path):
                own = np.where(one == 1, 1 - zero, zero)
                p = np.where(seen, np.where(below, stop * own + (1 - stop) * p, own), p)
                below = seen
            out += np.log10(p)
        return out


@dataclass
class Top:
    """Depths 0 and 1: estimate of a zero, weight of stopping and training of every node."""

    zero0: np.ndarray
    stop0: np.ndarray
    seen0: np.ndarray
    zero1: np.ndarray
    stop1: np.ndarray
    seen1: np.ndarray

    @staticmethod
    def of(sums: dict[str, np.ndarray]) -> Top:
        one = _weighed(np.arange(1 << 16), sums["zeros"], sums["ones"], sums["log_w"])
        up = lambda v: v.reshape(256, 256).sum(0)
        none = _weighed(np.arange(256), up(one.zeros), up(one.ones), up(one.log_w))
        return Top(none.zero, none.stop, none.seen, *(v.reshape(256, 256) for v in (one.zero, one.stop, one.seen)))


def _by_context(grams: DataFrame) -> DataFrame:
    """Grams dealt by their last two context bytes."""
    parts = int(grams.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return grams.repartition(parts, F.shiftright("key", 24))


def _forest(batches: Iterator[pa.RecordBatch]) -> tuple[Forest, np.ndarray] | None:
    """The trees of a task's grams (key, n, wanted), and which are wanted."""
    own = [b for b in batches if b.num_rows]
    if not own:
        return None
    t = pa.Table.from_batches(own)
    key, n, wanted = t["key"].to_numpy().view(U64), t["n"].to_numpy(), t["wanted"].to_numpy().astype(np.int64)
    keys, back = np.unique(key, return_inverse=True)
    return Forest(keys, np.bincount(back, weights=n).astype(np.int64)), np.bincount(back, weights=wanted) > 0


def top_of(grams: DataFrame) -> Top:
    """Depths 0 and 1 from all (key, n): at most 65,280 rows reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if got := _forest(batches):
            sums = got[0].top_sums()
            at = np.flatnonzero(sums["zeros"] + sums["ones"])
            yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(v[at]) for v in sums.values())], names=["node", *sums])

    found = _by_context(grams.select("key", "n", F.lit(False).alias("wanted"))).mapInArrow(run, "node long, zeros double, ones double, log_w double")
    rows = found.groupBy("node").agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "log_w"))).collect()
    sums = {c: np.zeros(1 << 16) for c in ("zeros", "ones", "log_w")}
    for r in rows:
        for c in sums:
            sums[c][r.node] = r[c]
    return Top.of(sums)


def byte_scores(grams: DataFrame, wanted: DataFrame, top: Top) -> DataFrame:
    """(key, value): log10 probability of every wanted gram, seen in training or not, with all trained ``grams``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if got := _forest(batches):
            forest, asked = got
            value, keys = forest.log10_bytes(top)[asked], forest.pairs[DEPTH][0][asked]
            for lo in range(0, len(keys), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(keys[lo:lo + 100_000].view(np.int64)), pa.array(value[lo:lo + 100_000])], names=["key", "value"])

    both = grams.select("key", "n", F.lit(False).alias("wanted")).unionByName(wanted.select("key", F.lit(0).cast("long").alias("n"), F.lit(True).alias("wanted")))
    return _by_context(both).mapInArrow(run, "key long, value double")


# --- the model ----------------------------------------------------------------------------------------

@dataclass
class Model:
    """Counts of the training texts (kind, key, n), their totals, and the values of the common keys."""

    counts: DataFrame
    top: Top
    docs: int
    tokens: int
    types: int
    common: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)

    def word_value(self, n: Column | np.ndarray | float) -> Column | np.ndarray:
        log10 = np.log10 if not isinstance(n, Column) else F.log10
        return log10((n + 0.5) / (self.tokens + 0.5 * (self.types + 1)))

    def of_kind(self, kind: int) -> DataFrame:
        return self.counts.where(F.col("kind") == kind).select("key", "n")


def _floors(counts: DataFrame, most: int) -> dict[int, int]:
    """Per kind the least count that at most ``most`` keys reach, to an eighth of a power of two."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
    rows = counts.groupBy("kind", step.alias("step")).agg(F.count("*").alias("keys"), F.min("n").alias("least")).collect()
    out = {}
    for kind in (GRAM, WORD):
        total, floor = 0, None
        for r in sorted((r for r in rows if r.kind == kind), key=lambda r: -r.step):
            total += r["keys"]
            if total > most:
                break
            floor = r.least
        out[kind] = floor if floor is not None else (1 << 62)
    return out


def train(docs: DataFrame, text_col: str = "text", common: int = COMMON) -> Model:
    """Counts over the whole texts of all rows of ``docs``; null texts are empty, an empty table trains nothing."""
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    counts = count_keys(texts).checkpoint()
    n_docs = texts.count()
    w = counts.where(F.col("kind") == WORD).agg(F.count("*").alias("types"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).first()
    m = Model(counts, top_of(counts.where(F.col("kind") == GRAM)), n_docs, w.tokens + n_docs, w.types + (n_docs > 0))
    floors = _floors(counts, common)
    some = counts.where(F.col("n") >= F.when(F.col("kind") == GRAM, floors[GRAM]).otherwise(floors[WORD]))
    often = some.where(F.col("kind") == WORD).select("key", "n").collect()
    grams = byte_scores(m.of_kind(GRAM), some.where(F.col("kind") == GRAM), m.top).collect()
    for kind, rows, value in ((WORD, often, lambda v: m.word_value(v)), (GRAM, grams, lambda v: v)):
        keys = np.array([r[0] for r in rows], np.int64).view(U64)
        order = np.argsort(keys)
        m.common[kind] = keys[order], value(np.array([r[1] for r in rows], np.float64))[order]
    return m


def _found(keys: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(value or 0, whether the table has the key)."""
    if not len(table[0]):
        return np.zeros(len(keys)), np.zeros(len(keys), bool)
    at = np.searchsorted(table[0], keys)
    at[at == len(table[0])] = 0
    hit = table[0][at] == keys
    return np.where(hit, table[1][at], 0.0), hit


def _rest(keys: np.ndarray, first: np.ndarray, missing: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, key, count) of the missing keys, once a text."""
    at = np.flatnonzero(missing)
    doc = np.searchsorted(first, at, "right") - 1
    order = np.lexsort((keys[at], doc))
    d, k = doc[order], keys[at][order]
    if not len(d):
        return d, k, d
    new = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (k[1:] != k[:-1]))))
    return d[new], k[new], np.diff(np.append(new, len(d)))


def _lists(n_docs: int, rest: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.Array:
    d, k, n = rest
    ends = np.searchsorted(d, np.arange(n_docs + 1))
    items = pa.StructArray.from_arrays([pa.array(k.view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), items)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values)))
    return total[first[1:]] - total[first[:-1]]


SCORED = ("id long, uid long, n_tokens long, n_bytes long, known long, base double, score double, "
          "words array<struct<key:long,n:long>>, grams array<struct<key:long,n:long>>")


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score, n_bytes, bits_per_byte) for every row of ``docs``.

    score: log10 probability of the text, its end included; bits_per_byte: its code length by its bytes and its end.
    base_score, n_tokens, n_known: of the lower-cased words and one end. Null texts are empty; repeated rows each get
    a row; null ids stay null; whole texts of any length; other columns are ignored; an empty table gives no rows;
    without training every bit has probability 1/2.
    """
    spark = docs.sparkSession
    common = spark.sparkContext.broadcast(model.common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = common.value
        for b in batches:
            for lo, hi, part, own in _pieces(b.column(2)):
                w, first_w = _word_keys(part, own)
                g, first_g = _grams(part, own)
                base, known = _found(w, tables[WORD])
                value, hit = _found(g, tables[GRAM])
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), pa.array(np.diff(first_w) + 1), pa.array(np.diff(own)),
                    pa.array(_sums(known.astype(np.float64), first_w).astype(np.int64)), pa.array(_sums(base, first_w)), pa.array(_sums(value, first_g)),
                    _lists(hi - lo, _rest(w, first_w, ~known)), _lists(hi - lo, _rest(g, first_g, ~hit))], names=[x.split()[0] for x in SCORED.split(", ")])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("uid"), F.col(text_col).cast("string").alias("text"))
    found = rows.mapInArrow(run, SCORED).checkpoint()
    rest = lambda c: found.select("uid", F.explode(c).alias("x")).select("uid", "x.key", F.col("x.n").alias("m"))
    words = rest("words").join(model.of_kind(WORD), "key", "left").select(
        "uid", (F.col("m") * model.word_value(F.coalesce("n", F.lit(0)).cast("double"))).alias("base"),
        F.when(F.col("n") > 0, F.col("m")).otherwise(0).alias("known"), F.lit(0.0).alias("score"))
    grams = rest("grams").join(byte_scores(model.of_kind(GRAM), rest("grams").select("key").distinct(), model.top), "key").select(
        "uid", F.lit(0.0).alias("base"), F.lit(0).cast("long").alias("known"), (F.col("m") * F.col("value")).alias("score"))
    added = words.unionByName(grams).groupBy("uid").agg(*(F.sum(c).alias(f"{c}_rest") for c in ("base", "known", "score")))
    end = float(model.word_value(np.float64(model.docs)))
    plus = lambda c: F.col(c) + F.coalesce(f"{c}_rest", F.lit(0))
    return found.join(added, "uid", "left").select(
        F.col("id").alias("doc_id"), "n_tokens", (plus("known") + int(model.docs > 0)).alias("n_known"), (plus("base") + end).alias("base_score"),
        plus("score").alias("score"), "n_bytes", (-plus("score") * F.lit(LOG10 / LOG2) / (F.col("n_bytes") + 1)).alias("bits_per_byte"))


def is_held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5, is 1; a null id is the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("")).cast("binary")) % 5 == 1
