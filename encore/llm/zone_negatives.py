"""Operator 11, hard-negative mining over Hilbert-ordered blocks with zone maps.

Candidates are put in the order of a Hilbert curve through their widest dimensions, cut into blocks of ``BLOCK`` rows
and written as Parquet, one row a block, beside a zone map: least and largest component of every dimension, and which
labels occur. Interval arithmetic bounds every inner product with a block's rows: a positive component of the anchor
meets the dimension's largest value at best and its least at worst, a negative one the other way round. Anchors come
in groups of neighbours on the same curve. A group reads a block only if for one of its anchors the bounds let the
block hold a positive as good as those of the anchor's own block, or for one of its windows a score inside the window.

A window is all scores from 30 to 90 % of a positive's. Blocks of a group are dealt to cells of at most ``CELL``
blocks; inside a cell the most promising come first, and an anchor skips a block that cannot change its results.
Cells return their best rows, one ranked window merges them. Components are integers, so all sums are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.session import scratch_path

#: Rows of a block, anchors of a group, blocks of a cell, blocks of one part of the zone map.
BLOCK, GROUP, CELL, ZONES = 1024, 4096, 64, 4096
#: Dimensions and bits a dimension of the curve: 60 bits.
CURVE_DIMS, CURVE_BITS = 15, 4
N_POSITIVE, N_NEGATIVE, LOW, HIGH = 5, 10, 30, 90


# --- the curve ----------------------------------------------------------------------------------------

def hilbert(points: np.ndarray, bits: int = CURVE_BITS) -> np.ndarray:
    """Place of every row of non-negative integers below 2^bits on the Hilbert curve through their dimensions."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # from the axes to the transposed curve, from the highest bit down: invert or exchange low bits
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[dims - 1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= flip
    out = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def _matrix(rows: pa.Array, width: int) -> np.ndarray:
    """Lists of integers as a matrix, short ones padded with zeros."""
    size = np.diff(rows.offsets.to_numpy())
    out = np.zeros((len(rows), width), np.int64)
    out[np.arange(width)[None] < size[:, None]] = rows.flatten().to_numpy()
    return out


# --- vectors, blocks, zone maps -----------------------------------------------------------------------

def integer_rows(df: DataFrame, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | str = "label") -> DataFrame:
    """(vec_id, label, v array<long>): floor(scale * x) of every component as double.

    Rows with a null id, label or vector, an empty vector, or a null, NaN or infinite component take no part. Rows
    that share an id count as one, the least by label, then vector.
    """
    x, own = F.col(vector_col), (F.col(label) if isinstance(label, str) else label).cast("long")
    fine = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    v = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))
    rows = df.where(F.col(id_col).isNotNull() & own.isNotNull()).where(fine)
    return rows.groupBy(F.col(id_col).cast("long").alias("vec_id")).agg(F.min(F.struct(own.alias("label"), v.alias("v"))).alias("x")) \
        .select("vec_id", "x.label", "x.v")


def curve_order(vectors: DataFrame) -> tuple[DataFrame, int]:
    """``vectors`` with ``place``, their place on the curve, and the largest number of components.

    The curve runs through the dimensions with the widest spread, each cut into equal steps from its least to its
    largest value; both come from one aggregation over all rows.
    """
    at = vectors.select(F.posexplode("v").alias("d", "c"))
    stats = at.groupBy("d").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.stddev_pop("c").alias("spread")).collect()
    width = max((r.d for r in stats), default=-1) + 1
    used = sorted(sorted(stats, key=lambda r: (-r.spread, r.d))[:CURVE_DIMS], key=lambda r: r.d)
    dims, low = [r.d for r in used], np.array([r.low for r in used])
    span = np.array([max(r.high - r.low, 1) for r in used])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _matrix(b.column(2), width)[:, dims]
            steps = np.clip(((m - low) * (1 << CURVE_BITS)) // (span + 1), 0, (1 << CURVE_BITS) - 1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(hilbert(steps))], names=["vec_id", "label", "v", "place"])

    if not used:
        return vectors.withColumn("place", F.lit(0).cast("long")), 0
    return vectors.select("vec_id", "label", "v").mapInArrow(run, "vec_id long, label long, v array<long>, place long"), width


PACKED = "block long, n int, ids binary, labels binary, vectors binary, low array<long>, high array<long>, label_set array<long>"


def packed(rows: DataFrame, width: int, most: int) -> DataFrame:
    """Rows in curve order in blocks of at most ``most``: ids, labels and vectors as bytes, and their zone map."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors, k, pid = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, width), np.int64), 0, 0

        def block(n: int) -> pa.RecordBatch:
            v = vectors[:n]
            return pa.RecordBatch.from_pylist([{"block": pid << 32 | k, "n": n, "ids": ids[:n].tobytes(), "labels": labels[:n].tobytes(), "vectors": v.tobytes(),
                                                "low": v.min(0).tolist(), "high": v.max(0).tolist(), "label_set": np.unique(labels[:n]).tolist()}], PACKED_SCHEMA)

        for b in batches:
            if not b.num_rows:
                continue
            pid = b.column(3)[0].as_py()
            ids, labels = np.concatenate([ids, b.column(0).to_numpy()]), np.concatenate([labels, b.column(1).to_numpy()])
            vectors = np.concatenate([vectors, _matrix(b.column(2), width)])
            while len(ids) >= most:
                yield block(most)
                ids, labels, vectors, k = ids[most:], labels[most:], vectors[most:], k + 1
        if len(ids):
            yield block(len(ids))

    ordered = rows.repartitionByRange("place", "vec_id").sortWithinPartitions("place", "vec_id")
    return ordered.select("vec_id", "label", "v", F.spark_partition_id().cast("long").alias("pid")).mapInArrow(run, PACKED)


PACKED_SCHEMA = pa.schema([("block", pa.int64()), ("n", pa.int32()), *((c, pa.binary()) for c in ("ids", "labels", "vectors")),
                           *((c, pa.list_(pa.int64())) for c in ("low", "high", "label_set"))])


def write_blocks(rows: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """(blocks, zone map): both written to the shared folder and read again; the zone map is read without its blocks."""
    path = scratch_path(rows.sparkSession, "hilbert-blocks")
    packed(rows, width, BLOCK).write.parquet(path)
    stored = rows.sparkSession.read.parquet(path)
    return stored.select("block", "ids", "labels", "vectors"), stored.select("block", "low", "high", "label_set")


def _unpacked(r, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, labels, vectors) of a packed row; floats hold the integers exactly and multiply fast."""
    read = lambda x: np.frombuffer(x, np.int64)
    return read(r.ids), read(r.labels), read(r.vectors).reshape(-1, width).astype(np.float64)


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[query, block]: (least, largest) inner product that a block's intervals allow."""
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


# --- searches -----------------------------------------------------------------------------------------

def _tops(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, higher scores first, then smaller ids."""
    if len(score) > 4 * k:
        some = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
        return some[np.lexsort((ids[some], -score[some]))[:k]]
    return np.lexsort((ids, -score))[:k]


class Best:
    """The k best candidates so far of each of some queries."""

    def __init__(self, n: int, k: int):
        self.k, self.ids, self.scores = k, [np.zeros(0, np.int64)] * n, [np.zeros(0)] * n

    def floor(self, i: int) -> float:
        """The score that a further candidate has to reach (a tie may win by its id)."""
        return self.scores[i][-1] if len(self.scores[i]) == self.k else -np.inf

    def add(self, i: int, ids: np.ndarray, scores: np.ndarray) -> None:
        if len(ids):
            a, s = np.concatenate([self.ids[i], ids]), np.concatenate([self.scores[i], scores])
            top = _tops(s, a, self.k)
            self.ids[i], self.scores[i] = a[top], s[top]


def _members(df: DataFrame, key: str) -> DataFrame:
    """(key, row, vec_id) of packed rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for g, ids in zip(b.column(0), b.column(1), strict=True):
                own = np.frombuffer(ids.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), g.as_py())), pa.array(np.arange(len(own))), pa.array(own)], names=[key, "row", "vec_id"])

    return df.select(key, "ids").mapInArrow(run, f"{key} long, row long, vec_id long")


def _with_windows(groups: DataFrame, windows: DataFrame) -> DataFrame:
    """Groups with their anchors' windows (row, low, high), a few an anchor; groups without any go."""
    of = _members(groups, "grp").join(windows, "vec_id").groupBy("grp").agg(F.collect_list(F.struct("row", "low", "high")).alias("windows"))
    return groups.join(of, "grp").checkpoint()


def _needed(groups: DataFrame, zones: DataFrame, width: int, same: bool) -> DataFrame:
    """(grp, block, cell): blocks whose bounds meet a window of the group and whose labels allow it."""
    n_zones = max(1, -(-zones.count() // ZONES))
    shard = F.pmod(F.xxhash64("block"), F.lit(n_zones)).alias("shard")
    left = groups.select("grp", "labels", "vectors", "windows", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_zones - 1).cast("long"))).alias("shard"))
    right = zones.select(shard, "block", "low", "high", "label_set").groupBy("shard").agg(F.collect_list(F.struct("block", "low", "high", "label_set")).alias("zones"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                z = r.zones
                block = np.array([x["block"] for x in z])
                low, high = (np.array([list(x[c]) for x in z], np.float64).reshape(len(z), width) for c in ("low", "high"))
                labels, vectors = np.frombuffer(r.labels, np.int64), np.frombuffer(r.vectors, np.int64).reshape(-1, width).astype(np.float64)
                row, lo, hi = (np.array([w[c] for w in r.windows], np.float64) for c in ("row", "low", "high"))
                row = row.astype(np.int64)
                need, best = np.zeros(len(z), bool), np.full(len(z), -np.inf)
                has = {x: np.array([x in y["label_set"] for y in z]) for x in np.unique(labels).tolist()}
                many = np.array([len(y["label_set"]) > 1 for y in z])
                for a in range(0, len(row), 256):
                    s = slice(a, a + 256)
                    least, most = bounds(vectors[row[s]], low, high)
                    own = np.array([has[x] for x in labels[row[s]].tolist()])
                    may = (most >= lo[s, None]) & (least <= hi[s, None]) & (own if same else ~own | many)
                    need |= may.any(0)
                    best = np.maximum(best, np.where(may, np.minimum(most, hi[s, None]), -np.inf).max(0))
                at = np.flatnonzero(need)
                yield pd.DataFrame({"grp": r.grp, "block": block[at], "promise": best[at]})

    met = left.join(right, "shard").select("grp", "labels", "vectors", "windows", "zones").mapInPandas(run, "grp long, block long, promise double")
    # the most promising blocks of a group share its first cells
    return met.withColumn("cell", F.floor((F.row_number().over(Window.partitionBy("grp").orderBy(F.desc("promise"), "block")) - 1) / CELL).cast("int"))


def _search(groups: DataFrame, blocks: DataFrame, zones: DataFrame, width: int, same: bool, k: int) -> DataFrame:
    """(vec_id, low, high, cand, score): each window's k best candidates a cell, of the anchor's label or of others."""
    need = _needed(groups, zones, width, same).checkpoint()
    read = need.join(blocks, "block").select("grp", "cell", "block", "promise", "ids", "labels", "vectors")
    cells = need.select(F.col("grp").alias("of"), F.col("cell").alias("part")).distinct().join(groups, F.col("of") == F.col("grp"))

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(a) and len(b):
            g = next(a.itertuples())
            ids, labels, vectors = _unpacked(g, width)
            row, lo, hi = (np.array([w[c] for w in g.windows], np.float64) for c in ("row", "low", "high"))
            row = row.astype(np.int64)
            order = np.argsort(row, kind="stable")
            row, lo, hi = row[order], lo[order], hi[order]
            best, stop = Best(len(row), k), np.searchsorted(row, np.arange(len(ids) + 1))
            for r in b.sort_values(["promise", "block"], ascending=[False, True]).itertuples():
                cid, cl, cv = _unpacked(r, width)
                least, most = (x[:, 0] for x in bounds(vectors, cv.min(0)[None], cv.max(0)[None]))
                floor = np.array([best.floor(i) for i in range(len(row))])
                live = (most[row] >= np.maximum(lo, floor)) & (least[row] <= hi)
                members = np.unique(row[live])
                for s in range(0, len(members), 512):
                    some = members[s:s + 512]
                    for m, score in zip(some.tolist(), vectors[some] @ cv.T, strict=True):
                        fits = (cl == labels[m]) if same else (cl != labels[m])
                        fits &= cid != ids[m]
                        for i in range(stop[m], stop[m + 1]):
                            if live[i]:
                                at = np.flatnonzero(fits & (score >= max(lo[i], floor[i])) & (score <= hi[i]))
                                best.add(i, cid[at], score[at])
            for i in range(len(row)):
                out += [(int(ids[row[i]]), lo[i], hi[i], int(c), int(s)) for c, s in zip(best.ids[i], best.scores[i], strict=True)]
        return pd.DataFrame(out, columns=["vec_id", "low", "high", "cand", "score"]).astype({"vec_id": "int64", "low": "float64", "high": "float64", "cand": "int64", "score": "int64"})

    return cells.groupBy("of", "part").cogroup(read.groupBy("grp", "cell")).applyInPandas(run, "vec_id long, low double, high double, cand long, score long")


def _own_floors(blocks: DataFrame, asked: DataFrame, width: int, k: int) -> DataFrame:
    """(vec_id, low, high): a window from the k-th best score of the anchor's label in its own block upwards."""
    own = _members(blocks, "block").join(asked.select("vec_id"), "vec_id").groupBy("block").agg(F.collect_list("vec_id").alias("asked"))  # at most a block's rows

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                ids, labels, v = _unpacked(r, width)
                at, out = np.flatnonzero(np.isin(ids, r.asked)), []
                for s in range(0, len(at), 512):
                    for m, score in zip(at[s:s + 512].tolist(), v[at[s:s + 512]] @ v.T, strict=True):
                        fit = score[(labels == labels[m]) & (ids != ids[m])]
                        out.append((int(ids[m]), float(np.partition(fit, len(fit) - k)[len(fit) - k]) if len(fit) >= k else -np.inf, np.inf))
                yield pd.DataFrame(out, columns=["vec_id", "low", "high"])

    return blocks.join(own, "block").select("ids", "labels", "vectors", "asked").mapInPandas(run, "vec_id long, low double, high double")


def mine(vectors: DataFrame, anchors: DataFrame, n_positive: int = N_POSITIVE, n_negative: int = N_NEGATIVE, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors``: (vec_id, label, v), ids distinct (``integer_rows``); ``anchors``: some of these rows. An anchor's
    positives are the ``n_positive`` best other rows of its label (all, if fewer); for each the ``n_negative`` best rows
    of other labels with low * positive_score <= 100 * negative_score <= high * positive_score. Ties go to the smaller
    id. An anchor without another row of its label has no positives and no rows; a window without rows gives none;
    vectors shorter than the longest count as padded with zeros; extra columns are ignored; empty tables give no rows.
    """
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows, width = curve_order(vectors.select("vec_id", "label", "v"))
    if not width:
        return vectors.sparkSession.createDataFrame([], schema)
    blocks, zones = write_blocks(rows, width)
    asked = rows.join(anchors.select("vec_id").distinct(), "vec_id", "left_semi")
    groups = packed(asked, width, GROUP).select(F.col("block").alias("grp"), "ids", "labels", "vectors").checkpoint()
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "cand"))

    found = _search(_with_windows(groups, _own_floors(blocks, asked, width, n_positive)), blocks, zones, width, True, n_positive)
    positives = found.withColumn("rank", rank("vec_id")).where(F.col("rank") <= n_positive).select(
        "vec_id", F.col("cand").alias("positive_id"), F.col("score").alias("positive_score"),
        F.ceil(F.col("score") * low / F.lit(100)).cast("double").alias("low"), F.floor(F.col("score") * high / F.lit(100)).cast("double").alias("high")).checkpoint()
    windows = positives.where("low <= high").select("vec_id", "low", "high").distinct()

    met = _search(_with_windows(groups, windows), blocks, zones, width, False, n_negative)
    best = met.withColumn("rank", rank("vec_id", "low", "high")).where(F.col("rank") <= n_negative)
    return positives.join(best, ["vec_id", "low", "high"]).select(
        F.col("vec_id").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), F.col("cand").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
