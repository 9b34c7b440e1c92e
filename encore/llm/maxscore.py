"""Operator 4, exact top-k search: MaxScore over inverted lists of vector components.

A vector is a document whose terms are (dimension, sign) with the component's magnitude as impact; a query's
terms are its own (dimension, sign) with its magnitudes as weights, so a shared term adds weight * impact and a
term of the opposite sign takes as much away. The bound of a term is weight * the list's largest impact.
Terms are sorted by bound; the weakest, whose bounds sum to less than the score to beat, are non-essential: a
vector in no essential list cannot reach the top k. Essential lists are traversed; candidates are then probed in
the other dimensions, strongest bound first, as long as what is still possible keeps them competitive.

Spark deals vectors to (query block, shard) cells by hash; every cell holds at most a few thousand rows of each
side by construction, is one grouped task, and returns its best k a query; the shards' lists are merged by one
window whose ranking Spark also applies below the shuffle. One shard goes first: a query's k-th score there is a score
to beat in all others. Within a cell vectors come in blocks, so the score to beat rises from block to block. All
arithmetic is exact: in 64-bit integers, or in doubles where every sum stays below 2^53.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows aimed at in a cell: queries, candidates. Candidates in the first block of a cell; later ones hold WIDE times as many.
QUERIES, CANDIDATES, BLOCK, WIDE = 4096, 8192, 1024, 8
#: Lists that hold this share of a block are kept as a column of impacts (zeros included), others as places and impacts.
DENSE = 0.125


class Index:
    """Inverted lists of a block of integer vectors."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows, self.columns = ids, rows, np.ascontiguousarray(rows.T)
        n, d = rows.shape
        self.lists = []
        self.top = np.zeros((2, d), np.int64)  # largest impact by sign and dimension
        for s, side in enumerate((self.columns, -self.columns)):
            own = []
            for j in range(d):
                at = np.flatnonzero(side[j] > 0)
                own.append((None, np.maximum(side[j], 0)) if len(at) > DENSE * n else (at, side[j][at]))
                self.top[s, j] = side[j][at].max() if len(at) else 0
            self.lists.append(own)

    def search(self, q: np.ndarray, beat: float) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of all vectors with a score of at least ``beat`` (of all, if it is minus infinity)."""
        sign, weight = (q < 0).astype(np.int64), np.abs(q)
        dims = np.flatnonzero(weight)
        bound = weight[dims] * self.top[sign[dims], dims]
        order = np.argsort(bound, kind="stable")
        dims, bound = dims[order], bound[order]
        if beat == -math.inf or beat <= 0:  # vectors without a shared term can be among the best
            return np.arange(len(self.rows)), self.rows @ q
        weak = int(np.searchsorted(np.cumsum(bound), beat, "left"))  # their bounds sum to less than the score to beat
        gained = np.zeros(len(self.rows), np.int64)
        for j in dims[weak:]:
            at, impact = self.lists[sign[j]][j]
            if at is None:
                gained += weight[j] * impact
            else:
                gained[at] += weight[j] * impact
        rest = int(bound[:weak].sum())
        cand = np.flatnonzero((gained > 0) & (gained + rest >= beat))
        score = gained[cand]
        # what the essential dimensions take away, then the other dimensions, strongest bound first
        for j in dims[weak:]:
            score += np.minimum(self.columns[j][cand] * q[j], 0)
        keep = score + rest >= beat
        cand, score = cand[keep], score[keep]
        for j, b in zip(dims[:weak][::-1], bound[:weak][::-1], strict=True):
            score += self.columns[j][cand] * q[j]
            rest -= int(b)
            keep = score + rest >= beat
            cand, score = cand[keep], score[keep]
        return cand, score


def products(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products, a row each query; by doubles where these are exact."""
    largest = [max(-int(m.min()), int(m.max())) if m.size else 0 for m in (rows, queries)]
    if largest[0] * largest[1] * rows.shape[1] < 1 << 53:
        return (queries.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
    return queries @ rows.T


def search_cell(queries: tuple[np.ndarray, np.ndarray], vectors: tuple[np.ndarray, np.ndarray], k: int,
                least: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """(query id, vector id, score) of the best k a query, ties to the smaller vector id; own ids excluded.

    ``least`` holds a score for each query that k vectors elsewhere reach (minus infinity: none known); vectors
    below it are left out, those that equal it are kept.
    """
    qid, qs = queries
    least = np.full(len(qid), -math.inf) if least is None else least
    best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in qid]
    order = np.argsort(vectors[0], kind="stable")
    ids, rows = vectors[0][order], vectors[1][order]
    lo, width = 0, BLOCK
    while lo < len(ids):
        index = Index(ids[lo:lo + width], rows[lo:lo + width])
        beat = [max(int(own[-1]) if len(own) == k else -math.inf, floor) for (_, own), floor in zip(best, least.tolist(), strict=True)]
        open_at = [i for i, b in enumerate(beat) if b == -math.inf]
        whole = dict(zip(open_at, products(index.rows, qs[open_at]), strict=True)) if open_at else {}
        for i, q in enumerate(qs):
            at, score = (slice(None), whole[i]) if i in whole else index.search(q, beat[i])
            new = index.ids[at]
            other = new != qid[i]
            own_ids, own = best[i]
            own_ids, own = np.concatenate([own_ids, new[other]]), np.concatenate([own, score[other]])
            top = np.lexsort((own_ids, -own))[:k]
            best[i] = own_ids[top], own[top]
        lo, width = lo + width, BLOCK * WIDE
    return [(int(q), int(v), int(s)) for q, (a, b) in zip(qid, best, strict=True) for v, s in zip(a, b, strict=True)]


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """(vec_id, v array<long>): floor(scale * x) of every component as double.

    Rows with a null id or vector, an empty vector, or a null, NaN or infinite component take no part. Rows that
    share an id count as one, with the least of their vectors.
    """
    x = F.col(vector_col)
    fine = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    v = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))
    return df.where(F.col(id_col).isNotNull()).where(fine).groupBy(F.col(id_col).cast("long").alias("vec_id")).agg(F.min(v).alias("v"))


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of every query over all candidates.

    Both sides are (vec_id, v array<long>), ids distinct (``integer_vectors``). A query is no candidate of its own;
    ties go to the smaller vec_id; with fewer than k candidates all are returned, with none nothing. Vectors shorter
    than the longest count as padded with zeros. Extra columns are ignored, empty tables give an empty result.
    """
    n_q, n_c = queries.count(), candidates.count()
    width = candidates.unionByName(queries).agg(F.max(F.size("v"))).first()[0] or 1
    n_block, n_shard = max(1, math.ceil(n_q / QUERIES)), max(1, math.ceil(n_c / CANDIDATES))
    if n_q and n_c:  # at least as many cells as Spark has slots, for small inputs
        n_shard = max(n_shard, min(math.ceil(n_c / BLOCK), math.ceil(queries.sparkSession.sparkContext.defaultParallelism * 2 / n_block)))
    of = lambda salt, n: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = queries.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), of(1, n_block).alias("block"))
    c = candidates.select("vec_id", "v", of(2, n_shard).alias("shard"), every(n_block).alias("block"))

    def matrix(rows: pd.Series) -> np.ndarray:
        out = np.zeros((len(rows), width), np.int64)
        for i, r in enumerate(rows):
            out[i, :len(r)] = r
        return out

    def cell(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        least = a["least"].astype("float64").fillna(-math.inf).to_numpy()
        got = search_cell((a["query_id"].to_numpy(), matrix(a["q"])), (b["vec_id"].to_numpy(), matrix(b["v"])), k, least) if len(a) and len(b) else []
        return pd.DataFrame(got, columns=["query_id", "vec_id", "score"]).astype("int64")

    def cells(q: DataFrame, c: DataFrame) -> DataFrame:
        return q.groupBy("block", "shard").cogroup(c.groupBy("block", "shard")).applyInPandas(cell, "query_id long, vec_id long, score long")

    found = cells(q.select("*", F.lit(0).alias("shard"), F.lit(None).cast("double").alias("least")), c.where("shard = 0"))
    if n_shard > 1:
        found = found.checkpoint()  # at most k rows a query
        reached = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("score"))
        known = q.join(reached, "query_id", "left").withColumn("least", F.when(F.col("n") == k, F.col("score").cast("double")))
        others = F.explode(F.sequence(F.lit(1), F.lit(n_shard - 1))).alias("shard")
        found = found.unionByName(cells(known.select("query_id", "q", "block", others, "least"), c.where("shard > 0")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
