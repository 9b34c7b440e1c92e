"""Robust scaling and K-means.

Exact, interpolated quartiles (trap T22: Spark ML's ``RobustScaler`` uses
approximate, non-interpolated quantiles and maps a zero range to 0) without
gathering a column into one task. Equal values are counted first (combined
before the shuffle, so a value that a third of all rows share is one row), the
distinct values fall into buckets between approximate quantiles, prefix sums of
the bucket counts give the ranks at which each bucket starts, and only the
buckets that hold a wanted rank are sorted. Approximate borders decide how the
work is split, never the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.session import checkpoint_dir

# Clustering features and K-means settings of the reference.
CLUSTER_FEATURES = ["avg_popularity", "daily_listening_intensity", "artist_diversity", "night_preference_ratio",
                    "weekend_preference_ratio", "exploration_ratio", "like_ratio", "popularity_variance",
                    "peak_hour"]
K = 5
SEED = 42
RESTARTS = 20
MAX_ITER = 500
QUANTILES = (0.25, 0.5, 0.75)
#: A restart whose centres move less has settled (scaled units). Points that first centres are drawn from.
SETTLED = 1e-9
START_SAMPLE = 2000


def value_counts_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, v, cnt): how often each non-null value of each column occurs."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in cols])
    return df.select(F.inline(pairs)).filter(F.col("v").isNotNull()).groupBy("feature", "v").agg(F.count(F.lit(1)).alias("cnt"))


def exact_quantiles(df: DataFrame, cols: list[str], probs=QUANTILES, buckets: int = 64) -> DataFrame:
    """(feature, p, q): linear-interpolated quantiles, exact, computed without a single-task gather."""
    checkpoint_dir(df.sparkSession)
    counts = value_counts_long(df, cols).checkpoint(eager=True)      # counted values, read three times below
    cuts = [i / buckets for i in range(1, buckets)] or [0.5]
    borders = counts.groupBy("feature").agg(F.percentile_approx("v", cuts, 1000).alias("borders"), F.sum("cnt").alias("n"))
    placed = counts.join(F.broadcast(borders), "feature").select(
        "feature", "v", "cnt", "n", F.size(F.filter("borders", lambda b: b < F.col("v"))).alias("bucket"))
    w = Window.partitionBy("feature").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy("feature", "bucket").agg(F.sum("cnt").alias("held"), F.first("n").alias("n"))
              .withColumn("start", F.coalesce(F.sum("held").over(w), F.lit(0))))
    # target ranks (0-based) bracketing each quantile position h = (n - 1) * p
    h = F.explode(F.array(*[F.struct(F.lit(float(p)).alias("p"), ((F.col("n") - 1) * F.lit(float(p))).alias("h")) for p in probs]))
    targets = borders.select("feature", h.alias("t")).select("feature", "t.p", "t.h", F.explode(F.array_distinct(F.array(
        F.floor("t.h").cast("bigint"), F.ceil("t.h").cast("bigint")))).alias("rank"))
    # at most columns x probabilities x 2 rows, found among columns x buckets rows
    wanted = starts.join(F.broadcast(targets), "feature").filter(
        (F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("start") + F.col("held")))
    needed = wanted.select("feature", "bucket", "start").distinct()
    inside = Window.partitionBy("feature", "bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (placed.select("feature", "bucket", "v", "cnt").join(F.broadcast(needed), ["feature", "bucket"])
              .withColumn("upto", F.col("start") + F.sum("cnt").over(inside)))
    picked = ranked.join(F.broadcast(wanted.select("feature", "bucket", "p", "h", "rank")), ["feature", "bucket"]).filter(
        (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("cnt")))
    agg = picked.groupBy("feature", "p", "h").agg(
        F.min_by("v", "rank").alias("v_lo"), F.max_by("v", "rank").alias("v_hi"), F.min("rank").alias("r_lo"))
    return agg.select("feature", "p", (F.col("v_lo") + (F.col("h") - F.col("r_lo")) * (F.col("v_hi") - F.col("v_lo")))
                      .alias("q"))


def robust_scaling_params(features: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(feature, center, scale) with scale = IQR, or 1 when the IQR is 0."""
    cols = cols or CLUSTER_FEATURES
    q = exact_quantiles(features, cols)
    piv = q.groupBy("feature").agg(*[F.max(F.when(F.col("p") == p, F.col("q"))).alias(f"q{int(p * 100)}")
                                     for p in QUANTILES])
    iqr = F.col("q75") - F.col("q25")
    return piv.select("feature", F.col("q50").alias("center"),
                      F.when(iqr == 0, F.lit(1.0)).otherwise(iqr).alias("scale"))


def scaling_of(features: DataFrame, cols: list[str] | None = None) -> dict[str, tuple[float, float]]:
    """{feature: (median, IQR)}: 9 x 2 numbers, the scaler's state."""
    cols = cols or CLUSTER_FEATURES
    found = {r["feature"]: (float(r["center"]), float(r["scale"])) for r in robust_scaling_params(features, cols).collect()}
    return {c: found.get(c, (0.0, 1.0)) for c in cols}


def _scaled(c: str, params: tuple[float, float]) -> Column:
    return (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.lit(params[0])) / F.lit(params[1])


def robust_scale(features: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Scaled columns ``<c>_scaled`` = (x - median) / IQR, the fitted parameters as literals."""
    return features.select(*features.columns, *[_scaled(c, p).alias(f"{c}_scaled") for c, p in scaling_of(features, cols).items()])


@dataclass(frozen=True)
class KMeansFit:
    """The winning restart: its centres in scaled units, training cost, seed offset, and the scaling (centre, scale) a feature."""

    cols: list[str]
    scaling: dict[str, tuple[float, float]]
    centers: np.ndarray
    cost: float
    restart: int
    iterations: int

    def pipeline(self) -> PipelineModel:
        """Scaling and nearest centre as a Spark ML model that can be saved, loaded and applied to other users.

        Adds ``<c>_scaled`` and ``cluster`` (ties go to the lower number); NULL features count as 0.
        """
        scaled = ", ".join(f"(coalesce(cast(`{c}` as double), 0.0D) - {m!r}D) / {s!r}D as `{c}_scaled`" for c, (m, s) in self.scaling.items())
        far = ", ".join(" + ".join(f"pow(`{c}_scaled` - ({float(v)!r}D), 2)" for c, v in zip(self.cols, center, strict=True)) for center in self.centers)
        steps = [f"SELECT *, {scaled} FROM __THIS__", f"SELECT *, array({far}) AS _far FROM __THIS__",
                 "SELECT * EXCEPT (_far), cast(array_position(_far, array_min(_far)) - 1 as int) AS cluster FROM __THIS__"]
        return PipelineModel([SQLTransformer(statement=x) for x in steps])


def _start_centers(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++ over the sample: each further centre is drawn with a chance that grows with its squared distance."""
    rng = np.random.default_rng(seed)
    picked = [sample[rng.integers(len(sample))]]
    near = ((sample - picked[0]) ** 2).sum(1)
    while len(picked) < min(k, len(sample)):
        picked.append(sample[rng.choice(len(sample), p=near / near.sum())])
        near = np.minimum(near, ((sample - picked[-1]) ** 2).sum(1))
    return np.array(picked)


def _lloyd_step(points: DataFrame, centers: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """One pass over all points for every centre set: {set: (members of each centre, their sums, cost)}."""
    d = next(iter(centers.values())).shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = {r: np.zeros(len(c), np.int64) for r, c in centers.items()}
        total, cost = {r: np.zeros(c.shape) for r, c in centers.items()}, dict.fromkeys(centers, 0.0)
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            own = (x ** 2).sum(1)
            for r, c in centers.items():
                far = own[:, None] - 2 * x @ c.T + (c ** 2).sum(1)
                label = far.argmin(1)
                member = np.zeros((len(x), len(c)))
                member[np.arange(len(x)), label] = 1
                n[r] += member.sum(0).astype(np.int64)
                total[r] += member.T @ x
                cost[r] += float(np.maximum(far[np.arange(len(x)), label], 0).sum())
        rows = [{"r": r, "c": k, "n": int(n[r][k]), "cost": cost[r] if k == 0 else 0.0, "total": total[r][k].tolist()} for r in centers for k in range(len(centers[r]))]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("r", pa.int32()), ("c", pa.int32()), ("n", pa.int64()), ("cost", pa.float64()), ("total", pa.list_(pa.float64()))]))

    found = points.mapInArrow(run, "r int, c int, n long, cost double, total array<double>")
    rows = found.groupBy("r", "c").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), F.array(*[F.sum(F.col("total")[j]) for j in range(d)]).alias("total")).collect()
    out = {r: (np.zeros(len(c), np.int64), np.zeros(c.shape), 0.0) for r, c in centers.items()}
    for row in rows:
        n, total, cost = out[row.r]
        n[row.c], total[row.c] = row.n, row.total
        out[row.r] = n, total, cost + row.cost
    return out


def _restart_order(fit) -> tuple:
    """Lowest cost first, compared at 10 significant digits: restarts that reach the same
    clustering (labels permuted) differ only in the last bits of their summed cost, and
    must tie so the earliest seed wins on every run."""
    cost, i = fit
    return (float(f"{cost:.10g}") if math.isfinite(cost) else math.inf, i)


def fit_kmeans(features: DataFrame, k: int = K, seed: int = SEED, restarts: int = RESTARTS, max_iter: int = MAX_ITER,
               cols: list[str] | None = None) -> KMeansFit:
    """Lloyd's K-means on the robust-scaled features, all restarts side by side in one pass an iteration.

    Each pass is one aggregation over the (checkpointed, persisted) points that moves the centres of every restart not
    yet settled; a restart has settled when none of its centres moves by more than ``SETTLED``. The driver keeps
    restarts x k centres. First centres come from k-means++ on the ``START_SAMPLE`` distinct points with the least
    hashes; everything after runs over all points. A centre without members stays where it is. Lowest cost wins, ties
    (10 significant digits) go to the earlier seed. Labels are not comparable to other implementations.
    """
    cols = cols or CLUSTER_FEATURES
    scaling = scaling_of(features, cols)
    point = F.array(*[_scaled(c, scaling[c]) for c in cols])
    checkpoint_dir(features.sparkSession)
    points = features.select(point.alias("x")).checkpoint(eager=True).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        some = points.distinct().orderBy(F.xxhash64(F.lit(seed), "x"), "x").limit(START_SAMPLE).collect()
        if not some:
            raise ValueError("K-means needs at least one row")
        sample = np.array([r.x for r in some])
        centers = {r: _start_centers(sample, k, seed + r) for r in range(max(1, restarts))}
        moving, cost, passes = set(centers), {}, 0
        while moving:
            passes += 1
            for r, (n, total, own) in _lloyd_step(points, {r: centers[r] for r in sorted(moving)}).items():
                cost[r] = own
                new = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centers[r])
                if passes > max_iter or np.abs(new - centers[r]).max() <= SETTLED:
                    moving.discard(r)
                else:
                    centers[r] = new
    finally:
        points.unpersist()
    best = min((cost[r], r) for r in centers) if len(centers) == 1 else min(((cost[r], r) for r in centers), key=_restart_order)
    return KMeansFit(cols, scaling, centers[best[1]], best[0], best[1], passes)


def kmeans_clusters(features: DataFrame, k: int = K, seed: int = SEED, restarts: int = RESTARTS,
                    max_iter: int = MAX_ITER, cols: list[str] | None = None) -> tuple[DataFrame, KMeansFit]:
    """(features with ``cluster``, the fit); the labels are those of the fit's stored form.

    The features are checkpointed first: scaling, points, labels and what is asked of the labels all read them."""
    checkpoint_dir(features.sparkSession)
    features = features.checkpoint()
    fit = fit_kmeans(features, k, seed, restarts, max_iter, cols)
    return fit.pipeline().transform(features).select(*features.columns, "cluster"), fit


def cluster_check(clustered: DataFrame, fit: KMeansFit) -> DataFrame:
    """Per row whether its cluster's mean is the nearest one, and whether the fit's cost is the sum of squares around the
    means; both recomputed from the labels (k x features means reach the driver)."""
    rows = clustered.select("*", *[_scaled(c, fit.scaling[c]).alias(f"_{j}") for j, c in enumerate(fit.cols)])
    means = {r.cluster: [r[f"_{j}"] for j in range(len(fit.cols))] for r in rows.groupBy("cluster").agg(*[F.avg(f"_{j}").alias(f"_{j}") for j in range(len(fit.cols))]).collect()}
    far = {k: sum((F.pow(F.col(f"_{j}") - F.lit(v), 2) for j, v in enumerate(m)), F.lit(0.0)) for k, m in sorted(means.items())}
    own = F.coalesce(*[F.when(F.col("cluster") == k, x) for k, x in far.items()])
    within = rows.agg(F.sum(own).alias("s")).first().s or 0.0
    return rows.select(*clustered.columns, (own <= F.least(*far.values(), F.lit(math.inf)) + 1e-6).alias("nearest"),
                       F.lit(abs(within - fit.cost) <= 1e-6 * max(within, 1.0)).alias("cost_matches"))


def cluster_centroids(clustered: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Size and mean of each clustering feature per cluster, in feature units."""
    cols = cols or CLUSTER_FEATURES
    return clustered.groupBy("cluster").agg(F.count(F.lit(1)).alias("users"),
                                            *[F.avg(c).alias(f"{c}_mean") for c in cols])
