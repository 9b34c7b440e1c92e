"""K-means with all restarts in one pass, against plain Lloyd and Spark ML; the stored model."""

import glob
import json

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler

from encore.operators import clustering as CL

COLS = CL.CLUSTER_FEATURES


def users(spark, n=400, seed=5):
    rng = np.random.default_rng(seed)
    rows = [(f"u{i}", *[float(x) for x in rng.normal(loc=(i % 6) * 3.0, scale=1.5, size=len(COLS))]) for i in range(n)]
    return spark.createDataFrame(rows, ["user_id", *COLS]).repartition(4)


def lloyd(x, c):
    for _ in range(500):
        label = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
        new = np.array([x[label == k].mean(0) if (label == k).any() else c[k] for k in range(len(c))])
        if np.abs(new - c).max() <= CL.SETTLED:
            break
        c = new
    return c, ((x - c[label]) ** 2).sum()


def test_restarts_equal_plain_lloyd_and_are_no_worse_than_spark_ml(spark):
    df = users(spark)
    fit = CL.fit_kmeans(df, k=5, restarts=8)
    scaled = CL.robust_scale(df)
    x = np.array([list(r) for r in scaled.select(*[f"{c}_scaled" for c in COLS]).collect()])
    sample = np.array(sorted({tuple(r) for r in x.tolist()}))
    assert fit.centers.shape == (5, len(COLS)) and len(sample) == 400
    centers, cost = lloyd(x, fit.centers)  # settled: another step moves nothing
    assert np.abs(centers - fit.centers).max() < 1e-8 and abs(cost - fit.cost) < 1e-6 * cost
    vec = VectorAssembler(inputCols=[f"{c}_scaled" for c in COLS], outputCol="x").transform(scaled)
    assert fit.cost <= min(KMeans(k=5, seed=s, featuresCol="x").fit(vec).summary.trainingCost for s in (1, 2, 3)) * (1 + 1e-9)
    checked = CL.cluster_check(*CL.kmeans_clusters(df, k=5, restarts=8)).collect()
    assert len(checked) == 400 and all(r.nearest and r.cost_matches for r in checked)


def test_labels_that_are_not_nearest_are_found(spark):
    df = users(spark, 60)
    clustered, fit = CL.kmeans_clusters(df, k=3, restarts=2)
    wrong = clustered.selectExpr("user_id", *COLS, "(cluster + 1) % 3 as cluster").limit(5).unionByName(clustered.exceptAll(clustered.limit(5)))
    assert not all(r.nearest for r in CL.cluster_check(wrong, fit).collect())


def test_one_job_an_iteration(spark, tmp_dir):
    df = users(spark, 100).checkpoint()
    seen = []
    old = CL._lloyd_step
    try:
        CL._lloyd_step = lambda points, centers: seen.append(sorted(centers)) or old(points, centers)
        fit = CL.fit_kmeans(df, k=3, restarts=6)
    finally:
        CL._lloyd_step = old
    assert len(seen) == fit.iterations and seen[0] == list(range(6))
    assert all(set(b) <= set(a) for a, b in zip(seen, seen[1:])) and len(seen[-1]) < 6  # settled restarts drop out


def test_a_stored_model_serves_new_users(spark, tmp_dir):
    df = users(spark)
    clustered, fit = CL.kmeans_clusters(df, k=5, restarts=3)
    fit.pipeline().write().overwrite().save(f"{tmp_dir}/m")
    model = PipelineModel.load(f"{tmp_dir}/m")
    want = {r.user_id: r.cluster for r in clustered.collect()}
    assert {r.user_id: r.cluster for r in model.transform(df).collect()} == want
    new = users(spark, 50, seed=9)
    got = {r.user_id: (r.cluster, [r[f"{c}_scaled"] for c in COLS]) for r in model.transform(new).collect()}
    assert len(got) == 50
    for cluster, x in got.values():
        assert cluster == ((np.array(x) - fit.centers) ** 2).sum(1).argmin()
    assert glob.glob(f"{tmp_dir}/m/stages/*") and json.loads(open(glob.glob(f"{tmp_dir}/m/metadata/part*")[0]).readline())["class"].endswith("PipelineModel")
    empty = spark.createDataFrame([("n", *[None] * len(COLS))], df.schema)
    assert model.transform(empty).count() == 1


def test_few_and_equal_points(spark):
    same = spark.createDataFrame([(f"u{i}", *[1.0] * len(COLS)) for i in range(7)], ["user_id", *COLS])
    clustered, fit = CL.kmeans_clusters(same, k=5, restarts=2)
    assert {r.cluster for r in clustered.collect()} == {0} and fit.cost == 0 and len(fit.centers) == 1
    with pytest.raises(ValueError, match="at least one"):
        CL.fit_kmeans(same.limit(0))


def test_features_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    cols = CL.CLUSTER_FEATURES
    rows = spark.range(40).selectExpr("cast(id as string) user_id", *[f"cast((id * {j + 3}) % 11 as double) {c}" for j, c in enumerate(cols)])
    features = rows.mapInPandas(counted, rows.schema)
    clustered, fit = CL.kmeans_clusters(features, restarts=2)
    assert CL.cluster_check(clustered, fit).count() == 40 and seen.value == 40
