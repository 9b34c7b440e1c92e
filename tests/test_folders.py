"""Folders per user written by the tasks: the same folders and rows as Spark's writer, whole or not at all, listed as written."""

import os
from types import SimpleNamespace

import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from encore.operators import etl
from encore.plans import jobs
from encore.plans import queries_ingest as QI
from encore.sources import folders, raw, sinks
from test_landing import play_rows, same

ODD = [None, "", folders.NO_VALUE, "a b", "a/b", "a:b=c", "50%", "%41", "{x}[y]^", "é\n\t\x7f", "'q\"", "#?*\\", "~,;&"]


def odd_rows(spark):
    rows = [(u, i, None if i == 2 else f"x{i}", f"2024-01-01 00:00:0{i}.123456" if i < 3 else None) for u in ODD for i in range(4)]
    df = spark.createDataFrame(rows, "user_id string, n int, s string, at string")
    return df.select("user_id", "n", "s", F.col("at").cast("timestamp").alias("at"), F.col("at").cast("timestamp_ntz").alias("near"),
                     (F.col("n") * 1.5).alias("d"), F.array("s").alias("l"), F.lit(None).cast("timestamp").alias("never"))


def names(path):
    return sorted(d for d in os.listdir(path) if d.startswith("user_id="))


def files(path):
    return [f"{path}/{d}/{f}" for d in names(path) for f in os.listdir(f"{path}/{d}")]


def test_odd_users_have_the_folders_and_rows_of_sparks_writer(spark, tmp_dir):
    df = odd_rows(spark)
    old = f"{tmp_dir}/old"
    df.where(F.col("user_id") != folders.NO_VALUE).unionByName(df.where("user_id is null")).write.partitionBy("user_id").parquet(old)
    new = sinks.write_per_user(df, f"{tmp_dir}/new", ["n"], new=True)
    assert names(new) == names(old) and os.listdir(tmp_dir).__len__() == 2 and "_SUCCESS" in os.listdir(new)
    read = spark.read.schema(df.schema).parquet(new)
    no_value = F.when((F.col("user_id") != "") & (F.col("user_id") != folders.NO_VALUE), F.col("user_id")).alias("user_id")
    assert same(read, df.select(*[c for c in df.columns if c != "user_id"], no_value))
    assert {f.name: f.dataType for f in spark.read.parquet(new).schema.fields} == {f.name: f.dataType for f in df.schema.fields}   # types from the files
    assert all("arrow" in pq.read_metadata(f).created_by for f in files(new))   # not through Hadoop's file system


@pytest.mark.parametrize("max_records", [7, 50, 10_000])
def test_a_users_rows_follow_each_other_over_batches_and_files(spark, tmp_dir, max_records):
    """A hot user fills several batches and files; every file is sorted and bounded."""
    rows = spark.range(25_000).select(F.when(F.col("id") < 24_000, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 40)).alias("user_id"),
                                      (F.col("id") * 7919 % 25_000).alias("n"))
    rows = rows.where("user_id != 'hot' or n % 20 = 0") if max_records < 1000 else rows
    path = sinks.write_per_user(rows, f"{tmp_dir}/t", ["n"], max_records=max_records, new=True)
    assert same(spark.read.schema("n bigint, user_id string").parquet(path), rows)
    for f in files(path):
        n = pq.ParquetFile(f).read(["n"])["n"].to_pylist()
        assert len(n) <= max_records and n == sorted(n)


def test_small_row_groups_keep_all_rows_and_ranges(spark, tmp_dir, monkeypatch):
    """A file of many row groups; its range of times is that of all of them."""
    monkeypatch.setattr(folders._writer, "__defaults__", (*folders._writer.__defaults__[:2], 1, 2))
    df = spark.range(40_000, numPartitions=1).select(F.lit("u").alias("user_id"), F.timestamp_seconds("id").alias("at"))
    listed = sinks.write_per_user_listed(df, f"{tmp_dir}/t", ["at"], new=True)
    groups = [pq.read_metadata(f).num_row_groups for f in files(f"{tmp_dir}/t")]
    assert max(groups) > 1
    row = listed.agg(F.sum("records"), F.min("at_min").cast("long"), F.max("at_max").cast("long")).first()
    assert tuple(row) == (40_000, 0, 39_999)


def test_the_list_is_what_the_table_holds(spark, tmp_dir):
    listed = sinks.write_per_user_listed(odd_rows(spark), f"{tmp_dir}/t", ["n"], new=True)
    assert listed.schema == folders.written_schema(odd_rows(spark).schema, "user_id")
    times = ["at", "near", "never"]
    table = spark.read.schema(odd_rows(spark).schema).parquet(f"{tmp_dir}/t")
    a = listed.groupBy("user_id").agg(F.sum("records").alias("n"), *[f(f"{c}_{e}").alias(f"{c}_{e}") for c in times for e, f in (("min", F.min), ("max", F.max))])
    b = table.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{c}_{e}") for c in times for e, f in (("min", F.min), ("max", F.max))])
    assert same(a, b) and sorted(r.file for r in listed.collect()) == sorted(os.path.basename(f) for f in files(f"{tmp_dir}/t"))
    assert listed.agg(F.sum("bytes")).first()[0] == sum(map(os.path.getsize, files(f"{tmp_dir}/t")))


def test_a_failed_write_leaves_nothing(spark, tmp_dir):
    rows = play_rows(spark).withColumn("n", F.when(F.col("user_id") == "7", F.raise_error(F.lit("no")).cast("int")).otherwise(1))
    with pytest.raises(Exception, match="no"):
        sinks.write_per_user(rows, f"{tmp_dir}/t", ["played_at"], new=True)
    assert os.listdir(tmp_dir) == []


def test_a_table_that_is_there_is_not_replaced(spark, tmp_dir):
    rows = play_rows(spark).where("user_id is not null")
    path = sinks.write_per_user(rows, f"{tmp_dir}/t", ["played_at"], new=True)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        sinks.write_per_user(rows.limit(1), path, ["played_at"], new=True)
    assert same(spark.read.schema(rows.schema).parquet(path), rows)


def test_a_table_without_rows(spark, tmp_dir):
    rows = play_rows(spark)
    listed = sinks.write_per_user_listed(rows.where("false"), f"{tmp_dir}/t", ["played_at"], new=True)
    assert os.listdir(f"{tmp_dir}/t") == ["_SUCCESS"] and listed.count() == 0
    assert spark.read.schema(rows.schema).parquet(f"{tmp_dir}/t").count() == 0


def test_only_local_paths_are_written_by_the_tasks(spark):
    assert [folders.local_path(spark, p) for p in ("/a/b", "file:/a/b", "file:///a/b", "hdfs://h/a", "s3a://b/a", "viewfs:/a", "file://h/a", "a/b")] == \
        ["/a/b", "/a/b", "/a/b", None, None, None, None, None]


@pytest.mark.parametrize("quarantine", [False, True])
def test_reports_of_a_new_table_open_none_of_its_files(spark, tmp_dir, quarantine):
    """One small file a user: the reports came from opening each of them again."""
    rows = play_rows(spark).withColumn("played_at", F.when(F.col("user_id") == "5", "bad").otherwise(F.col("played_at")))
    root = raw.stage_plays_csv(rows.unionByName(rows), f"{tmp_dir}/raw", grouped=True)
    res = jobs.run_job(spark, "user_tracks", root, f"{tmp_dir}/out", new=True, grouped=True, quarantine=f"{tmp_dir}/q" if quarantine else None)
    assert "table" not in vars(res)   # its folders are listed only when it is asked for
    assert not [f for f in res.quality.inputFiles() + res.outcome.inputFiles() if f"{tmp_dir}/out" in f]
    assert same(res.quality, jobs.table_quality("user_tracks", res.rows, res.table))
    assert same(res.table.drop("processed_at"), etl.clean_plays(res.rows).drop("processed_at").where(F.col("user_id") != folders.NO_VALUE)
                .unionByName(etl.clean_plays(res.rows).drop("processed_at").where(F.col("user_id") == folders.NO_VALUE).withColumn("user_id", F.lit(None))))
    assert res.outcome.where("status = 'processed'").count() == 60


def test_the_catalog_is_scored_by_many_tasks(spark, tmp_dir, monkeypatch):
    """The artists are few bytes, so a scan made one task of them."""
    spark.range(1000).select(F.col("id").alias("p_partkey"), F.lit("x").alias("p_name"), (F.col("id") % 50).cast("int").alias("p_size")).coalesce(1).write.parquet(f"{tmp_dir}/part.parquet")
    seen = []
    monkeypatch.setattr(QI, "_job", lambda *a: SimpleNamespace(path="/x"))
    monkeypatch.setattr(QI.sinks, "write_catalog", lambda df: seen.append(df) or "/x-1")
    monkeypatch.setattr(QI.catalog, "build_catalog", lambda spark, db, at, replace: sorted(at))
    monkeypatch.setattr(QI.catalog, "drop_database", lambda *a: None)
    assert QI.s13_catalog_build(spark, tmp_dir) == sorted([*jobs.JOBS, "artists_catalog"])
    assert seen[0].rdd.getNumPartitions() == sinks.TASKS_A_CORE * spark.sparkContext.defaultParallelism and seen[0].count() == 990
