"""Sinks (S10, S11, S12, S16) and their layout report.

* Per-user tables are clustered on ``user_id`` with the ``rebalance`` hint and
  written with ``partitionBy("user_id")`` under dynamic partition overwrite: one
  pass for all users, each user's folder replaced per run. ``rebalance`` (unlike
  ``repartition``) lets AQE split a hot user's partition over several tasks, so
  a user with a third of all rows does not become one task; files per user stay
  few and ``maxRecordsPerFile`` bounds their size (instead of the reference's
  one-file-per-user ``coalesce(1)``). Row order inside files comes from
  ``sortWithinPartitions`` (min/max skipping without a global sort).
* The artist catalog is recomputed in full and written with *static* overwrite
  (trap T20): dynamic mode would keep a stale copy of an artist that moved to a
  different (popularity_range, primary_genre) partition.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.session import scratch_path
from encore.sources import folders

MAX_RECORDS_PER_FILE = 5_000_000
#: Written folders cost tasks by their number, not by their bytes: so many tasks a core share them.
TASKS_A_CORE = 4
COALESCE = "spark.sql.adaptive.coalescePartitions.enabled"
#: For writes of a folder per user on a local file system (others don't look at it): without checksum files beside the files.
#: Where Hadoop has no native library, a file with them forks ``chmod`` five times, one without them once.
PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


@contextmanager
def many_folders(spark: SparkSession) -> Iterator[int]:
    """Inside, a ``rebalance`` to the yielded number of partitions keeps that number (AQE would merge them by bytes into
    a few tasks, each with thousands of folders to make); a hot partition is still split."""
    before = spark.conf.get(COALESCE, None)
    spark.conf.set(COALESCE, "false")
    try:
        yield max(TASKS_A_CORE * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    finally:
        spark.conf.unset(COALESCE) if before is None else spark.conf.set(COALESCE, before)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt over a few tasks a core: for rows that are few bytes but much work, which a scan cuts by bytes."""
    return df.repartition(TASKS_A_CORE * df.sparkSession.sparkContext.defaultParallelism)


def write_per_user(df: DataFrame, path: str, sort_cols: list[str], mode: str = "overwrite",
                   max_records: int = MAX_RECORDS_PER_FILE, new: bool = False) -> str:
    """S10 + K03: one folder per user, rows sorted inside files, snappy parquet.

    ``new`` says that ``path`` holds no table yet: then no user's folder has to be looked for, deleted and replaced, which
    the driver does one after the other; on a local file system the tasks then write the folders themselves (``folders``).
    """
    write_per_user_listed(df, path, sort_cols, mode, max_records, new)
    return path


def write_per_user_listed(df: DataFrame, path: str, sort_cols: list[str], mode: str = "overwrite",
                          max_records: int = MAX_RECORDS_PER_FILE, new: bool = False) -> DataFrame | None:
    """``write_per_user``; returns the list of the files written (``folders.written_schema``) where the tasks wrote them."""
    spark = df.sparkSession
    at = folders.local_path(spark, path) if new else None
    with many_folders(spark) as n:
        rows = df.hint("rebalance", n, "user_id").sortWithinPartitions("user_id", *sort_cols)
        if at and not os.path.exists(at):
            return folders.write_folders(rows, path, at, "user_id", max_records)
        writer = rows.write.mode("errorifexists") if new else rows.write.mode(mode).option("partitionOverwriteMode", "dynamic")
        (writer.option("maxRecordsPerFile", max_records).option("compression", "snappy").options(**PLAIN_FILES)
         .partitionBy("user_id").parquet(path))
    return None


def write_catalog(catalog: DataFrame, path: str | None = None,
                  partition_cols=("popularity_range", "primary_genre")) -> str:
    """Two-level partitioned catalog, static overwrite of the whole table."""
    path = path or scratch_path(catalog.sparkSession, "artists_catalog")
    (catalog.hint("rebalance", *partition_cols)
     .write.mode("overwrite").option("partitionOverwriteMode", "static")
     .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).option("compression", "snappy")
     .partitionBy(*partition_cols).parquet(path))
    return path


def partition_layout(df_read_back: DataFrame, partition_cols) -> DataFrame:
    """Files, rows and bytes per partition directory (from the scan's file metadata)."""
    per_file = (df_read_back
                .select(*partition_cols, F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_size").alias("bytes"))
                .groupBy(*partition_cols, "file").agg(F.count(F.lit(1)).alias("rows"), F.max("bytes").alias("bytes")))
    return per_file.groupBy(*partition_cols).agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Header CSV (no index column); the Parquet copy is the primary output."""
    df.write.mode(mode).option("header", True).csv(path)
    return path


def write_profiles(profiles: DataFrame, stats: DataFrame, path: str) -> tuple[str, str]:
    """The profile table as CSV, and its statistics beside it under ``<path>_cluster_stats``."""
    return write_csv(profiles, path), write_csv(stats.coalesce(1), f"{path}_cluster_stats")
