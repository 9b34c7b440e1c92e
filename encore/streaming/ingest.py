"""Incremental play ingest with Structured Streaming.

* Z01: new CSV files only (file source + checkpoint) under an ``availableNow`` trigger, so a scheduler can run
  it every few hours and stop. Every cleaned row reaches the keyed merge, however late: a new user's old history
  or a delayed file is merged like any other, and overlapping pulls meet on the play key there. No watermark
  decides about rows; the state is the table itself.
* Z02: each micro-batch writes its cleaned rows as plain Parquet under ``batch_id=<n>``, replacing that folder, so
  a retried batch leaves what one run leaves. Reading applies the keep-one rule over all batches; the rule is
  associative, so the streamed table equals the batch rebuild (C01), whatever came when. ``compact`` is the scheduled
  job that rewrites the batches so far, deduplicated; reads then open its result and the batches after it.
* Z03: plays per user and hour, grouped from the same read: late rows correct their hour, nothing waits for a
  watermark, nothing is collected.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from encore.functions.time import DEFAULT_TZ, to_local
from encore.operators import etl
from encore.operators.dedup import keep_one
from encore.sources.raw import declared, folders, with_path_user
from encore.sources.schemas import RAW_PLAYS_DDL, TABLES

ROW_COLUMNS = ["user_id", "track_id", "artist_id", "album_id", "played_at_utc", "track_name", "artist_name",
               "album_name", "duration_ms", "popularity", "explicit", "played_at_local"]


def play_stream(spark: SparkSession, root: str, max_files_per_trigger: int | None = None, grouped: bool = False) -> DataFrame:
    """Raw CSV rows of all users as a stream (declared schema; user from the path, or from the row of grouped files)."""
    r = (spark.readStream.schema(StructType.fromDDL(declared(RAW_PLAYS_DDL, grouped))).option("header", True)
         .option("pathGlobFilter", "*.csv"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_path_user(r.csv(folders(root, grouped)), grouped)


def read_user_table(spark: SparkSession, path: str) -> DataFrame:
    """The per-user plays table with its declared schema (``user_id`` stays text)."""
    return spark.read.schema(TABLES["user_tracks"].schema).parquet(path)


def read_rows(spark: SparkSession, table: str, after: int | None = None) -> DataFrame:
    """Cleaned rows of all batches (after batch ``after``), copies included."""
    schema = StructType([f for f in TABLES["user_tracks"].schema.fields if f.name in ROW_COLUMNS] + [StructField("batch_id", LongType())])
    try:
        rows = spark.read.schema(schema).parquet(table)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], schema)
    rows = rows if after is None else rows.filter(F.col("batch_id") > after)
    return rows.select(*ROW_COLUMNS)


def read_plays(spark: SparkSession, table: str, compacted: str | None = None, upto: int | None = None) -> DataFrame:
    """The streamed plays table: one row a play. With a ``compact`` result (its path and last batch) only later batches are read beside it."""
    rows = read_rows(spark, table, upto if compacted else None)
    if compacted:
        rows = rows.unionByName(spark.read.schema(TABLES["user_tracks"].schema).parquet(compacted).select(*ROW_COLUMNS))
    return etl.finish_plays(rows, with_time=False)


def compact(spark: SparkSession, table: str, out: str, compacted: str | None = None, upto: int | None = None) -> int | None:
    """Scheduled job: write the plays of all batches so far, deduplicated, to ``out`` (a new folder); the last batch in it.

    Pass ``out`` and the number to later reads, and the earlier result to the next compaction. Batches that arrive
    meanwhile have greater numbers and stay outside.
    """
    last = read_batches(spark, table).agg(F.max("batch_id")).first()[0]
    if last is None:
        return upto
    (read_plays(spark, table, compacted, upto).hint("rebalance", "user_id").sortWithinPartitions("user_id", "played_at_utc")
     .write.mode("overwrite").option("maxRecordsPerFile", 5_000_000).parquet(out))
    return last


def read_batches(spark: SparkSession, table: str) -> DataFrame:
    """(batch_id) of the rows written, from the folder names; an absent table has none."""
    try:
        return spark.read.schema("batch_id long").parquet(table).select("batch_id")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "batch_id long")


def read_hourly(spark: SparkSession, table: str, compacted: str | None = None, upto: int | None = None) -> DataFrame:
    """The hourly counts of the streamed plays."""
    return hourly_counts(read_plays(spark, table, compacted, upto))


def hourly_counts(plays: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    """Plays per user and hour of deduplicated plays; plays without a time have no hour."""
    hour = F.date_trunc("HOUR", "played_at_utc")
    g = plays.filter(F.col("played_at_utc").isNotNull()).groupBy("user_id", hour.alias("hour_start_utc")).agg(
        F.count(F.lit(1)).alias("plays"))
    local = to_local("hour_start_utc", tz)
    return g.select("user_id", "hour_start_utc", local.alias("hour_start_local"), F.hour(local).alias("play_hour"), "plays")


def write_batch(batch: DataFrame, table: str, batch_id: int) -> None:
    """One micro-batch's cleaned rows as ``batch_id=<n>``; writing it again replaces the folder.

    Copies inside the batch go first (the keep-one rule is associative), so pulls that overlap store little twice.
    """
    rows = keep_one(batch.select(*ROW_COLUMNS), TABLES["user_tracks"].key)
    rows.write.mode("overwrite").option("maxRecordsPerFile", 5_000_000).parquet(f"{table}/batch_id={batch_id}")


def start_ingest(spark: SparkSession, root: str, table: str, checkpoint: str, available_now: bool = True,
                 max_files_per_trigger: int | None = None, grouped: bool = False) -> StreamingQuery:
    """Start the incremental ingest; ``availableNow`` processes what is there and stops."""
    stream = etl.clean_plays_rows(play_stream(spark, root, max_files_per_trigger, grouped))
    w = (stream.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, epoch: write_batch(df, table, epoch)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def ingest_available(spark: SparkSession, root: str, table: str, checkpoint: str, max_files_per_trigger: int | None = None,
                     grouped: bool = False) -> None:
    """Ingest all files that are there and wait."""
    q = start_ingest(spark, root, table, checkpoint, max_files_per_trigger=max_files_per_trigger, grouped=grouped)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
