"""Stored layouts that spare reads and shuffles: plays by local month and user bucket, tables bucketed by user.

* ``write_history``: plain Parquet under ``play_month=<yyyy-MM>/user_bucket=<b>``. A trailing window opens only its
  months, one user's window only that user's bucket (``history_scan``); the number of folders grows with months, not
  with users, and a hot user's bucket is split over several files.
* ``write_bucketed``: a table whose files are hashed and sorted by user. Aggregations and joins by user read it
  without an exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.functions.time import as_of_date, in_trailing_window

MONTH, BUCKET = "play_month_key", "user_bucket"
USER_BUCKETS = 16
#: Month of plays without a time: before all others, so no trailing window opens it.
NO_MONTH = "0000-00"


def user_bucket(user) -> Column:
    return F.pmod(F.xxhash64(F.col(user) if isinstance(user, str) else user), F.lit(USER_BUCKETS)).cast("int")


def write_history(plays: DataFrame, path: str) -> str:
    """Plays of all users by local month and user bucket, sorted by user and time inside a file."""
    keyed = plays.withColumns({MONTH: F.coalesce(F.date_format("played_at_local", "yyyy-MM"), F.lit(NO_MONTH)), BUCKET: user_bucket("user_id")})
    (keyed.hint("rebalance", MONTH, BUCKET).sortWithinPartitions(MONTH, BUCKET, "user_id", "played_at_utc")
     .write.mode("overwrite").option("partitionOverwriteMode", "static").option("maxRecordsPerFile", 5_000_000).partitionBy(MONTH, BUCKET).parquet(path))
    return path


def history_scan(history: DataFrame, as_of, days_back: int, user_id: str | None = None) -> DataFrame:
    """The plays of a trailing window (P03), of all users or one, from the folders that can hold them."""
    first = F.date_format(F.date_sub(as_of_date(as_of), int(days_back)), "yyyy-MM")
    out = history.filter((F.col(MONTH) >= first) & in_trailing_window("played_at_local", as_of, days_back))
    if user_id is not None:
        out = out.filter((F.col(BUCKET) == user_bucket(F.lit(str(user_id)))) & (F.col("user_id") == F.lit(str(user_id))))
    return out.drop(MONTH, BUCKET)


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int = USER_BUCKETS, by: str = "user_id") -> DataFrame:
    """Save ``df`` as ``table`` (database.name) in ``buckets`` files by hash of the user; the table, read back."""
    spark = df.sparkSession
    parts = df.repartition(buckets, by)  # one task a bucket, so one file a bucket
    parts.write.mode("overwrite").option("path", path).bucketBy(buckets, by).sortBy(by).saveAsTable(table)
    return spark.table(table)
