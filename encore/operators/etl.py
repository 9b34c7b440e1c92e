"""Cleaning pipelines for plays, likes, follows and top tracks.

Each function takes the raw rows of ALL users (``user_id`` is a column, taken
from the input folder by the readers) and returns the cleaned table in
registry column order. No action runs inside; the quality report is one
aggregation per table instead of the reference's repeated ``count()`` jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions.time import DEFAULT_TZ, calendar_fields, duration_minutes, parse_utc, season, to_local
from encore.operators.dedup import keep_one
from encore.sources.schemas import TABLES

# Default texts and numbers filled in by the reference.
PLAY_DEFAULTS = {"track_name": "Unknown Track", "artist_name": "Unknown Artist", "album_name": "Unknown Album",
                 "duration_ms": 0, "popularity": 0, "explicit": False}
TRACK_DEFAULTS = {"track_name": "Unknown Track", "album_id": "-1", "track_popularity": 0, "explicit": False,
                  "duration_ms": 0, "artists_id": "-1"}
FOLLOW_DEFAULTS = {"artist_id": "-1"}
SENTINEL = "-1"


def _fill(df: DataFrame, defaults: dict) -> DataFrame:
    return df.fillna({k: v for k, v in defaults.items() if k in df.columns})


def _with_processed_at(df: DataFrame, with_time: bool) -> DataFrame:
    return df.withColumn("processed_at", F.current_timestamp() if with_time else F.lit(None).cast("timestamp"))


def with_lineage(df: DataFrame, source: str, with_time: bool = True) -> DataFrame:
    """The source literal and the processing time beside the user taken from the input."""
    return _with_processed_at(df.withColumn("data_source", F.lit(source)), with_time)


def plays_valid(raw: DataFrame) -> F.Column:
    """Required keys present in the raw text."""
    return F.col("played_at").isNotNull() & F.col("track_id").isNotNull() & F.col("artist_id").isNotNull()


def clean_plays_rows(raw: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    """P01, P08, P09, P04, P05 before dedup (one row per valid raw row)."""
    df = raw.filter(plays_valid(raw))
    df = df.select(
        "user_id", "track_id", "artist_id", "album_id",
        parse_utc("played_at").alias("played_at_utc"),
        *[F.trim(F.col(c)).alias(c) for c in ("track_name", "artist_name", "album_name")],
        F.col("duration_ms").cast("bigint").alias("duration_ms"), "popularity", "explicit",
    )
    df = df.withColumn("played_at_local", to_local("played_at_utc", tz))
    return _fill(df, PLAY_DEFAULTS)


def clean_plays(raw: DataFrame, tz: str = DEFAULT_TZ, with_time: bool = True) -> DataFrame:
    """Raw play rows (all users) -> user_tracks.

    Dedup key (user_id, track_id, played_at_utc) keeps the row that sorts first
    on the remaining columns (U03/W03); calendar fields come from the local time.
    """
    return finish_plays(clean_plays_rows(raw, tz), with_time)


def finish_plays(rows: DataFrame, with_time: bool = True) -> DataFrame:
    """U03/W03 dedup + P11, P10, P12, P13, P14 on cleaned rows (shared by batch and stream)."""
    spec = TABLES["user_tracks"]
    d = keep_one(rows, spec.key)
    cal = calendar_fields("played_at_local")
    d = d.select("*", *[v.alias(k) for k, v in cal.items()],
                 duration_minutes("duration_ms").alias("duration_minutes"))
    d = d.withColumn("season", season("play_month"))
    return _with_processed_at(d, with_time).select(*spec.columns)


def first_or_sentinel(arr) -> F.Column:
    """First element of an id array, '-1' for NULL/empty arrays."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.when(a.isNotNull() & (F.size(a) > 0), F.get(a, 0)).otherwise(F.lit(SENTINEL))


def clean_likes(raw: DataFrame, tz: str = DEFAULT_TZ, with_time: bool = True) -> DataFrame:
    """Raw likes (all users) -> likes. ``added_at`` has no millis (both patterns are read)."""
    df = raw.select(
        "user_id", "track_id", "album_id", "explicit", F.col("duration_ms").cast("bigint").alias("duration_ms"),
        F.trim("track_name").alias("track_name"), "track_popularity",
        parse_utc("added_at").alias("added_at_utc"),
        first_or_sentinel("artists_id").alias("artists_id"))
    df = df.withColumn("added_at_local", to_local("added_at_utc", tz))
    df = _fill(df, TRACK_DEFAULTS)
    spec = TABLES["likes"]
    return _with_processed_at(keep_one(df, spec.key), with_time).select(*spec.columns)


def clean_follows(raw_ids: DataFrame, with_time: bool = True) -> DataFrame:
    """(user_id, artist_id) rows exploded from the documents -> followed_artists."""
    df = _fill(raw_ids.select("user_id", "artist_id"), FOLLOW_DEFAULTS)
    spec = TABLES["followed_artists"]
    return _with_processed_at(df.dropDuplicates(list(spec.key)), with_time).select(*spec.columns)


def clean_top_tracks(raw: DataFrame, with_time: bool = True) -> DataFrame:
    """Raw ranked tracks -> top_tracks; reads ``duration_ms`` or the writer's ``duration``."""
    dur = F.col("duration_ms")
    if "duration" in raw.columns:
        dur = F.coalesce(F.col("duration_ms"), F.col("duration"))
    df = raw.select(
        "user_id", "ith_preference", "track_id", "album_id", "explicit", dur.cast("bigint").alias("duration_ms"),
        F.trim("track_name").alias("track_name"), "track_popularity",
        first_or_sentinel("artists_id").alias("artists_id"))
    df = _fill(df, TRACK_DEFAULTS)
    spec = TABLES["top_tracks"]
    return _with_processed_at(keep_one(df, spec.key), with_time).select(*spec.columns)


def plays_quality_one_pass(raw: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    """A17 from the raw rows alone, in one read and two aggregations (no dedup sort, no join).

    The clean table keeps one row per dedup key (user_id, track_id, played_at_utc)
    among the valid raw rows, so the level-1 groups on that key that hold a valid
    row ARE the clean rows: their count is ``clean_records`` and their keys give
    the time range. Map-side partial aggregation collapses a group of copies
    (however hot) before the first shuffle.
    """
    valid = plays_valid(raw)
    keyed = raw.groupBy("user_id", "track_id", parse_utc("played_at").alias("played_at_utc")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("track_id").isNull()).alias("n_null_track"),
        F.count_if(valid).alias("n_valid"))
    clean = F.col("n_valid") > 0
    utc = F.when(clean, F.col("played_at_utc"))
    local = to_local(utc, tz)
    return keyed.groupBy("user_id").agg(
        F.sum("n").alias("raw_records"),
        F.sum("n_null_track").alias("null_track_ids"),
        F.sum("n_valid").alias("valid_records"),
        F.coalesce(F.sum(F.when(F.col("played_at_utc").isNull(), F.col("n_valid"))), F.lit(0)).alias("unparsed_times"),
        F.count_if(clean).alias("clean_records"),
        (F.sum("n_valid") - F.count_if(clean)).alias("duplicates_removed"),
        F.min(utc).alias("min_utc"), F.max(utc).alias("max_utc"),
        F.min(local).alias("min_local"), F.max(local).alias("max_local"))
