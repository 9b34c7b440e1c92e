"""Daily partial aggregates: what any trailing window needs, stored once per user and local day.

* ``hours``: per (user, day) plays, popularity sum and count, plays by hour, and HLL sketches of tracks and artists;
* ``tracks``: per (user, day, artist, track, tier) plays and popularity sum.

Both are partitioned by day. New plays, however late, change only their own days: ``update`` rebuilds those from the
plays and replaces their folders. A window of any length adds up its days; plays are not read. Distinct tracks and
artists are exact where ranked or shared out (tracks, artists are rows of ``tracks``); ``sketch_counts`` estimates them
from merged sketches alone, whose size does not grow with a user's plays.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from encore.functions import labels as L
from encore.operators import insights as I

#: log2 of a sketch's registers; the relative standard error is 1.04 / sqrt(2^12), 1.6 %; counts up to some hundreds are exact.
LG_K = 12
ERROR_BOUND = 3 * 1.04 / 2 ** (LG_K / 2)
WINDOWS = (7, 30, 90)


@dataclass(frozen=True)
class Daily:
    """The two tables; ``d`` is the local day."""

    hours: DataFrame
    tracks: DataFrame


def partials(plays: DataFrame) -> Daily:
    """Both tables from plays; plays without a time belong to no window and are left out."""
    dated = plays.withColumn("d", F.to_date(I.LOCAL)).filter(F.col("d").isNotNull())
    pop = F.col("popularity").cast("double")
    hours = dated.groupBy("user_id", "d").agg(
        F.count(F.lit(1)).alias("n"), F.sum(pop).alias("pop_sum"), F.count(pop).alias("pop_n"),
        F.array(*[F.count_if(F.col("play_hour") == h) for h in range(24)]).alias("by_hour"),
        F.hll_sketch_agg("track_id", LG_K).alias("track_sketch"), F.hll_sketch_agg("artist_id", LG_K).alias("artist_sketch"))
    tier = F.when(F.col("popularity").isNotNull(), L.popularity_tier("popularity")).alias("tier")
    tracks = dated.groupBy("user_id", "d", "artist_id", "artist_name", "track_id", tier).agg(F.count(F.lit(1)).alias("n"), F.sum(pop).alias("pop_sum"))
    return Daily(hours, tracks)


def _write(daily: Daily, path: str, overwrite: str) -> None:
    for name, df in (("hours", daily.hours), ("tracks", daily.tracks)):
        (df.hint("rebalance", "d").sortWithinPartitions("d", "user_id").write.mode("overwrite").option("partitionOverwriteMode", overwrite)
         .option("maxRecordsPerFile", 5_000_000).partitionBy("d").parquet(f"{path}/{name}"))


def build(plays: DataFrame, path: str) -> str:
    """Store the partials of all plays."""
    _write(partials(plays), path, "static")
    return path


def read(spark: SparkSession, path: str) -> Daily:
    return Daily(spark.read.parquet(f"{path}/hours"), spark.read.parquet(f"{path}/tracks"))


def update(plays: DataFrame, path: str, new: DataFrame) -> list:
    """Renew the days on which ``new`` rows (any with ``played_at_local``) fall, from all ``plays``; the days renewed.

    Only those days are read (their time bounds reach the scan) and only their folders are replaced; running it again
    gives the same tables. The driver learns the distinct days of the new rows.
    """
    days = sorted(r.d for r in new.select(F.to_date(I.LOCAL).alias("d")).where("d is not null").distinct().collect())
    if days:
        at = F.col(I.LOCAL)
        bound = (at >= F.lit(str(days[0])).cast("timestamp_ntz")) & (F.to_date(at) <= F.lit(str(days[-1])).cast("date"))
        _write(partials(plays.filter(bound & F.to_date(at).isin(days))), path, "dynamic")
    return days


# --- windows added up ---------------------------------------------------------------------------------

def _days(daily: Daily, as_of, days_back: int, user_id=None) -> DataFrame:
    return I._scope(daily.hours, user_id).filter(F.col("d") >= I._lo(as_of, days_back))


def _tracks(daily: Daily, as_of, days_back: int, user_id=None) -> DataFrame:
    return I._scope(daily.tracks, user_id).filter(F.col("d") >= I._lo(as_of, days_back))


def top_artists(daily: Daily, as_of=None, days_back: int = 90, limit: int = 10, user_id=None) -> DataFrame:
    """A01 from the partials; ties as ``insights.top_artists``."""
    per_track = _tracks(daily, as_of, days_back, user_id).groupBy("user_id", "artist_name", "track_id").agg(F.sum("n").alias("n"))
    agg = per_track.groupBy("user_id", "artist_name").agg(F.sum("n").alias("play_count"), F.count("track_id").alias("unique_tracks"))
    w = Window.partitionBy("user_id").orderBy(F.desc("play_count"), F.asc_nulls_last("artist_name"))
    return (agg.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)
            .select("user_id", "rank", "artist_name", "play_count", "unique_tracks"))


def _day_rows(daily: Daily, as_of, hourly_days: int, weekly_days: int, user_id=None, users=None) -> DataFrame:
    rows = _days(daily, as_of, max(hourly_days, weekly_days), user_id)
    in_h = F.col("d") >= I._lo(as_of, hourly_days)
    rows = rows.select("user_id", "d", "n", "pop_sum", "pop_n", *[F.when(in_h, F.col("by_hour")[h]).otherwise(0).alias(f"h{h}") for h in range(24)])
    return I._with_all_users(rows, daily.hours, users, user_id)


def _artist_rows(daily: Daily, as_of, days_back: int, user_id=None) -> DataFrame:
    known = _tracks(daily, as_of, days_back, user_id).filter(F.col("tier").isNotNull())
    return known.groupBy("user_id", "tier", "artist_id").agg(F.sum("n").alias("n"), F.sum("pop_sum").alias("pop_sum"))


def hourly_pattern(daily: Daily, as_of=None, days_back: int = 30, user_id=None, users: DataFrame | None = None) -> DataFrame:
    """A02 + J02 from the partials."""
    per_user = _day_rows(daily, as_of, days_back, days_back, user_id, users).groupBy("user_id").agg(*I._hourly_sums())
    return (per_user.select("user_id", F.posexplode("hourly").alias("hour", "play_count"))
            .select("user_id", F.col("hour").cast("int").alias("hour"), "play_count", L.hour_label("hour").alias("hour_label")))


def weekday_weekend(daily: Daily, as_of=None, days_back: int = 90, user_id=None, users: DataFrame | None = None) -> DataFrame:
    """A03 + J03 + A13 from the partials."""
    rows = _day_rows(daily, as_of, days_back, days_back, user_id, users).groupBy("user_id").agg(*I._weekly_cols(as_of, days_back))
    return rows.select("user_id", F.inline(F.array(*I._weekly_rows())))


def popularity_distribution(daily: Daily, as_of=None, days_back: int = 90, user_id=None, users: DataFrame | None = None) -> DataFrame:
    """A04 + J03 + A13 from the partials."""
    rows = I._with_all_users(_artist_rows(daily, as_of, days_back, user_id), daily.hours, users, user_id)
    return rows.groupBy("user_id").agg(*I._tier_cols()).select("user_id", F.inline(F.array(*I._tier_rows())))


def user_category_aggregates(daily: Daily, as_of=None, hourly_days: int = 30, weekly_days: int = 90, pop_days: int = 90, user_id=None,
                             users: DataFrame | None = None) -> DataFrame:
    """As ``insights.user_category_aggregates``, from the partials."""
    both = _day_rows(daily, as_of, hourly_days, weekly_days, user_id, users).unionByName(_artist_rows(daily, as_of, pop_days, user_id), allowMissingColumns=True)
    return both.groupBy("user_id").agg(*I._hourly_sums(), *I._weekly_cols(as_of, weekly_days), *I._tier_cols())


def sketch_counts(daily: Daily, as_of=None, windows: tuple[int, ...] = WINDOWS, user_id=None) -> DataFrame:
    """A11 at scale: (user_id, days_back, tracks, artists), estimates from the merged sketches of each window's days.

    One read of the widest window. The relative standard error is 1.04 / sqrt(2^LG_K); ``ERROR_BOUND`` is three of it.
    Users without a play in the widest window have no row, in a narrower one zeros.
    """
    aggs = []
    for k, days in enumerate(windows):
        inside = F.col("d") >= I._lo(as_of, days)
        for c in ("track", "artist"):
            merged = F.hll_union_agg(F.when(inside, F.col(f"{c}_sketch")))
            aggs.append(F.coalesce(F.hll_sketch_estimate(merged), F.lit(0)).alias(f"{c}{k}"))
    wide = _days(daily, as_of, max(windows), user_id).groupBy("user_id").agg(*aggs)
    rows = F.array(*[F.struct(F.lit(days).alias("days_back"), F.col(f"track{k}").cast("bigint").alias("tracks"), F.col(f"artist{k}").cast("bigint").alias("artists"))
                     for k, days in enumerate(windows)])
    return wide.select("user_id", F.inline(rows))
