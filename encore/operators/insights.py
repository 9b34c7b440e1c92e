"""Per-user listening insights for a trailing window.

Every function computes ALL users in one distributed pass with ``user_id`` as a
column; a single-user answer is the same result plus ``user_id=...``.

Scale notes
* Category insights (hourly, weekday/weekend, popularity tiers) end in ONE
  ``groupBy(user_id)`` with conditional aggregates: map-side partial aggregation
  collapses a hot user before the shuffle, and the category "spine" (all 24
  hours, both day types, all three tiers with zeros) comes from exploding a
  fixed-size array per user, so no join and no cross product is needed.
  Distinct days / artists come from a (user, date) and a (user, tier, artist)
  pre-aggregation rather than COUNT(DISTINCT), so no Expand multiplies the plays.
* Top-k uses ``row_number`` + filter, which Catalyst turns into a partial
  ``WindowGroupLimit`` below the shuffle: each map task forwards at most k rows
  per user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.functions import labels as L
from encore.functions.time import as_of_date, in_trailing_window

LOCAL = "played_at_local"


def _scope(plays: DataFrame, user_id=None) -> DataFrame:
    return plays if user_id is None else plays.filter(F.col("user_id") == F.lit(str(user_id)))


def windowed(plays: DataFrame, as_of=None, days_back: int = 90, user_id=None) -> DataFrame:
    """User + trailing-window predicate (pushed to the scan as a timestamp bound)."""
    return _scope(plays, user_id).filter(in_trailing_window(LOCAL, as_of, days_back))


def top_artists(plays: DataFrame, as_of=None, days_back: int = 90, limit: int = 10, user_id=None) -> DataFrame:
    """Plays and distinct tracks per artist name, top ``limit`` per user.

    Tie-break T11: artist_name ascending after play_count descending.
    """
    agg = (windowed(plays, as_of, days_back, user_id)
           .groupBy("user_id", "artist_name")
           .agg(F.count(F.lit(1)).alias("play_count"), F.count_distinct("track_id").alias("unique_tracks")))
    w = Window.partitionBy("user_id").orderBy(F.desc("play_count"), F.asc_nulls_last("artist_name"))
    return (agg.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)
            .select("user_id", "rank", "artist_name", "play_count", "unique_tracks"))


def _with_all_users(rows: DataFrame, plays: DataFrame, users: DataFrame | None = None, user_id=None) -> DataFrame:
    """``rows`` plus one ``user_id``-only row per user, so that a user without plays in the window keeps a row of zeros.

    ``users`` is the user dimension (one row per user). Pass it in: a window insight then reads the window and the
    dimension only. Without it the users are taken from the whole play table's ``user_id`` column.
    """
    spine = _scope(users, user_id) if users is not None else plays
    return rows.unionByName(spine.select("user_id"), allowMissingColumns=True)


def hourly_pattern(plays: DataFrame, as_of=None, days_back: int = 30, user_id=None, users: DataFrame | None = None) -> DataFrame:
    """A02 + J02: plays per local hour, every user gets hours 0..23 (zeros filled)."""
    p = _scope(plays, user_id)
    recent = p.filter(in_trailing_window(LOCAL, as_of, days_back)).select("user_id", "play_hour")
    per_user = _with_all_users(recent, p, users, user_id).groupBy("user_id").agg(
        F.array(*[F.count_if(F.col("play_hour") == h) for h in range(24)]).alias("hourly"))
    return (per_user.select("user_id", F.posexplode("hourly").alias("hour", "play_count"))
            .select("user_id", F.col("hour").cast("int").alias("hour"), "play_count",
                    L.hour_label("hour").alias("hour_label")))


def _lo(as_of, days_back: int) -> F.Column:
    return F.date_sub(as_of_date(as_of), int(days_back))


# Distinct active days and distinct artists per category are counted in two
# levels instead of with conditional COUNT(DISTINCT), which Catalyst plans as an
# Expand copying every play once per distinct aggregate. Level 1 groups plays by
# (user, local date) and by (user, tier, artist) -- partial aggregation on the
# map side, so a hot user is collapsed before the shuffle -- and level 2 is one
# groupBy(user) in which every level-1 row already IS one distinct date or
# artist, so the distinct counts become plain conditional counts. Exact: the
# averages are sum / count of integer popularities.

def _day_level(plays: DataFrame, as_of, weekly_days: int, hourly_days: int | None = None, users=None, user_id=None) -> DataFrame:
    """(user_id, d, n, pop_sum, pop_n[, h0..h23]) per user and local date inside the widest window,
    plus the user spine (``_with_all_users``) so every user keeps a row (zeros in the result)."""
    day = F.to_date(LOCAL)
    wide = max(weekly_days, hourly_days or 0)
    pop = F.col("popularity").cast("double")
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(pop).alias("pop_sum"), F.count(pop).alias("pop_n")]
    if hourly_days is not None:
        in_h = day >= _lo(as_of, hourly_days)
        aggs += [F.count_if(in_h & (F.col("play_hour") == h)).alias(f"h{h}") for h in range(24)]
    days = plays.filter(day >= _lo(as_of, wide)).groupBy("user_id", day.alias("d")).agg(*aggs)
    return _with_all_users(days, plays, users, user_id)


def _artist_level(plays: DataFrame, as_of, days_back: int, all_users: bool = True, users=None, user_id=None) -> DataFrame:
    """(user_id, tier, artist_id, n, pop_sum) over in-window plays with known popularity,
    plus the user spine when ``all_users`` (see ``_with_all_users``)."""
    cond = in_trailing_window(LOCAL, as_of, days_back) & F.col("popularity").isNotNull()
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(F.col("popularity").cast("double")).alias("pop_sum")]
    arts = plays.filter(cond).groupBy("user_id", L.popularity_tier("popularity").alias("tier"), "artist_id").agg(*aggs)
    return _with_all_users(arts, plays, users, user_id) if all_users else arts


def _hourly_sums() -> list:
    return [F.array(*[F.coalesce(F.sum(f"h{h}"), F.lit(0)) for h in range(24)]).alias("hourly")]


def _weekly_cols(as_of, days_back: int) -> list:
    """Level-2 aggregates over day-level rows: plays, active days, avg popularity per day type."""
    d = F.col("d")
    inwin = d >= _lo(as_of, days_back)
    we = L.is_weekend(F.dayofweek(d))
    cols = []
    for name, cond in (("weekday", inwin & ~we), ("weekend", inwin & we)):
        cols += [
            F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).alias(f"{name}_plays"),
            F.count_if(cond).alias(f"{name}_days"),
            (F.sum(F.when(cond, F.col("pop_sum"))) / F.sum(F.when(cond, F.col("pop_n")))).alias(f"{name}_pop"),
        ]
    return cols


def _weekly_agg(plays: DataFrame, as_of, days_back: int, user_id=None, users=None) -> DataFrame:
    return _day_level(_scope(plays, user_id), as_of, days_back, None, users, user_id).groupBy("user_id").agg(*_weekly_cols(as_of, days_back))


def _weekly_rows() -> list:
    total = F.col("weekday_plays") + F.col("weekend_plays")
    return [F.struct(F.lit(n).alias("day_type"), F.col(f"{n}_plays").alias("play_count"),
                     F.col(f"{n}_days").alias("active_days"),
                     F.coalesce(F.col(f"{n}_pop"), F.lit(0.0)).alias("avg_popularity"),
                     L.pct(F.col(f"{n}_plays"), total).alias("percentage"))
            for n in L.DAY_TYPES]


def weekday_weekend(plays: DataFrame, as_of=None, days_back: int = 90, user_id=None, users: DataFrame | None = None) -> DataFrame:
    """A03 + J03 + A13: per day type plays, active days, avg popularity, share of plays."""
    a = _weekly_agg(plays, as_of, days_back, user_id, users)
    return a.select("user_id", F.inline(F.array(*_weekly_rows())))


def _tier_cols() -> list:
    """Level-2 aggregates over artist-level rows: plays, distinct artists, avg popularity per tier."""
    cols = []
    for t in L.POPULARITY_TIERS:
        cond = F.col("tier") == t
        cols += [
            F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).alias(f"{t}_plays"),
            F.count_if(cond & F.col("artist_id").isNotNull()).alias(f"{t}_artists"),
            (F.sum(F.when(cond, F.col("pop_sum"))) / F.sum(F.when(cond, F.col("n")))).alias(f"{t}_pop"),
        ]
    return cols


def _popularity_agg(plays: DataFrame, as_of, days_back: int, user_id=None, users=None) -> DataFrame:
    return _artist_level(_scope(plays, user_id), as_of, days_back, True, users, user_id).groupBy("user_id").agg(*_tier_cols())


def _total(prefix_cols) -> F.Column:
    out = None
    for c in prefix_cols:
        out = F.col(c) if out is None else out + F.col(c)
    return out


def _tier_total() -> F.Column:
    return _total([f"{t}_plays" for t in L.POPULARITY_TIERS])


def _tier_rows() -> list:
    total = _tier_total()
    return [F.struct(F.lit(t).alias("popularity_tier"), F.col(f"{t}_plays").alias("play_count"),
                     F.col(f"{t}_artists").alias("unique_artists"),
                     F.coalesce(F.col(f"{t}_pop"), F.lit(0.0)).alias("avg_popularity"),
                     L.pct(F.col(f"{t}_plays"), total).alias("percentage"))
            for t in L.POPULARITY_TIERS]


def popularity_distribution(plays: DataFrame, as_of=None, days_back: int = 90, user_id=None, users: DataFrame | None = None) -> DataFrame:
    """A04 + J03 + A13: per tier plays, distinct artists, avg popularity, share."""
    a = _popularity_agg(plays, as_of, days_back, user_id, users)
    return a.select("user_id", F.inline(F.array(*_tier_rows())))


def user_category_aggregates(plays: DataFrame, as_of=None, hourly_days: int = 30, weekly_days: int = 90,
                             pop_days: int = 90, user_id=None, users: DataFrame | None = None) -> DataFrame:
    """Hourly, weekday/weekend and tier aggregates of every user, one row per user.

    Used by the composite products (C05, C07): the day level (which keeps every
    user) and the artist level (in-window plays only) are unioned and reduced by
    ONE groupBy(user), instead of one aggregation per insight.
    """
    p = _scope(plays, user_id)
    days = _day_level(p, as_of, weekly_days, hourly_days, users, user_id)
    arts = _artist_level(p, as_of, pop_days, all_users=False)
    both = days.unionByName(arts, allowMissingColumns=True)
    return both.groupBy("user_id").agg(*_hourly_sums(), *_weekly_cols(as_of, weekly_days), *_tier_cols())


def dominant_expr(prefix: str = "", suffix: str = "_plays") -> F.Column:
    """Argmax tier with the T12 tie order (emergent, growing, established); 'unknown' at 0."""
    e, g, s = (F.col(f"{prefix}{t}{suffix}") for t in L.POPULARITY_TIERS)
    return (F.when(e + g + s == 0, "unknown")
            .when((e >= g) & (e >= s), "emergent")
            .when(g >= s, "growing")
            .otherwise("established"))


def popularity_summary(plays: DataFrame, as_of=None, days_back: int = 90, user_id=None, users: DataFrame | None = None) -> DataFrame:
    """Total plays with known popularity and the dominant tier per user.

    Only play counts per tier are needed, so this is one conditional aggregation
    per user (no artist level).
    """
    p = _scope(plays, user_id)
    inwin = in_trailing_window(LOCAL, as_of, days_back) & F.col("popularity").isNotNull()
    recent = p.filter(inwin).select("user_id", L.popularity_tier("popularity").alias("tier"))
    a = _with_all_users(recent, p, users, user_id).groupBy("user_id").agg(
        *[F.count_if(F.col("tier") == t).alias(f"{t}_plays") for t in L.POPULARITY_TIERS])
    return a.select("user_id", _tier_total().alias("total_plays"), dominant_expr().alias("dominant_tier"))


def insights_available(plays: DataFrame, as_of=None, user_id=None,
                       top_days: int = 90, hourly_days: int = 30, weekly_days: int = 90,
                       pop_days: int = 90, users: DataFrame | None = None) -> DataFrame:
    """TRUE when any of the four insight families has data for the user.

    One aggregation over the widest window plus the user spine: each family
    reduces to "any play inside its window" (plus known popularity for the tier
    family); a user without such a play gets FALSE.
    """
    def any_in(days, extra=None):
        c = in_trailing_window(LOCAL, as_of, days)
        if extra is not None:
            c = c & extra
        return F.coalesce(F.bool_or(c), F.lit(False))
    p = _scope(plays, user_id)
    widest = max(top_days, hourly_days, weekly_days, pop_days)
    recent = p.filter(in_trailing_window(LOCAL, as_of, widest)).select("user_id", LOCAL, "popularity")
    a = _with_all_users(recent, p, users, user_id).groupBy("user_id").agg(
        any_in(top_days).alias("has_top_artists"),
        any_in(hourly_days).alias("has_daily_data"),
        any_in(weekly_days).alias("has_weekly_data"),
        any_in(pop_days, F.col("popularity").isNotNull()).alias("has_popularity_data"),
    )
    return a.withColumn("insights_available", F.col("has_top_artists") | F.col("has_daily_data")
                        | F.col("has_weekly_data") | F.col("has_popularity_data"))
