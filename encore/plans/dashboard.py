"""Composite per-user products of the dashboard.

Each product is a DataFrame for all users. Results are tidy (one row per user and
item) so they stay columnar and comparable; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.functions import labels as L
from encore.functions.time import date_part_of_iso, in_trailing_window
from encore.operators import daily as DY
from encore.operators import insights as I
from encore.operators.profiles import DEFAULT_PROFILE

SUMMARY_COLUMNS = ["user_id", "insight", "item", "position", "play_count", "distinct_count",
                   "avg_popularity", "percentage"]


def _long(df: DataFrame, insight: str, item, position, play_count, distinct_count=None,
          avg_pop=None, percentage=None) -> DataFrame:
    none_d = F.lit(None).cast("double")
    return df.select(
        "user_id", F.lit(insight).alias("insight"), item.cast("string").alias("item"),
        position.cast("int").alias("position"), play_count.cast("bigint").alias("play_count"),
        (distinct_count if distinct_count is not None else F.lit(None)).cast("bigint").alias("distinct_count"),
        (avg_pop if avg_pop is not None else none_d).cast("double").alias("avg_popularity"),
        (percentage if percentage is not None else none_d).cast("double").alias("percentage"),
    )


def insights_summary(plays: DataFrame, as_of=None, days_back: int = 90, user_id=None,
                     users: DataFrame | None = None) -> DataFrame:
    """The four insight families (+ tier summary) in one long table.

    Three reads of the window: the top-artist ranking (by user and artist), the day level and the artist level; the
    last two end in ONE per-user aggregation holding the hourly, weekday/weekend and tier aggregates, which is
    unpivoted into 24 + 2 + 3 + 1 rows per user. With ``users`` (the user dimension) nothing outside the window is read.
    Hourly pattern uses ``min(days_back, 30)`` like the reference.
    """
    top = I.top_artists(plays, as_of, days_back, 10, user_id)
    agg = I.user_category_aggregates(plays, as_of, min(days_back, 30), days_back, days_back, user_id, users)
    return _summary(top, agg)


def daily_summary(daily: DY.Daily, as_of=None, days_back: int = 90, user_id=None, users: DataFrame | None = None) -> DataFrame:
    """C05 from the stored daily partials: the same table without reading plays."""
    return _summary(DY.top_artists(daily, as_of, days_back, 10, user_id),
                    DY.user_category_aggregates(daily, as_of, min(days_back, 30), days_back, days_back, user_id, users))


def _summary(top: DataFrame, agg: DataFrame) -> DataFrame:
    """The long table from the ranking and the per-user category aggregates."""
    none_i, none_l, none_d = F.lit(None).cast("int"), F.lit(None).cast("bigint"), F.lit(None).cast("double")

    def row(insight, item, position, play_count, distinct=none_l, avg_pop=none_d, pct=none_d):
        return F.struct(F.lit(insight).alias("insight"), item.cast("string").alias("item"),
                        position.cast("int").alias("position"), play_count.cast("bigint").alias("play_count"),
                        distinct.cast("bigint").alias("distinct_count"), avg_pop.cast("double").alias("avg_popularity"),
                        pct.cast("double").alias("percentage"))

    # the 24 hourly rows come from one lambda over the hourly array (position = hour)
    hourly = F.transform("hourly", lambda c, h: row("daily_pattern", L.hour_label(h), h, c))
    rows = [row("weekly_pattern", w["day_type"], none_i, w["play_count"], w["active_days"], w["avg_popularity"],
                w["percentage"]) for w in I._weekly_rows()]
    rows += [row("popularity_distribution", t["popularity_tier"], none_i, t["play_count"], t["unique_artists"],
                 t["avg_popularity"], t["percentage"]) for t in I._tier_rows()]
    rows.append(row("popularity_summary", I.dominant_expr(), none_i, I._tier_total()))
    categories = agg.select("user_id", F.inline(F.concat(hourly, F.array(*rows))))
    return _long(top, "top_artists", F.col("artist_name"), F.col("rank"), F.col("play_count"),
                 F.col("unique_tracks")).unionByName(categories)


INSIGHTS = {
    "top_artists": lambda plays, as_of, days_back, limit, users: I.top_artists(plays, as_of, days_back, limit),
    "daily_pattern": lambda plays, as_of, days_back, limit, users: I.hourly_pattern(plays, as_of, min(days_back, 30), users=users),
    "weekly_pattern": lambda plays, as_of, days_back, limit, users: I.weekday_weekend(plays, as_of, days_back, users=users),
    "popularity_distribution": lambda plays, as_of, days_back, limit, users: I.popularity_distribution(plays, as_of, days_back, users=users),
}


def run_insight(name: str, plays: DataFrame, as_of=None, days_back: int = 90, limit: int = 10,
                users: DataFrame | None = None) -> DataFrame:
    """Insight by name; unknown names raise ``ValueError``."""
    if name not in INSIGHTS:
        raise ValueError(f"invalid insight type: {name!r}")
    return INSIGHTS[name](plays, as_of, days_back, limit, users)


DAILY_INSIGHTS = {
    "top_artists": lambda daily, as_of, days_back, limit, users: DY.top_artists(daily, as_of, days_back, limit),
    "daily_pattern": lambda daily, as_of, days_back, limit, users: DY.hourly_pattern(daily, as_of, min(days_back, 30), users=users),
    "weekly_pattern": lambda daily, as_of, days_back, limit, users: DY.weekday_weekend(daily, as_of, days_back, users=users),
    "popularity_distribution": lambda daily, as_of, days_back, limit, users: DY.popularity_distribution(daily, as_of, days_back, users=users),
}


def run_daily_insight(name: str, daily: DY.Daily, as_of=None, days_back: int = 90, limit: int = 10, users: DataFrame | None = None) -> DataFrame:
    """C06 from the stored daily partials."""
    if name not in DAILY_INSIGHTS:
        raise ValueError(f"invalid insight type: {name!r}")
    return DAILY_INSIGHTS[name](daily, as_of, days_back, limit, users)


def executive_summary(plays: DataFrame, as_of=None, days_back: int = 30, user_id=None,
                      users: DataFrame | None = None) -> DataFrame:
    """Top artist, plays of the top 3, weekend preference, taste label, activity level.

    Three reads of the window: the top-3 artists, and the day and artist levels of one per-user aggregation, joined
    on user_id (one row per user each). With ``users`` nothing outside the window is read.
    """
    top3 = I.top_artists(plays, as_of, days_back, 3, user_id)
    top = top3.groupBy("user_id").agg(
        F.min_by("artist_name", "rank").alias("top_artist_raw"),
        F.sum("play_count").alias("total_top_plays"))
    agg = I.user_category_aggregates(plays, as_of, days_back, days_back, days_back, user_id, users)
    users = agg.select(
        "user_id",
        L.pct("weekend_plays", F.col("weekday_plays") + F.col("weekend_plays")).alias("weekend_pct"),
        (F.col("weekday_plays") + F.col("weekend_plays")).alias("plays_total"),
        (F.col("weekday_days") + F.col("weekend_days")).alias("days_total"),
        I.dominant_expr().alias("dominant_tier"))
    j = users.join(top, "user_id", "left")
    return j.select(
        "user_id",
        F.coalesce("top_artist_raw", F.lit(L.NO_ARTIST)).alias("top_artist"),
        F.coalesce("total_top_plays", F.lit(0)).cast("bigint").alias("total_top_plays"),
        L.listening_preference("weekend_pct").alias("listening_preference"),
        L.taste_label(F.coalesce("dominant_tier", F.lit("unknown"))).alias("music_taste_profile"),
        L.activity_level("plays_total", "days_total").alias("activity_level"),
    )


def recent_plays(plays: DataFrame, n: int = 10, user_id=None) -> DataFrame:
    """W02 + P22: the ``n`` most recent plays per user with the play date.

    ``row_number <= n`` becomes a partial WindowGroupLimit before the shuffle.
    """
    p = plays if user_id is None else plays.filter(F.col("user_id") == str(user_id))
    w = Window.partitionBy("user_id").orderBy(F.desc("played_at_utc"), F.asc("track_id"), F.asc("artist_id"))
    iso = F.date_format("played_at_utc", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return (p.withColumn("recent_rank", F.row_number().over(w)).filter(F.col("recent_rank") <= n)
            .select("user_id", "recent_rank", "track_id", "artist_name",
                    date_part_of_iso(iso).alias("played_date")))


# The reference's time ranges, in days: about 4 weeks, about 6 months, all history.
RANGES: dict[str, int | None] = {"short_term": 28, "medium_term": 182, "long_term": None}


def top_by_range(plays: DataFrame, as_of=None, ranges: dict | None = None, limit: int = 5,
                 keys: tuple = ("artist_name",)) -> DataFrame:
    """Top ``limit`` artists (or tracks: ``keys``) per user for each time range, ranked by plays.

    The source of truth in the reference is an external service; here the ranking
    is derived from plays (ties: name ascending). One aggregation per (user,
    artist) with a conditional count and max popularity per range (the widest
    window's lower bound is pushed to the scan), unpivoted to one row per range
    the artist was played in; no play is copied per range. A range of ``None`` days has no lower bound.
    """
    ranges = ranges or RANGES
    keys = list(keys)
    aggs = []
    for i, days in enumerate(ranges.values()):
        inwin = in_trailing_window("played_at_local", as_of, days) if days is not None else F.lit(True)
        aggs += [F.count_if(inwin).alias(f"_n{i}"), F.max(F.when(inwin, F.col("popularity"))).alias(f"_p{i}")]
    days = list(ranges.values())
    read = plays if None in days else plays.filter(in_trailing_window("played_at_local", as_of, max(days)))
    per_key = read.groupBy("user_id", *keys).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(r).alias("time_range"), F.col(f"_n{i}").alias("play_count"),
                              F.col(f"_p{i}").alias("popularity")) for i, r in enumerate(ranges)])
    per = per_key.select("user_id", *keys, F.inline(rows)).filter(F.col("play_count") > 0)
    w = Window.partitionBy("user_id", "time_range").orderBy(F.desc("play_count"), *[F.asc(k) for k in keys])
    return (per.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)
            .select("user_id", "time_range", "rank", *keys, "play_count", "popularity"))


def rank_comparison(plays: DataFrame, as_of=None, ranges: dict | None = None, limit: int = 50) -> DataFrame:
    """J06 + K04: per user and artist, rank in each range; keep artists ranked in >= 2 ranges.

    ``pivot`` over the ranges equals the full outer join of their lists. Sorted by user, then the rank in the second
    range (nulls last), then the name.
    """
    ranges = ranges or RANGES
    ranked = top_by_range(plays, as_of, ranges, limit)
    piv = ranked.groupBy("user_id", "artist_name").pivot("time_range", list(ranges)).agg(F.min("rank"))
    present = sum((F.col(r).isNotNull().cast("int") for r in ranges), F.lit(0))
    return (piv.filter(present >= 2)
            .select("user_id", "artist_name", *[F.col(r).alias(f"rank_{r}") for r in ranges])
            .orderBy("user_id", F.asc_nulls_last(f"rank_{list(ranges)[min(1, len(ranges) - 1)]}"), "artist_name"))


def distinct_ranked_names(plays: DataFrame, as_of=None, ranges: dict | None = None, limit: int = 50) -> DataFrame:
    """Distinct union of the artist names ranked in any range, per user."""
    return top_by_range(plays, as_of, ranges, limit).select("user_id", "artist_name").distinct()


def recents_card(plays: DataFrame, artists: DataFrame, as_of=None, days: int = RANGES["short_term"]) -> DataFrame:
    """10 recent plays (W02, P22) + top 5 short-range artists (W06) with the
    catalog's decile popularity (P21, default 50) and genres text (P24).

    ``artists`` is the cleaned catalog (id, popularity, genres); it is joined on
    the artist id, a left equi-join the planner may broadcast when AQE sees it small.
    """
    recents = recent_plays(plays, 10).select(
        "user_id", F.lit("recent").alias("card"), F.col("recent_rank").alias("position"),
        F.col("track_id").alias("item"), F.col("played_date").alias("detail"),
        F.lit(None).cast("int").alias("popularity"))
    top = top_by_range(plays, as_of, {"short_term": days}, 5, ("artist_id", "artist_name"))
    cat = artists.select(F.col("id").alias("artist_id"), F.col("genres").alias("cat_genres"),
                         F.col("popularity").alias("cat_pop"))
    tops = (top.join(cat, "artist_id", "left")
            .select("user_id", F.lit("top_artist").alias("card"), F.col("rank").alias("position"),
                    F.col("artist_name").alias("item"), L.join_or("cat_genres").alias("detail"),
                    L.decile_floor("cat_pop").alias("popularity")))
    return recents.unionByName(tops)


def weekly_evolution(plays: DataFrame) -> DataFrame:
    """C11: plays and distinct artists per user and local week, change against the calendar week before.

    A week without plays counts as 0 plays (no percentage); a user's first week has nothing to compare with.
    """
    wk = F.date_trunc("week", F.col("played_at_local")).cast("date")
    per = plays.groupBy("user_id", wk.alias("week_start")).agg(
        F.count(F.lit(1)).alias("plays"), F.count_distinct("artist_id").alias("distinct_artists"))
    w = Window.partitionBy("user_id").orderBy("week_start")
    earlier = F.lag("week_start").over(w)
    prev = F.when(earlier == F.date_sub("week_start", 7), F.lag("plays").over(w)).when(earlier.isNotNull(), F.lit(0))
    return per.select("user_id", "week_start", "plays", "distinct_artists",
                      (F.col("plays") - prev).alias("plays_change"),
                      F.when(prev > 0, (F.col("plays") - prev) / prev.cast("double") * 100).alias("plays_change_pct"))


def dashboard(plays: DataFrame, profiles: DataFrame, as_of=None, days_back: int = 90, recent: int = 10, tops: int = 5,
              users: DataFrame | None = None) -> DataFrame:
    """One row per user with the four parts of the dashboard.

    ``recents`` and ``tops`` are arrays of at most ``recent`` and ``tops`` structs in rank order; the executive summary
    (C07) and whether any insight is available (A27) follow; users without a stored profile get the default one.
    """
    def listed(df: DataFrame, rank: str, name: str) -> DataFrame:
        cols = [rank, *[c for c in df.columns if c not in ("user_id", rank)]]
        return df.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct(*cols))).alias(name))

    rec = listed(recent_plays(plays, recent), "recent_rank", "recents")
    top = listed(I.top_artists(plays, as_of, days_back, tops), "rank", "tops")
    available = I.insights_available(plays, as_of, users=users).select("user_id", "insights_available")
    prof = profiles.select("user_id", "profile_name", "profile_emoji")
    j = (rec.join(top, "user_id", "left").join(available, "user_id", "left")
         .join(executive_summary(plays, as_of, users=users), "user_id", "left").join(prof, "user_id", "left"))
    return j.withColumns({"tops": F.coalesce("tops", F.array().cast(top.schema["tops"].dataType)),
                          "profile_name": F.coalesce("profile_name", F.lit(DEFAULT_PROFILE["name"])),
                          "profile_emoji": F.coalesce("profile_emoji", F.lit(DEFAULT_PROFILE["emoji"]))})
