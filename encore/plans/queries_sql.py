"""Registered SQL-surface queries: the statements and insights as SQL functions over a catalog (A01-A04, A23-A25, K05, K06),
and features over tables bucketed by user (J01, M01)."""

from __future__ import annotations

import datetime as dt

from encore.operators import features as FE
from encore.operators import genres as G
from encore.plans.oracle_views import AS_OF
from encore.plans.queries_catalog import CATALOG
from encore.plans.queries_insights import _hourly_sql, _tiers_sql, _top_sql, _weekly_sql, win
from encore.plans.queries_profiles import _features_sql
from encore.plans.registry import query
from encore.session import scratch_path
from encore.sources import catalog, layout, sinks, sql_functions
from encore.sources import fixtures as fx
from encore.sources.schemas import TABLES

AT = dt.date.fromisoformat(AS_OF)


@fx.memoized
def music_db(spark, sf) -> str:
    """A database over the domain tables: play history by month and bucket, likes, follows and top tracks bucketed by
    user, the artist catalog by range and genre. Written and registered once a session; its SQL functions are set up."""
    root = scratch_path(spark, "music-db")
    db = "encore_" + root.rsplit("/", 1)[-1].replace("-", "_")
    plays = fx.plays(spark, sf).select(*[c for c in TABLES["play_history"].columns if c not in (layout.MONTH, layout.BUCKET)])
    at = {"play_history": layout.write_history(plays, f"{root}/play_history"),
          "artists_catalog": sinks.write_catalog(G.artist_catalog(fx.artists_raw(spark, sf)), f"{root}/artists_catalog")}
    catalog.build_catalog(spark, db, at)
    for name, df in (("likes", fx.likes(spark, sf)), ("followed_artists", fx.follows(spark, sf)), ("top_tracks", fx.top_tracks(spark, sf)),
                     ("plays", plays)):
        layout.write_bucketed(df, f"{db}.{name}", f"{root}/{name}")
    return db


def ask(spark, sf, name: str, **arguments):
    sql_functions.register(spark, music_db(spark, sf))
    return sql_functions.ask(spark, name, **arguments)


@query("a23_sql_plays_per_user", "select user_id, count(*) total_plays from plays group by user_id")
def sql_a23(spark, sf):
    """Plays per user, most active first, as a SQL function."""
    return ask(spark, sf, "plays_per_user")


@query("k05_sql_top_ranked_tracks", "select user_id, track_id, artists_id, ith_preference from top_tracks where ith_preference <= 5")
def sql_k05(spark, sf):
    """Top tracks up to a rank given as a parameter."""
    return ask(spark, sf, "top_ranked_tracks", max_rank=5)


@query("a24_sql_likes_per_artist", "select artists_id, count(*) liked_tracks from likes group by artists_id")
def sql_a24(spark, sf):
    """Likes per primary artist, most liked first."""
    return ask(spark, sf, "likes_per_artist")


@query("k06_sql_artists_by", f"""with {CATALOG}
select id, name, popularity, followers, primary_genre from cat where popularity_range = 'very_high' and primary_genre = 'latin'""")
def sql_k06(spark, sf):
    """Artists of a range and a genre, both parameters that prune partitions, most followed first."""
    return ask(spark, sf, "artists_by", in_range="very_high", in_genre="latin")


@query("a25_sql_genre_counts", f"""with {CATALOG}
select primary_genre, count(*) artist_count, avg(popularity) avg_popularity from cat group by primary_genre""")
def sql_a25(spark, sf):
    """Artists and average popularity per primary genre."""
    return ask(spark, sf, "genre_counts")


@query("a01_sql_top_artists", _top_sql(90, 10))
def sql_a01(spark, sf):
    """Top ten artists of all users over 90 days, as a SQL function."""
    return ask(spark, sf, "top_artists", only_user=None, as_of=AT, days_back=90, top_n=10)


@query("a02_sql_hourly_pattern", _hourly_sql(30))
def sql_a02(spark, sf):
    """Plays per local hour of all users over 30 days, as a SQL function."""
    return ask(spark, sf, "hourly_pattern", only_user=None, as_of=AT, days_back=30)


@query("a03_sql_weekday_weekend", _weekly_sql(90))
def sql_a03(spark, sf):
    """Weekday against weekend of all users over 90 days, as a SQL function."""
    return ask(spark, sf, "weekday_weekend", only_user=None, as_of=AT, days_back=90)


@query("a04_sql_popularity_tiers", _tiers_sql(90))
def sql_a04(spark, sf):
    """Popularity tiers of all users over 90 days, as a SQL function."""
    return ask(spark, sf, "popularity_tiers", only_user=None, as_of=AT, days_back=90)


@query("p03_month_pruned_window", f"select user_id, track_id, played_at_local from plays where {win(10)}")
def p03_month_pruned_window(spark, sf):
    """The trailing 10-day window from the stored history: only the window's months are opened."""
    return layout.history_scan(spark.table(f"{music_db(spark, sf)}.play_history"), AS_OF, 10).select("user_id", "track_id", "played_at_local")


@query("j01_bucketed_features", f"""with {_features_sql(30)}
select * from feat""")
def j01_bucketed_features(spark, sf):
    """User features (J01, M01) over tables bucketed by user: no exchange above the scans."""
    db = music_db(spark, sf)
    return FE.user_features(*(spark.table(f"{db}.{t}") for t in ("plays", "likes", "followed_artists", "top_tracks")), period_days=30)
