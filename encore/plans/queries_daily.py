"""Registered queries over the stored daily partials (A01-A04, A11, C05, C06): windows added up without reading plays."""

from __future__ import annotations

from encore.operators import daily as DY
from encore.plans import dashboard as D
from encore.plans.oracle_views import AS_OF
from encore.plans.queries_dashboard import C05_SQL
from encore.plans.queries_insights import _hourly_sql, _tiers_sql, _top_sql, _weekly_sql, win
from encore.plans.registry import query
from encore.session import scratch_path
from encore.sources import fixtures as fx


@fx.memoized
def stored(spark, sf) -> DY.Daily:
    """The partials of all plays, stored once a session."""
    return DY.read(spark, DY.build(fx.plays(spark, sf), scratch_path(spark, "daily")))


@query("a01_from_daily", _top_sql(90, 10))
def a01_from_daily(spark, sf):
    """Top ten artists of 90 days from daily partials."""
    return DY.top_artists(stored(spark, sf), AS_OF, 90, 10)


@query("a02_from_daily", _hourly_sql(30))
def a02_from_daily(spark, sf):
    """Hourly pattern of 30 days from daily partials."""
    return DY.hourly_pattern(stored(spark, sf), AS_OF, 30)


@query("a03_from_daily", _weekly_sql(90))
def a03_from_daily(spark, sf):
    """Weekday against weekend from daily partials."""
    return DY.weekday_weekend(stored(spark, sf), AS_OF, 90)


@query("a04_from_daily", _tiers_sql(5))
def a04_from_daily(spark, sf):
    """Popularity tiers of five days from daily partials."""
    return DY.popularity_distribution(stored(spark, sf), AS_OF, 5)


@query("c05_from_daily", C05_SQL)
def c05_from_daily(spark, sf):
    """The whole insights summary from daily partials."""
    return D.daily_summary(stored(spark, sf), AS_OF, 90)


@query("a11_sketch_counts", " union all ".join(f"""
select user_id, {days} days_back, count(distinct case when {win(days)} then track_id end) tracks, count(distinct case when {win(days)} then artist_id end) artists
from plays where {win(90)} group by user_id""" for days in DY.WINDOWS))
def a11_sketch_counts(spark, sf):
    """Distinct tracks and artists of 7, 30 and 90 days from merged daily sketches (counts this small are exact)."""
    return DY.sketch_counts(stored(spark, sf), AS_OF)
