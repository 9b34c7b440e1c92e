"""Registered insight queries (A01-A05, A13, A27, J02, J03, C05-C07, C10, C11, W02, W06, J06 ...).

Parameters follow FIXTURES.md: ``as_of`` = 2024-01-31.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from encore.operators import insights as I
from encore.plans.oracle_views import AS_OF
from encore.plans.registry import query
from encore.sources import fixtures as fx


def _plays(spark, sf):
    return fx.plays(spark, sf)


@query("a01_top_artists", f"""
select user_id, cast(rank as int) rank, artist_name, play_count, unique_tracks from (
  select user_id, artist_name, count(*) play_count, count(distinct track_id) unique_tracks,
    row_number() over (partition by user_id order by count(*) desc, artist_name) rank
  from plays where cast(played_at_local as date) >= date '{AS_OF}' - 90
  group by user_id, artist_name) t
where rank <= 10""")
def a01_top_artists(spark, sf):
    """Top 10 artists per user over 90 days (play count, distinct tracks)."""
    return I.top_artists(_plays(spark, sf), AS_OF, 90, 10)


def win(days: int, col: str = "played_at_local") -> str:
    return f"cast({col} as date) >= date '{AS_OF}' - {days}"


def _hourly_sql(days: int) -> str:
    return f"""
with u as (select distinct user_id from plays),
h as (select cast(range as int) hr from range(24)),
c as (select user_id, play_hour, count(*) n from plays where {win(days)} group by user_id, play_hour)
select u.user_id, h.hr "hour", coalesce(c.n, 0) play_count, lpad(cast(h.hr as varchar), 2, '0') || ':00' hour_label
from u cross join h left join c on c.user_id = u.user_id and c.play_hour = h.hr"""


def _weekly_sql(days: int) -> str:
    return f"""
with u as (select distinct user_id from plays),
d as (select 'weekday' day_type union all select 'weekend'),
w as (select *, case when play_day_of_week in (1, 7) then 'weekend' else 'weekday' end dt from plays where {win(days)}),
c as (select user_id, dt, count(*) n, count(distinct cast(played_at_local as date)) nd,
        avg(cast(popularity as double)) pop from w group by user_id, dt),
t as (select user_id, sum(n) total from c group by user_id)
select u.user_id, d.day_type, coalesce(c.n, 0) play_count, coalesce(c.nd, 0) active_days,
  coalesce(c.pop, 0.0) avg_popularity,
  case when coalesce(t.total, 0) > 0 then cast(coalesce(c.n, 0) as double) / t.total * 100 else 0.0 end percentage
from u cross join d left join c on c.user_id = u.user_id and c.dt = d.day_type left join t on t.user_id = u.user_id"""


TIER_SQL = "case when popularity <= 40 then 'emergent' when popularity <= 70 then 'growing' else 'established' end"


def _tiers_sql(days: int) -> str:
    return f"""
with u as (select distinct user_id from plays),
d as (select 'emergent' tier union all select 'growing' union all select 'established'),
w as (select *, {TIER_SQL} tier from plays where {win(days)} and popularity is not null),
c as (select user_id, tier, count(*) n, count(distinct artist_id) artists, avg(cast(popularity as double)) pop
      from w group by user_id, tier),
t as (select user_id, sum(n) total from c group by user_id)
select u.user_id, d.tier popularity_tier, coalesce(c.n, 0) play_count, coalesce(c.artists, 0) unique_artists,
  coalesce(c.pop, 0.0) avg_popularity,
  case when coalesce(t.total, 0) > 0 then cast(coalesce(c.n, 0) as double) / t.total * 100 else 0.0 end percentage
from u cross join d left join c on c.user_id = u.user_id and c.tier = d.tier left join t on t.user_id = u.user_id"""


def _dominant_sql(days: int) -> str:
    return f"""
with u as (select distinct user_id from plays),
w as (select *, {TIER_SQL} tier from plays where {win(days)} and popularity is not null),
c as (select user_id, count(*) filter (where tier = 'emergent') e, count(*) filter (where tier = 'growing') g,
        count(*) filter (where tier = 'established') s from w group by user_id),
x as (select u.user_id, coalesce(e, 0) e, coalesce(g, 0) g, coalesce(s, 0) s from u left join c using (user_id))
select user_id, e + g + s total_plays,
  case when e + g + s = 0 then 'unknown' when e >= g and e >= s then 'emergent' when g >= s then 'growing'
       else 'established' end dominant_tier
from x"""


def _top_sql(days: int, limit: int) -> str:
    return f"""
select user_id, cast(rank as int) rank, artist_name, play_count, unique_tracks from (
  select user_id, artist_name, count(*) play_count, count(distinct track_id) unique_tracks,
    row_number() over (partition by user_id order by count(*) desc, artist_name) rank
  from plays where {win(days)}
  group by user_id, artist_name) t
where rank <= {limit}"""


@query("a02_hourly_pattern", _hourly_sql(30))
def a02_hourly_pattern(spark, sf):
    """Plays per local hour over 30 days, all 24 hours per user."""
    return I.hourly_pattern(_plays(spark, sf), AS_OF, 30, users=fx.users(spark, sf))


@query("j02_hour_spine", _hourly_sql(7))
def j02_hour_spine(spark, sf):
    """24-hour spine over a short 7-day window: most hours are zero-filled."""
    return I.hourly_pattern(_plays(spark, sf), AS_OF, 7, users=fx.users(spark, sf))


@query("a03_weekday_weekend", _weekly_sql(90))
def a03_weekday_weekend(spark, sf):
    """Weekday vs weekend: plays, active days, avg popularity, share (90 days)."""
    return I.weekday_weekend(_plays(spark, sf), AS_OF, 90, users=fx.users(spark, sf))


@query("j03_category_spine", _weekly_sql(2))
def j03_category_spine(spark, sf):
    """Day-type spine over a 2-day window: users without plays keep zero rows."""
    return I.weekday_weekend(_plays(spark, sf), AS_OF, 2, users=fx.users(spark, sf))


@query("a04_popularity_distribution", _tiers_sql(90))
def a04_popularity_distribution(spark, sf):
    """Plays, distinct artists, avg popularity and share per popularity tier."""
    return I.popularity_distribution(_plays(spark, sf), AS_OF, 90, users=fx.users(spark, sf))


@query("a13_share_of_total", _tiers_sql(5))
def a13_share_of_total(spark, sf):
    """Tier shares over 5 days (zero totals give 0 shares)."""
    return I.popularity_distribution(_plays(spark, sf), AS_OF, 5, users=fx.users(spark, sf))


@query("a05_dominant_tier", _dominant_sql(90))
def a05_dominant_tier(spark, sf):
    """Total plays with popularity and dominant tier per user (tie order T12)."""
    return I.popularity_summary(_plays(spark, sf), AS_OF, 90, users=fx.users(spark, sf))


@query("k01_top_k", _top_sql(30, 3))
def k01_top_k(spark, sf):
    """Top 3 artists per user over 30 days (order desc + limit per user)."""
    return I.top_artists(_plays(spark, sf), AS_OF, 30, 3)


@query("p03_window_filter", f"""
select event_id, user_id, cast(played_at_local as date) play_date from plays where {win(10)}""")
def p03_window_filter(spark, sf):
    """Trailing 10-day window predicate on the local date (pushed to the scan)."""
    from encore.functions.time import in_trailing_window
    p = _plays(spark, sf)
    return p.filter(in_trailing_window("played_at_local", AS_OF, 10)).select(
        "event_id", "user_id", F.to_date("played_at_local").alias("play_date"))


@query("a27_insights_available", f"""
select user_id, bool_or({win(90)}) has_top_artists, bool_or({win(30)}) has_daily_data,
  bool_or({win(90)}) has_weekly_data, bool_or({win(90)} and popularity is not null) has_popularity_data,
  bool_or({win(90)}) or bool_or({win(30)}) or bool_or({win(90)} and popularity is not null) insights_available
from plays group by user_id""")
def a27_insights_available(spark, sf):
    """Per user: does any insight family have data?"""
    return I.insights_available(_plays(spark, sf), AS_OF, users=fx.users(spark, sf))
