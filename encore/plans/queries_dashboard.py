"""Registered dashboard / exploration queries (C05-C07, C10, C11, J06, J08, J09, K02, K04, K05, K07,
P16, P19-P23, P25-P30, S15, S18, S22, U02, W01, W02, W06, A18-A20, A23, A24, A26)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from encore.functions import labels as L
from encore.functions.output import instants_as_ntz
from encore.functions.time import date_part_of_iso, reformat_date
from encore.operators import etl
from encore.operators import explore as X
from encore.operators import genres as G
from encore.operators import insights as I
from encore.plans import dashboard as D
from encore.plans.oracle_views import AS_OF
from encore.plans.queries_catalog import CLEAN as CATALOG_CLEAN
from encore.plans.queries_clean import DEDUP
from encore.plans.queries_insights import _dominant_sql, _hourly_sql, _tiers_sql, _top_sql, _weekly_sql, win
from encore.plans.queries_profiles import _profiled_sql
from encore.plans import jobs
from encore.plans.registry import query
from encore.sources import fixtures as fx
from encore.sources.tables import read_table


def _plays(spark, sf):
    return fx.plays(spark, sf)


# --- composite insight products -------------------------------------------------

def _long_sql(sub: str, insight: str, item: str, position: str, play_count: str, distinct: str = "null",
              avg_pop: str = "null", pct: str = "null") -> str:
    return (f"select user_id, '{insight}' insight, cast({item} as varchar) item, cast({position} as int) position, "
            f"cast({play_count} as bigint) play_count, cast({distinct} as bigint) distinct_count, "
            f"cast({avg_pop} as double) avg_popularity, cast({pct} as double) percentage from ({sub}) s")


C05_SQL = " union all ".join([
    _long_sql(_top_sql(90, 10), "top_artists", "artist_name", "rank", "play_count", "unique_tracks"),
    _long_sql(_hourly_sql(30), "daily_pattern", "hour_label", '"hour"', "play_count"),
    _long_sql(_weekly_sql(90), "weekly_pattern", "day_type", "null", "play_count", "active_days", "avg_popularity",
              "percentage"),
    _long_sql(_tiers_sql(90), "popularity_distribution", "popularity_tier", "null", "play_count", "unique_artists",
              "avg_popularity", "percentage"),
    _long_sql(_dominant_sql(90), "popularity_summary", "dominant_tier", "null", "total_plays"),
])


@query("c05_insights_summary", C05_SQL)
def c05_insights_summary(spark, sf):
    """All four insight families (+ tier summary) for every user in one long table (90 days)."""
    return D.insights_summary(_plays(spark, sf), AS_OF, 90, users=fx.users(spark, sf))


C06_SQL = " union all ".join([
    _long_sql(_top_sql(90, 10), "top_artists", "artist_name", "null", "play_count"),
    _long_sql(_hourly_sql(30), "daily_pattern", "hour_label", "null", "play_count"),
    _long_sql(_weekly_sql(90), "weekly_pattern", "day_type", "null", "play_count"),
    _long_sql(_tiers_sql(90), "popularity_distribution", "popularity_tier", "null", "play_count")])
C06_ITEMS = {"top_artists": "artist_name", "daily_pattern": "hour_label", "weekly_pattern": "day_type",
             "popularity_distribution": "popularity_tier"}


@query("c06_parametrized_insight", f"select user_id, insight, item, play_count from ({C06_SQL}) x")
def c06_parametrized_insight(spark, sf):
    """Every insight by its name (days_back=90; the daily pattern is capped at 30 days); another name is an error."""
    p, users = _plays(spark, sf), fx.users(spark, sf)
    parts = [D.run_insight(n, p, AS_OF, 90, 10, users).select(
        "user_id", F.lit(n).alias("insight"), F.col(item).cast("string").alias("item"), F.col("play_count").cast("bigint").alias("play_count"))
        for n, item in C06_ITEMS.items()]
    try:
        D.run_insight("no_such_insight", p)
    except ValueError:
        return reduce(lambda a, b: a.unionByName(b), parts)
    raise AssertionError("an unknown insight name must be refused")


def _exec_sql(days: int) -> str:
    return f"""
with t3 as ({_top_sql(days, 3)}),
top as (select user_id, arg_min(artist_name, rank) top_artist_raw, sum(play_count) total_top_plays
        from t3 group by user_id),
u as (select distinct user_id from plays),
w as (select user_id, count(*) filter (where not dw) wd, count(*) filter (where dw) we,
        count(distinct case when not dw then cast(played_at_local as date) end) wdd,
        count(distinct case when dw then cast(played_at_local as date) end) wed
      from (select *, play_day_of_week in (1, 7) dw from plays where {win(days)}) z group by user_id),
x as (select u.user_id, coalesce(wd, 0) wd, coalesce(we, 0) we, coalesce(wdd, 0) wdd, coalesce(wed, 0) wed
      from u left join w using (user_id)),
dom as ({_dominant_sql(days)})
select x.user_id, coalesce(top.top_artist_raw, 'No disponible') top_artist,
  cast(coalesce(top.total_top_plays, 0) as bigint) total_top_plays,
  case when round_even(case when wd + we > 0 then cast(we as double) / (wd + we) * 100 else 0.0 end, 1) > 60
       then 'fin de semana' else 'días laborales' end listening_preference,
  case dom.dominant_tier when 'emergent' then 'Descubridor Underground' when 'growing' then 'Explorador Equilibrado'
       when 'established' then 'Amante del Mainstream' else 'Explorador' end music_taste_profile,
  case when wdd + wed = 0 then 'Casual'
       when cast(wd + we as double) / (wdd + wed) > 50 then 'Muy Activo'
       when cast(wd + we as double) / (wdd + wed) > 20 then 'Activo'
       when cast(wd + we as double) / (wdd + wed) > 5 then 'Moderado' else 'Casual' end activity_level
from x left join top on top.user_id = x.user_id left join dom on dom.user_id = x.user_id"""


@query("c07_executive_summary", _exec_sql(30))
def c07_executive_summary(spark, sf):
    """Top artist, top-3 plays, weekend preference, taste label and activity level (30 days)."""
    return D.executive_summary(_plays(spark, sf), AS_OF, 30, users=fx.users(spark, sf))


@query("p27_taste_label", f"""
select user_id, dominant_tier, case dominant_tier when 'emergent' then 'Descubridor Underground'
  when 'growing' then 'Explorador Equilibrado' when 'established' then 'Amante del Mainstream' else 'Explorador' end
  music_taste_profile from ({_dominant_sql(7)}) d""")
def p27_taste_label(spark, sf):
    """Dominant popularity tier (7 days) mapped to its taste label."""
    s = I.popularity_summary(_plays(spark, sf), AS_OF, 7, users=fx.users(spark, sf))
    return s.select("user_id", "dominant_tier", L.taste_label("dominant_tier").alias("music_taste_profile"))


def _activity_sql(days):
    return f"""
with u as (select distinct user_id from plays),
w as (select user_id, count(*) n, count(distinct cast(played_at_local as date)) d,
        count(*) filter (where play_day_of_week in (1, 7)) we
      from plays where {win(days)} group by user_id)
select u.user_id, coalesce(n, 0) plays_total, coalesce(d, 0) days_total,
  case when coalesce(d, 0) = 0 then 'Casual' when cast(n as double) / d > 50 then 'Muy Activo'
       when cast(n as double) / d > 20 then 'Activo' when cast(n as double) / d > 5 then 'Moderado'
       else 'Casual' end activity_level,
  case when round_even(case when coalesce(n, 0) > 0 then cast(we as double) / n * 100 else 0.0 end, 1) > 60
       then 'fin de semana' else 'días laborales' end listening_preference
from u left join w using (user_id)"""


def _activity(spark, sf, days):
    a = I._weekly_agg(_plays(spark, sf), AS_OF, days)
    plays_total = F.col("weekday_plays") + F.col("weekend_plays")
    days_total = F.col("weekday_days") + F.col("weekend_days")
    return a.select("user_id", plays_total.alias("plays_total"), days_total.alias("days_total"),
                    L.activity_level(plays_total, days_total).alias("activity_level"),
                    L.listening_preference(L.pct("weekend_plays", plays_total)).alias("listening_preference"))


@query("p28_activity_level", _activity_sql(90))
def p28_activity_level(spark, sf):
    """Plays per active day -> activity label (90 days); also the weekend preference."""
    return _activity(spark, sf, 90)


@query("p29_listening_preference", _activity_sql(3))
def p29_listening_preference(spark, sf):
    """Weekend share (rounded to 1 decimal) above 60 % -> weekend preference (3 days: many zero users)."""
    return _activity(spark, sf, 3)


# --- recents / ranges -------------------------------------------------------------

RECENT_SQL = """
select user_id, cast(rn as int) recent_rank, track_id, artist_name, strftime(played_at_utc, '%Y-%m-%d') played_date
from (select *, row_number() over (partition by user_id order by played_at_utc desc, track_id, artist_id) rn
      from plays) r where rn <= {n}"""


@query("w02_recent_plays", RECENT_SQL.format(n=10))
def w02_recent_plays(spark, sf):
    """10 most recent plays per user with the play date (text before 'T')."""
    return D.recent_plays(_plays(spark, sf), 10)


@query("w01_positional_rank", RECENT_SQL.format(n=50))
def w01_positional_rank(spark, sf):
    """1-based position of each play in the user's most-recent-first list (collector page of 50)."""
    return D.recent_plays(_plays(spark, sf), 50)


RANGES = {"short_term": 7, "medium_term": 14, "long_term": None}   # the fixture's month has no 4-week-old plays to tell apart
RANGES_SQL = "rng(time_range, d) as (values ('short_term', 7), ('medium_term', 14), ('long_term', null))"


def _ranges_sql(limit: int, key: str = "artist_name") -> str:
    return f"""
with {RANGES_SQL},
t as (select p.user_id, p.{key}, p.popularity, rng.time_range from plays p
      join rng on rng.d is null or cast(p.played_at_local as date) >= date '{AS_OF}' - rng.d),
g as (select user_id, time_range, {key}, count(*) play_count, max(popularity) popularity
      from t group by user_id, time_range, {key})
select user_id, time_range, cast(rank as int) rank, {key}, play_count, popularity from (
  select *, row_number() over (partition by user_id, time_range order by play_count desc, {key}) rank from g) r
where rank <= {limit}"""


@query("w06_top_by_range", _ranges_sql(5))
def w06_top_by_range(spark, sf):
    """Top 5 artists per user for three ranges (the longest without a bound), ranked by plays."""
    return D.top_by_range(_plays(spark, sf), AS_OF, RANGES, 5)


@query("w06_top_tracks_by_range", _ranges_sql(5, "track_id"))
def w06_top_tracks_by_range(spark, sf):
    """Top 5 tracks per user for the same ranges."""
    return D.top_by_range(_plays(spark, sf), AS_OF, RANGES, 5, ("track_id",))


J06_SQL = f"""
with rk as ({_ranges_sql(50)}),
pv as (select user_id, artist_name,
         cast(min(rank) filter (where time_range = 'short_term') as int) rank_short_term,
         cast(min(rank) filter (where time_range = 'medium_term') as int) rank_medium_term,
         cast(min(rank) filter (where time_range = 'long_term') as int) rank_long_term
       from rk group by user_id, artist_name)
select * from pv
where (rank_short_term is not null)::int + (rank_medium_term is not null)::int + (rank_long_term is not null)::int >= 2"""


@query("j06_rank_comparison", J06_SQL)
def j06_rank_comparison(spark, sf):
    """Artists ranked in at least two of the three ranges, with their rank in each (top 50)."""
    return D.rank_comparison(_plays(spark, sf), AS_OF, RANGES, 50)


@query("k04_nulls_last_sort", f"""
with j as ({J06_SQL})
select user_id, artist_name, rank_medium_term, cast(row_number() over (
  partition by user_id order by rank_medium_term asc nulls last, artist_name) as int) position from j
order by user_id, position""")
def k04_nulls_last_sort(spark, sf):
    """Per user, the whole comparison in the order of medium-range rank, nulls last, with each row's position."""
    j = D.rank_comparison(_plays(spark, sf), AS_OF, RANGES, 50)
    w = Window.partitionBy("user_id").orderBy(F.asc_nulls_last("rank_medium_term"), F.asc("artist_name"))
    return (j.withColumn("position", F.row_number().over(w)).select("user_id", "artist_name", "rank_medium_term", "position")
            .orderBy("user_id", "position"))


@query("u02_distinct_names", f"""
select distinct user_id, artist_name from ({_ranges_sql(50)}) r""")
def u02_distinct_names(spark, sf):
    """Distinct union of artist names over the three ranked lists."""
    return D.distinct_ranked_names(_plays(spark, sf), AS_OF, RANGES, 50)


C10_SQL = f"""
with {CATALOG_CLEAN},
rec as ({RECENT_SQL.format(n=10)}),
t as (select user_id, artist_id, artist_name, count(*) play_count from plays where {win(7)}
      group by user_id, artist_id, artist_name),
tr as (select * from (select *, row_number() over (partition by user_id order by play_count desc, artist_id, artist_name)
       rank from t) x where rank <= 5)
select user_id, 'recent' card, recent_rank position, track_id item, played_date detail, cast(null as int) popularity
from rec
union all
select tr.user_id, 'top_artist', cast(tr.rank as int), tr.artist_name,
  case when len(coalesce(ca.genres, [])) > 0 then array_to_string(ca.genres, ', ') else 'No genres' end,
  cast(floor(coalesce(ca.popularity, 50) / 10) * 10 as int)
from tr left join ca on ca.id = tr.artist_id"""


@query("c10_recents_card", C10_SQL)
def c10_recents_card(spark, sf):
    """10 recent plays + top 5 short-range artists with decile popularity and genres text."""
    catalog = G.clean_artists(fx.artists_raw(spark, sf))
    return D.recents_card(_plays(spark, sf), catalog, AS_OF, RANGES["short_term"])


@query("c11_weekly_evolution", """
with g as (select user_id, cast(date_trunc('week', played_at_local) as date) week_start, count(*) plays,
             count(distinct artist_id) distinct_artists from plays group by user_id, week_start),
f as (select user_id, min(week_start) first_week from g group by user_id)
select g.user_id, g.week_start, g.plays, g.distinct_artists,
  case when g.week_start > first_week then g.plays - coalesce(p.plays, 0) end plays_change,
  (g.plays - p.plays) / cast(p.plays as double) * 100 plays_change_pct
from g join f on f.user_id = g.user_id left join g p on p.user_id = g.user_id and p.week_start = g.week_start - 7""")
def c11_weekly_evolution(spark, sf):
    """Weekly plays and distinct artists per user with the change against the previous week."""
    return D.weekly_evolution(_plays(spark, sf))


J09_SQL = f"""
with {_profiled_sql(30)},
rc as (select user_id, string_agg(recent_rank || ' ' || track_id || ' ' || played_date, '|' order by recent_rank) recents
       from ({RECENT_SQL.format(n=10)}) r group by user_id),
tp as (select user_id, string_agg("rank" || ' ' || artist_name || ' ' || play_count, '|' order by "rank") tops
       from ({_top_sql(90, 5)}) t group by user_id),
ex as ({_exec_sql(30)}),
av as (select user_id, bool_or({win(90)}) or bool_or({win(30)}) insights_available from plays group by user_id)
select rc.user_id, rc.recents, coalesce(tp.tops, '') tops, av.insights_available, ex.top_artist, ex.listening_preference,
  ex.music_taste_profile, ex.activity_level, coalesce(prof.profile_name, 'Casual Listener') profile_name,
  coalesce(prof.profile_emoji, '🎵') profile_emoji
from rc left join tp on tp.user_id = rc.user_id left join av on av.user_id = rc.user_id
left join ex on ex.user_id = rc.user_id left join prof on prof.user_id = rc.user_id"""


@query("j09_dashboard_combination", J09_SQL)
def j09_dashboard_combination(spark, sf):
    """Per user in one row: the recent plays, the top artists, the executive insights and the profile."""
    from encore.plans.queries_profiles import _profiled
    d = D.dashboard(_plays(spark, sf), _profiled(spark, sf, 30), AS_OF, users=fx.users(spark, sf))
    line = lambda c, *keys: F.array_join(F.transform(c, lambda x: F.concat_ws(" ", *[x[k].cast("string") for k in keys])), "|")
    return d.select("user_id", line("recents", "recent_rank", "track_id", "played_date").alias("recents"),
                    line("tops", "rank", "artist_name", "play_count").alias("tops"), "insights_available", "top_artist",
                    "listening_preference", "music_taste_profile", "activity_level", "profile_name", "profile_emoji")


# --- row-level labels ------------------------------------------------------------

@query("p16_popularity_tier", """
select event_id, popularity, case when popularity <= 40 then 'emergent' when popularity <= 70 then 'growing'
  else 'established' end popularity_tier from plays""")
def p16_popularity_tier(spark, sf):
    """Three popularity tiers (<=40, <=70, else)."""
    return _plays(spark, sf).select("event_id", "popularity", L.popularity_tier("popularity").alias("popularity_tier"))


@query("p19_day_type", """
select event_id, play_day_of_week, case when play_day_of_week in (1, 7) then 'weekend' else 'weekday' end day_type
from plays""")
def p19_day_type(spark, sf):
    """Weekend = day of week 1 (Sunday) or 7 (Saturday)."""
    return _plays(spark, sf).select("event_id", "play_day_of_week", L.day_type("play_day_of_week").alias("day_type"))


@query("p20_valid_range_guard", """
select event_id, popularity,
  case when cast(popularity as double) between 0 and 100 then cast(popularity as double) end valid_popularity
from plays""")
def p20_valid_range_guard(spark, sf):
    """Popularity outside 0..100 becomes NULL before aggregation."""
    return _plays(spark, sf).select("event_id", "popularity", L.valid_range("popularity").alias("valid_popularity"))


@query("p21_decile_floor", """
select event_id, popularity, cast(floor(coalesce(popularity, 50) / 10) * 10 as int) popularity_decile from plays""")
def p21_decile_floor(spark, sf):
    """Popularity floored to its decile (default 50)."""
    return _plays(spark, sf).select("event_id", "popularity", L.decile_floor("popularity").alias("popularity_decile"))


@query("p22_date_part", """
select user_id, track_id, played_at, split_part(played_at, 'T', 1) played_date from raw_plays""")
def p22_date_part(spark, sf):
    """Text before the 'T' of the ISO play time (NULL stays NULL, 'bad' stays 'bad')."""
    r = fx.raw_plays(spark, sf)
    return r.select("user_id", "track_id", "played_at", date_part_of_iso("played_at").alias("played_date"))


@query("p23_reformat_date", """
select user_id, track_id, played_at,
  coalesce(strftime(try_strptime(split_part(played_at, '.', 1), '%Y-%m-%dT%H:%M:%S'), '%Y-%m-%d'), played_at)
  display_date from raw_plays""")
def p23_reformat_date(spark, sf):
    """ISO time -> 'yyyy-MM-dd' display date, original text when it cannot be parsed."""
    r = fx.raw_plays(spark, sf)
    return r.select("user_id", "track_id", "played_at", reformat_date("played_at").alias("display_date"))


@query("p26_hour_label", """
select event_id, play_hour, lpad(cast(play_hour as varchar), 2, '0') || ':00' hour_label from plays""")
def p26_hour_label(spark, sf):
    """Hour as 'HH:00'."""
    return _plays(spark, sf).select("event_id", "play_hour", L.hour_label("play_hour").alias("hour_label"))


@query("p25_strict_numeric", """
select o_orderkey, coalesce(try_cast(o_orderpriority as double), 0.0) priority_num,
  coalesce(try_cast(split_part(o_orderpriority, '-', 1) as double), 0.0) priority_prefix_num from orders""")
def p25_strict_numeric(spark, sf):
    """Strict coercion: unparseable text -> 0 (priority text), numeric prefix parses."""
    o = read_table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).alias("priority_prefix"))
    strict, _ = X.numeric_coercion(o, ["o_orderpriority", "priority_prefix"])
    return strict.select("o_orderkey", F.col("o_orderpriority_num").alias("priority_num"),
                         F.col("priority_prefix_num").alias("priority_prefix_num"))


@query("p25_lenient_numeric", """
select bool_and(o_orderpriority is null or try_cast(o_orderpriority as double) is not null) priority_is_numeric,
  bool_and(split_part(o_orderpriority, '-', 1) is null or try_cast(split_part(o_orderpriority, '-', 1) as double)
    is not null) priority_prefix_is_numeric from orders""")
def p25_lenient_numeric(spark, sf):
    """Lenient coercion decision: a text column converts only if every value does."""
    o = read_table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("priority"),
        F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).alias("priority_prefix"))
    _, lenient = X.numeric_coercion(o, ["priority", "priority_prefix"])
    return lenient


@query("p30_display_rename", """
select strftime(played_at_utc, '%Y-%m-%d %H:%M:%S') "Reproducido el", track_id "Canción", artist_name "Artista(s)",
  duration_ms "Duración (ms)", popularity "Popularidad" from plays""")
def p30_display_rename(spark, sf):
    """Play export with Spanish display headers."""
    return X.export_plays(_plays(spark, sf))


# --- exploration aggregates -------------------------------------------------------

@query("a18_value_counts", "select artist_name, count(*) count from plays group by artist_name")
def a18_value_counts(spark, sf):
    """Frequency of each artist name, most frequent first."""
    return X.value_counts(_plays(spark, sf), "artist_name")


DESCRIBE_COLS = ["duration_ms", "popularity"]


@query("a19_describe", """
with l as (unpivot (select cast(duration_ms as double) duration_ms, cast(popularity as double) popularity from plays)
           on duration_ms, popularity into name col value v)
select col "column", s.stat, s.value from (
  select col, [{'stat': 'count', 'value': cast(count(v) as double)}, {'stat': 'mean', 'value': avg(v)},
    {'stat': 'std', 'value': stddev_samp(v)}, {'stat': 'min', 'value': min(v)}, {'stat': 'max', 'value': max(v)},
    {'stat': '25%', 'value': quantile_cont(v, 0.25)}, {'stat': '50%', 'value': quantile_cont(v, 0.5)},
    {'stat': '75%', 'value': quantile_cont(v, 0.75)}] st from l group by col) g, unnest(st) u(s)""")
def a19_describe(spark, sf):
    """count / mean / std / min / quartiles / max of duration and popularity (exact quartiles)."""
    return X.describe(_plays(spark, sf), DESCRIBE_COLS)


@query("a20_null_profile", """
select column_name, non_null, rows - non_null nulls from (
  select count(*) rows, count(user_id) c_user_id, count(track_id) c_track_id, count(artist_id) c_artist_id,
    count(artist_name) c_artist_name, count(played_at) c_played_at from raw_plays) a,
  unnest([{'column_name': 'user_id', 'non_null': c_user_id}, {'column_name': 'track_id', 'non_null': c_track_id},
          {'column_name': 'artist_id', 'non_null': c_artist_id}, {'column_name': 'artist_name', 'non_null': c_artist_name},
          {'column_name': 'played_at', 'non_null': c_played_at}]) u(s),
  lateral (select s.column_name, s.non_null) x""")
def a20_null_profile(spark, sf):
    """Non-null and null counts per column of the raw play rows (one aggregation)."""
    return X.null_profile(fx.raw_plays(spark, sf)).select("column_name", "non_null", "nulls")


@query("a23_plays_per_user", "select user_id, count(*) plays from plays group by user_id")
def a23_plays_per_user(spark, sf):
    """Plays per user, most active first."""
    return (_plays(spark, sf).groupBy("user_id").agg(F.count(F.lit(1)).alias("plays"))
            .orderBy(F.desc("plays"), F.asc("user_id")))


@query("a24_likes_per_artist", "select artists_id, count(*) likes from likes group by artists_id")
def a24_likes_per_artist(spark, sf):
    """Likes per primary artist id, most liked first."""
    return (fx.likes(spark, sf).groupBy("artists_id").agg(F.count(F.lit(1)).alias("likes"))
            .orderBy(F.desc("likes"), F.asc("artists_id")))


@query("k05_rank_bounded_filter", """
select user_id, ith_preference, track_id from top_tracks where ith_preference <= 5""")
def k05_rank_bounded_filter(spark, sf):
    """Top tracks with rank <= 5."""
    return fx.top_tracks(spark, sf).filter(F.col("ith_preference") <= 5).select("user_id", "ith_preference", "track_id")


@query("k02_result_ordering", """
select user_id, count(*) total_plays from plays group by user_id""")
def k02_result_ordering(spark, sf):
    """Users ordered by total plays descending (global sort by range partitioning)."""
    return (_plays(spark, sf).groupBy("user_id").agg(F.count(F.lit(1)).alias("total_plays"))
            .orderBy(F.desc("total_plays"), F.asc("user_id")))


@query("k02_order_by_hour", _hourly_sql(30))
def k02_order_by_hour(spark, sf):
    """The hourly pattern in the order of user and hour."""
    return I.hourly_pattern(_plays(spark, sf), AS_OF, 30, users=fx.users(spark, sf)).orderBy("user_id", "hour")


@query("k02_order_by_popularity", _tiers_sql(90))
def k02_order_by_popularity(spark, sf):
    """The popularity tiers of each user in the order of average popularity."""
    return I.popularity_distribution(_plays(spark, sf), AS_OF, 90, users=fx.users(spark, sf)).orderBy("user_id", "avg_popularity", "popularity_tier")


@query("k07_head_tail", """
(select event_id, user_id, played_at_utc, 'head' part from plays order by played_at_utc, event_id limit 5)
union all
(select event_id, user_id, played_at_utc, 'tail' part from plays order by played_at_utc desc, event_id desc limit 5)""")
def k07_head_tail(spark, sf):
    """First and last 5 plays in time order (sample: the limit is the feature)."""
    p = _plays(spark, sf).select("event_id", "user_id", "played_at_utc")
    return instants_as_ntz(X.head_tail(p, ["played_at_utc", "event_id"], 5))


@query("s15_parquet_scan", """
select event_id, user_id, value from events""")
def s15_parquet_scan(spark, sf):
    """Direct parquet scan of one table file with a 3-column read schema, all rows."""
    return read_table(spark, sf, "events").select("event_id", "user_id", "value")


@query("s18_sync_ledger", """
with pr as (select distinct user_id, file_name, true present from ledger),
pl as (select m.user_id, m.file_name, coalesce(pr.present, false) and m.file_name like '%.csv' skipped
       from manifest m left join pr on pr.user_id = m.user_id and pr.file_name = m.file_name)
select user_id, count(*) processed, count(*) filter (where not skipped) uploaded,
  count(*) filter (where skipped) skipped from pl group by user_id""")
def s18_sync_ledger(spark, sf):
    """Incremental sync: CSV keys already in the ledger are skipped, everything else is sent."""
    return X.sync_summary(X.sync_plan(fx.manifest(spark, sf), fx.ledger(spark, sf)))


@query("j08_anti_join", """
select user_id, file_name from manifest m where file_name like '%.csv'
  and not exists (select 1 from ledger l where l.user_id = m.user_id and l.file_name = m.file_name)
union all
select user_id, file_name from manifest where file_name not like '%.csv'""")
def j08_anti_join(spark, sf):
    """Files to send: CSV keys absent from the ledger (left anti join) plus all other files."""
    return X.files_to_send(fx.manifest(spark, sf), fx.ledger(spark, sf))


@query("s22_followed_document", """
select user_id, cast(0 as int) document_no, to_json({'artists_ids': list_sort(list(artist_id))}) document
from follows group by user_id""")
def s22_followed_document(spark, sf):
    """Numbered {"artists_ids": [...]} JSON documents per user (one each here: up to 100,000 artists a document)."""
    return X.followed_document(fx.follows(spark, sf))


@query("a26_job_outcome", f"""with {DEDUP}
select r.user_id, case when coalesce(c.n, 0) > 0 then 'processed' else 'failed' end status, coalesce(c.n, 0) records
from (select distinct user_id from raw_rows) r left join (select user_id, count(*) n from dedup group by user_id) c
  using (user_id)""")
def a26_job_outcome(spark, sf):
    """Per-user status of the plays ETL over rows in memory; the same rule as the jobs' outcome."""
    q = etl.plays_quality_one_pass(fx.raw_play_rows(spark, sf))
    return q.select("user_id", jobs.status(F.col("clean_records")).alias("status"), F.col("clean_records").alias("records"))
