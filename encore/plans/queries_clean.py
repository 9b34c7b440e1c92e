"""Registered cleaning / dedup queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from encore.functions.output import instants_as_ntz
from encore.operators import etl
from encore.operators.dedup import keep_one
from encore.operators.genres import DATA_SOURCE
from encore.plans.registry import query
from encore.sources import fixtures as fx
from encore.sources.schemas import TABLES

# DuckDB: raw rows in the CSV shape, cleaned rows before dedup, deduplicated rows.
RAW_ROWS = """raw_rows as (
  select user_id, played_at, cast(null as varchar) track_name, artist_name, cast(null as varchar) album_name,
    track_id, artist_id, cast(null as varchar) album_id, cast(null as int) duration_ms, cast(null as int) popularity,
    cast(null as boolean) explicit
  from raw_plays)"""
CLEAN_ROWS = RAW_ROWS + """,
clean_rows as (
  select user_id, track_id, artist_id, album_id, played_at_utc,
    coalesce(trim(track_name), 'Unknown Track') track_name, coalesce(trim(artist_name), 'Unknown Artist') artist_name,
    coalesce(trim(album_name), 'Unknown Album') album_name, coalesce(cast(duration_ms as bigint), 0) duration_ms,
    coalesce(popularity, 0) popularity, coalesce(explicit, false) explicit, played_at_utc - interval 6 hour played_at_local
  from (select *, coalesce(try_strptime(played_at, '%Y-%m-%dT%H:%M:%S.%gZ'), try_strptime(played_at, '%Y-%m-%dT%H:%M:%SZ')) played_at_utc
        from raw_rows where played_at is not null and track_id is not null and artist_id is not null) v)"""
DEDUP = CLEAN_ROWS + """,
dedup as (
  select * exclude (rn) from (
    select *, row_number() over (partition by user_id, track_id, played_at_utc order by
      artist_id asc nulls last, album_id asc nulls last, track_name asc nulls last, artist_name asc nulls last,
      album_name asc nulls last, duration_ms asc nulls last, popularity asc nulls last, explicit asc nulls last,
      played_at_local asc nulls last) rn
    from clean_rows) x where rn = 1)"""
# Landing rows in CSV (as the collector does) cannot keep '' apart from NULL: an empty
# field reads back as NULL (trap T4), so the landed-file pipelines see NULL there.
DEDUP_CSV = DEDUP.replace("track_name, artist_name,", "track_name, nullif(artist_name, '') artist_name,", 1)
assert DEDUP_CSV != DEDUP
SEASON = ("case when month(played_at_local) between 3 and 5 then 'Spring' when month(played_at_local) between 6 and 8 "
          "then 'Summer' when month(played_at_local) between 9 and 11 then 'Fall' else 'Winter' end")


def _raw(spark, sf):
    return fx.raw_play_rows(spark, sf)


def _plays(spark, sf):
    return fx.plays(spark, sf)


@query("c01_plays_etl", f"""with {DEDUP}
select user_id, played_at_utc, played_at_local, track_id, track_name, artist_id, artist_name, album_id, album_name,
  duration_ms, floor((duration_ms + 300) / 600) / 100 duration_minutes, popularity, explicit,
  cast(hour(played_at_local) as int) play_hour, cast(dayofweek(played_at_local) + 1 as int) play_day_of_week,
  cast(month(played_at_local) as int) play_month, cast(year(played_at_local) as int) play_year, {SEASON} season
from dedup""")
def c01_plays_etl(spark, sf):
    """Raw play text of all users -> cleaned, deduplicated user_tracks (processed_at omitted)."""
    out = etl.clean_plays(_raw(spark, sf), with_time=False).drop("processed_at")
    return instants_as_ntz(out)


@query("p01_required_keys", f"""with {RAW_ROWS}
select user_id, track_id, artist_id, played_at from raw_rows
where played_at is not null and track_id is not null and artist_id is not null""")
def p01_required_keys(spark, sf):
    """Rows with played_at, track_id and artist_id present."""
    r = _raw(spark, sf)
    return r.filter(etl.plays_valid(r)).select("user_id", "track_id", "artist_id", "played_at")


@query("p05_default_fill", f"""with {CLEAN_ROWS}
select user_id, track_id, track_name, artist_name, album_name, duration_ms, popularity, explicit from clean_rows""")
def p05_default_fill(spark, sf):
    """Trimmed names with typed defaults (Unknown Track/Artist/Album, 0, false); blank stays ''."""
    return etl.clean_plays_rows(_raw(spark, sf)).select(
        "user_id", "track_id", "track_name", "artist_name", "album_name", "duration_ms", "popularity", "explicit")


@query("p08_parse_utc", """
select user_id, track_id, played_at,
  coalesce(try_strptime(played_at, '%Y-%m-%dT%H:%M:%S.%gZ'), try_strptime(played_at, '%Y-%m-%dT%H:%M:%SZ')) played_at_utc
from raw_plays""")
def p08_parse_utc(spark, sf):
    """ISO text -> UTC instant; NULL for missing or unparseable text."""
    from encore.functions.time import parse_utc
    r = fx.raw_plays(spark, sf)
    return instants_as_ntz(r.select("user_id", "track_id", "played_at", parse_utc("played_at").alias("played_at_utc")))


@query("p09_local_time", f"""with {CLEAN_ROWS}
select user_id, track_id, played_at_utc, played_at_local from clean_rows""")
def p09_local_time(spark, sf):
    """UTC instant -> America/Mexico_City wall clock."""
    return instants_as_ntz(etl.clean_plays_rows(_raw(spark, sf)).select(
        "user_id", "track_id", "played_at_utc", "played_at_local"))


@query("p10_duration_minutes", """
select event_id, duration_ms, duration_minutes from plays""")
def p10_duration_minutes(spark, sf):
    """Duration in minutes rounded half-up to 2 decimals."""
    return _plays(spark, sf).select("event_id", "duration_ms", "duration_minutes")


@query("p11_calendar_fields", """
select event_id, play_hour, play_day_of_week, play_month, play_year from plays""")
def p11_calendar_fields(spark, sf):
    """Hour, day of week (1 = Sunday), month, year of the local time."""
    return _plays(spark, sf).select("event_id", "play_hour", "play_day_of_week", "play_month", "play_year")


@query("p12_season", f"""with {DEDUP}
select user_id, track_id, cast(month(played_at_local) as int) play_month, {SEASON} season from dedup""")
def p12_season(spark, sf):
    """Season of the local month; NULL month (unparsed time) -> Winter."""
    c = etl.clean_plays(_raw(spark, sf), with_time=False)
    return c.select("user_id", "track_id", "play_month", "season")


@query("p13_lineage", f"""with {DEDUP}
select user_id, track_id, '{DATA_SOURCE}' data_source, true has_processed_at from dedup""")
def p13_lineage(spark, sf):
    """Lineage columns: user_id from the input, a source literal and a processing time."""
    c = etl.with_lineage(etl.clean_plays(_raw(spark, sf), with_time=False), DATA_SOURCE)
    return c.select("user_id", "track_id", "data_source",
                    F.col("processed_at").isNotNull().alias("has_processed_at"))


@query("p14_column_order", """
select user_id, played_at_utc, played_at_local, track_id, artist_id, artist_name, duration_ms, duration_minutes,
  popularity, explicit, play_hour, play_day_of_week, play_month, play_year, season from plays""")
def p14_column_order(spark, sf):
    """Projection of the plays table in registry order (columns the fixture has)."""
    p = _plays(spark, sf)
    cols = [c for c in TABLES["user_tracks"].columns if c in p.columns]
    return instants_as_ntz(p.select(*cols))


@query("u01_union_all", """
select user_id, track_id, artist_id, artist_name, played_at from raw_plays""")
def u01_union_all(spark, sf):
    """Union-by-name of the per-file frames (first pull + overlapping re-pull)."""
    return fx.raw_plays(spark, sf)


@query("u03_dedup_plays", f"""with {DEDUP}
select user_id, track_id, played_at_utc, artist_name from dedup""")
def u03_dedup_plays(spark, sf):
    """Plays deduplicated on (user_id, track_id, played_at_utc), deterministic survivor."""
    rows = etl.clean_plays_rows(_raw(spark, sf))
    return instants_as_ntz(keep_one(rows, TABLES["user_tracks"].key)
                           .select("user_id", "track_id", "played_at_utc", "artist_name"))


@query("w03_keep_one", """
select user_id, track_id, played_at_utc, event_id from (
  select *, row_number() over (partition by user_id, track_id, played_at_utc order by event_id) rn from plays) x
where rn = 1""")
def w03_keep_one(spark, sf):
    """Keep the lowest event_id per (user, track, time) among colliding plays."""
    p = _plays(spark, sf).select("user_id", "track_id", "played_at_utc", "event_id")
    return instants_as_ntz(keep_one(p, ["user_id", "track_id", "played_at_utc"], [F.col("event_id").asc()]))


@query("u04_dedup_likes", """
select user_id, track_id, added_at_utc, artists_id from (
  select *, row_number() over (partition by user_id, track_id, added_at_utc order by
    added_at_local asc nulls last, artists_id asc nulls last, track_popularity asc nulls last,
    explicit asc nulls last, duration_ms asc nulls last) rn from likes) x where rn = 1""")
def u04_dedup_likes(spark, sf):
    """Likes deduplicated on (user_id, track_id, added_at_utc)."""
    lk = fx.likes(spark, sf)
    return instants_as_ntz(keep_one(lk, ["user_id", "track_id", "added_at_utc"])
                           .select("user_id", "track_id", "added_at_utc", "artists_id"))


@query("u05_dedup_follows", """
select distinct user_id, artist_id from follows_raw""")
def u05_dedup_follows(spark, sf):
    """Follow events deduplicated on (user_id, artist_id)."""
    return etl.clean_follows(fx.follows_raw(spark, sf), with_time=False).select("user_id", "artist_id")


@query("u06_dedup_top_tracks", """
select user_id, track_id, ith_preference, artists_id from top_tracks""")
def u06_dedup_top_tracks(spark, sf):
    """Top tracks deduplicated on (user_id, track_id, ith_preference)."""
    t = fx.top_tracks(spark, sf)
    return keep_one(t, ["user_id", "track_id", "ith_preference"]).select(
        "user_id", "track_id", "ith_preference", "artists_id")


@query("a17_quality_report", f"""with {DEDUP},
r as (select user_id, count(*) raw_records, count(*) filter (where track_id is null) null_track_ids,
        count(*) filter (where played_at is not null and track_id is not null and artist_id is not null) valid_records,
        count(*) filter (where played_at is not null and track_id is not null and artist_id is not null and
          coalesce(try_strptime(played_at, '%Y-%m-%dT%H:%M:%S.%gZ'), try_strptime(played_at, '%Y-%m-%dT%H:%M:%SZ')) is null)
          unparsed_times
      from raw_rows group by user_id),
c as (select user_id, count(*) clean_records, min(played_at_utc) min_utc, max(played_at_utc) max_utc,
        min(played_at_local) min_local, max(played_at_local) max_local from dedup group by user_id)
select r.user_id, raw_records, null_track_ids, valid_records, unparsed_times, coalesce(clean_records, 0) clean_records,
  valid_records - coalesce(clean_records, 0) duplicates_removed, min_utc, max_utc, min_local, max_local
from r left join c using (user_id)""")
def a17_quality_report(spark, sf):
    """Per-user data-quality report of the plays ETL: one read, two aggregations."""
    return instants_as_ntz(etl.plays_quality_one_pass(_raw(spark, sf)))
