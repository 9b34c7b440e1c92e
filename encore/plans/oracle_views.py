"""DuckDB text of the fixture views (FIXTURES.md B.1), inlined as CTEs by the oracle.

The driver registers only the base tables in DuckDB, so every oracle query is
``WITH <views it needs> SELECT ...``. ``plays`` additionally carries the two
derived columns the cleaned table has (``duration_minutes``, ``season``).
"""

from __future__ import annotations

import re

AS_OF = "2024-01-31"

VIEWS: dict[str, str] = {
    "plays": """
  select *, floor((duration_ms + 300) / 600) / 100 duration_minutes,
    case when play_month between 3 and 5 then 'Spring' when play_month between 6 and 8 then 'Summer'
         when play_month between 9 and 11 then 'Fall' else 'Winter' end season
  from (
    with base as (
      select event_id, user_id uid, event_type, value, cast(json_extract_string(props, '$.k') as int) k,
        case when user_id % 5 = 0
          then date_trunc('day', ts) + interval 6 hour + (hour(ts) % 6) * interval 1 hour + minute(ts) * interval 1 minute
          else ts end played_at_utc
      from events),
    loc as (select *, played_at_utc - interval 6 hour played_at_local from base)
    select event_id, event_type, k, cast(uid as varchar) user_id, played_at_utc, played_at_local,
      concat('T', cast(k % (4 + uid % 90) as varchar)) track_id,
      concat('A', cast(k % (3 + uid % 60) as varchar)) artist_id,
      concat('Artist ', cast(k % (3 + uid % 60) as varchar)) artist_name,
      60000 + cast(floor(value * 1000) as bigint) duration_ms,
      cast(case when uid % 3 = 0 then 45 + floor(value / 4) else floor(value * (1 + uid % 4) / 2.0) end as int) popularity,
      event_type = 'error' explicit,
      cast(hour(played_at_local) as int) play_hour, cast(dayofweek(played_at_local) + 1 as int) play_day_of_week,
      cast(month(played_at_local) as int) play_month, cast(year(played_at_local) as int) play_year
    from loc) p0""",
    "raw_plays": """
  select user_id, track_id, case when k % 41 = 0 then null else artist_id end artist_id,
    case when k % 7 = 0 then '' when k % 11 = 0 then null else concat('  ', artist_name, ' ') end artist_name,
    case when event_id % 97 = 0 then null when event_id % 89 = 0 then 'bad'
      else strftime(played_at_utc, '%Y-%m-%dT%H:%M:%S.') || strftime(played_at_utc, '%g') || 'Z' end played_at
  from plays
  union all
  select user_id, track_id, artist_id, concat('  ', artist_name, ' '),
    strftime(played_at_utc, '%Y-%m-%dT%H:%M:%S.') || strftime(played_at_utc, '%g') || 'Z'
  from plays where event_id % 10 = 0""",
    "likes": """
  select user_id, played_at_utc added_at_utc, played_at_local added_at_local, track_id,
    case when k % 25 = 0 then '-1' when k % 26 = 0 then '' else artist_id end artists_id,
    popularity track_popularity, explicit, duration_ms
  from plays where event_type = 'purchase'""",
    "follows_raw": "select user_id, artist_id from plays where event_type = 'signup'",
    "follows": "select distinct user_id, artist_id from plays where event_type = 'signup'",
    "top_tracks": """
  with c as (select user_id, track_id, min(artist_id) artists_id, max(popularity) track_popularity, count(*) n
             from plays group by user_id, track_id),
  r as (select *, row_number() over (partition by user_id order by n desc, track_id) rn from c)
  select user_id, cast(rn as int) ith_preference, track_id, artists_id, track_popularity from r where rn <= 50""",
    "artists_raw": """
  with g as (select *, ['reggaeton','trap latino','k-pop','death metal','indie rock','deep house','hip hop','smooth jazz',
    'country pop','baroque','roots reggae','celtic','banda','bossa nova','drill'] gs from part)
  select case when p_partkey % 101 = 0 then null else concat('A', cast(p_partkey as varchar)) end id,
    concat(' ', p_name, '  ') as name,
    case when p_partkey % 17 = 0 then null else p_size * 2 end popularity, cast(p_partkey * p_partkey * 5 as bigint) followers,
    case when p_partkey % 13 = 0 then null when p_partkey % 11 = 0 then []
      else [gs[cast(1 + p_partkey % 15 as int)], gs[cast(1 + (p_partkey * 7) % 15 as int)]] end genres
  from g""",
    "manifest": """
  select source user_id, cast(doc_id as varchar) || case when lang = 'en' then '.csv' else '.json' end file_name
  from documents""",
    "ledger": """
  select source user_id, cast(doc_id as varchar) || case when lang = 'en' then '.csv' else '.json' end file_name
  from documents where doc_id % 3 = 0""",
}

DEPS = {
    "plays": [], "raw_plays": ["plays"], "likes": ["plays"], "follows_raw": ["plays"], "follows": ["plays"],
    "top_tracks": ["plays"], "artists_raw": [], "manifest": [], "ledger": [],
}


def with_views(sql: str, extra_ctes: str = "") -> str:
    """Prefix ``sql`` with the fixture views it references, dependencies first."""
    needed: list[str] = []

    def add(v):
        for d in DEPS[v]:
            add(d)
        if v not in needed:
            needed.append(v)

    text = sql + " " + extra_ctes
    for v in VIEWS:
        if re.search(rf"\b{v}\b", text):
            add(v)
    ctes = [f"{v} as ({VIEWS[v]}\n)" for v in needed]
    if extra_ctes.strip():
        ctes.append(extra_ctes.strip())
    if not ctes:
        return sql
    body = sql.lstrip()
    if re.match(r"(?i)with\s", body):
        # merge the query's own CTE list into ours
        return "with " + ",\n".join(ctes) + ",\n" + body[4:].lstrip()
    return "with " + ",\n".join(ctes) + "\n" + sql
