"""The query surface in SQL: named statements with parameters, and the same queries as SQL table functions.

Each function is a view with arguments over the tables of one database. Arguments are values, never pieces of SQL
text, so a quote in a user id is just a character of it; Spark puts them into the plan as literals, so they reach
partition filters and scans. ``user => NULL`` asks for all users.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from encore.sources.layout import BUCKET, MONTH, USER_BUCKETS


@dataclass(frozen=True)
class SqlFunction:
    """``body`` reads tables as ``{db}.name`` and parameters by their names (none is a column's name)."""

    name: str
    params: str
    returns: str
    body: str
    order: str = ""

    @property
    def arguments(self) -> list[str]:
        return [p.split()[0] for p in self.params.split(", ") if p]


_WINDOW = (f"{MONTH} >= date_format(date_sub(as_of, days_back), 'yyyy-MM') AND to_date(played_at_local) >= date_sub(as_of, days_back) "
           f"AND (only_user IS NULL OR (user_id = only_user AND {BUCKET} = pmod(xxhash64(only_user), {USER_BUCKETS})))")
_USERS = (f"(SELECT DISTINCT user_id FROM {{db}}.play_history WHERE only_user IS NULL OR (user_id = only_user AND {BUCKET} = pmod(xxhash64(only_user), "
          f"{USER_BUCKETS})))")
_TIER = "CASE WHEN popularity <= 40 THEN 'emergent' WHEN popularity <= 70 THEN 'growing' ELSE 'established' END"
_IN = "only_user STRING, as_of DATE, days_back INT"

FUNCTIONS = {f.name: f for f in [
    SqlFunction("plays_per_user", "", "user_id STRING, total_plays BIGINT",
                "SELECT user_id, count(*) FROM {db}.play_history GROUP BY user_id", "total_plays DESC, user_id"),
    SqlFunction("top_ranked_tracks", "max_rank INT", "user_id STRING, track_id STRING, artists_id STRING, ith_preference INT",
                "SELECT user_id, track_id, artists_id, ith_preference FROM {db}.top_tracks WHERE ith_preference <= max_rank",
                "user_id, ith_preference, track_id"),
    SqlFunction("likes_per_artist", "", "artists_id STRING, liked_tracks BIGINT",
                "SELECT artists_id, count(*) FROM {db}.likes GROUP BY artists_id", "liked_tracks DESC, artists_id"),
    SqlFunction("artists_by", "in_range STRING, in_genre STRING", "id STRING, name STRING, popularity INT, followers BIGINT, primary_genre STRING",
                "SELECT id, name, popularity, followers, primary_genre FROM {db}.artists_catalog "
                "WHERE popularity_range = in_range AND primary_genre = in_genre", "followers DESC, id"),
    SqlFunction("genre_counts", "", "primary_genre STRING, artist_count BIGINT, avg_popularity DOUBLE",
                "SELECT primary_genre, count(*), avg(popularity) FROM {db}.artists_catalog GROUP BY primary_genre", "artist_count DESC, primary_genre"),
    SqlFunction("top_artists", f"{_IN}, top_n INT", "user_id STRING, rank INT, artist_name STRING, play_count BIGINT, unique_tracks BIGINT", f"""
      SELECT user_id, cast(rn AS INT), artist_name, play_count, unique_tracks FROM (
        SELECT user_id, artist_name, count(*) AS play_count, count(DISTINCT track_id) AS unique_tracks,
          row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, artist_name ASC NULLS LAST) AS rn
        FROM {{db}}.play_history WHERE {_WINDOW} GROUP BY user_id, artist_name)
      WHERE rn <= top_n""", "user_id, rank"),
    SqlFunction("hourly_pattern", _IN, "user_id STRING, hour INT, play_count BIGINT, hour_label STRING", f"""
      SELECT s.user_id, s.h, coalesce(c.n, 0), lpad(cast(s.h AS STRING), 2, '0') || ':00'
      FROM (SELECT user_id, explode(sequence(0, 23)) AS h FROM {_USERS}) s
      LEFT JOIN (SELECT user_id, play_hour, count(*) AS n FROM {{db}}.play_history WHERE {_WINDOW} GROUP BY user_id, play_hour) c
        ON c.user_id = s.user_id AND c.play_hour = s.h""", "user_id, hour"),
    SqlFunction("weekday_weekend", _IN, "user_id STRING, day_type STRING, play_count BIGINT, active_days BIGINT, avg_popularity DOUBLE, percentage DOUBLE", f"""
      SELECT user_id, day_type, n, days, coalesce(pop, 0.0D), if(total > 0, n / cast(total AS DOUBLE) * 100, 0.0D) FROM (
        SELECT s.user_id, s.day_type, coalesce(c.n, 0) AS n, coalesce(c.days, 0) AS days, c.pop, sum(coalesce(c.n, 0)) OVER (PARTITION BY s.user_id) AS total
        FROM (SELECT user_id, explode(array('weekday', 'weekend')) AS day_type FROM {_USERS}) s
        LEFT JOIN (SELECT user_id, if(play_day_of_week IN (1, 7), 'weekend', 'weekday') AS day_type, count(*) AS n,
                     count(DISTINCT to_date(played_at_local)) AS days, avg(cast(popularity AS DOUBLE)) AS pop
                   FROM {{db}}.play_history WHERE {_WINDOW} GROUP BY 1, 2) c
          ON c.user_id = s.user_id AND c.day_type = s.day_type)""", "user_id, day_type"),
    SqlFunction("popularity_tiers", _IN, "user_id STRING, popularity_tier STRING, play_count BIGINT, unique_artists BIGINT, avg_popularity DOUBLE, percentage DOUBLE", f"""
      SELECT user_id, tier, n, artists, coalesce(pop, 0.0D), if(total > 0, n / cast(total AS DOUBLE) * 100, 0.0D) FROM (
        SELECT s.user_id, s.tier, coalesce(c.n, 0) AS n, coalesce(c.artists, 0) AS artists, c.pop, sum(coalesce(c.n, 0)) OVER (PARTITION BY s.user_id) AS total
        FROM (SELECT user_id, explode(array('emergent', 'growing', 'established')) AS tier FROM {_USERS}) s
        LEFT JOIN (SELECT user_id, {_TIER} AS tier, count(*) AS n, count(DISTINCT artist_id) AS artists, avg(cast(popularity AS DOUBLE)) AS pop
                   FROM {{db}}.play_history WHERE popularity IS NOT NULL AND {_WINDOW} GROUP BY 1, 2) c
          ON c.user_id = s.user_id AND c.tier = s.tier)""", "user_id, popularity_tier"),
]}


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def register(spark: SparkSession, database: str) -> None:
    """Make every function of ``FUNCTIONS`` a temporary SQL table function over ``database``."""
    for f in FUNCTIONS.values():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {f.name}({f.params}) RETURNS TABLE ({f.returns}) RETURN {f.body.format(db=_quoted(database))}")


def ask(spark: SparkSession, name: str, **arguments) -> DataFrame:
    """One statement over a registered function, in its order: ``spark.sql(text, args)`` with named parameters."""
    f = FUNCTIONS[name]
    if set(arguments) != set(f.arguments):
        raise ValueError(f"{name} takes {f.arguments}, not {sorted(arguments)}")
    text = f"SELECT * FROM {f.name}({', '.join(f':{a}' for a in f.arguments)})"
    return spark.sql(text + (f" ORDER BY {f.order}" if f.order else ""), args=arguments)
