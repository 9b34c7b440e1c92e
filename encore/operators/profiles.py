"""Rule scores, profile assignment and profile tables.

The profile is a pure function of the user's own features (trap T16: cluster
means are never used by the mapper), so all of this is column expressions plus
map lookups: no join, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The five profiles, their display attributes, and the tie priority.
PROFILES = {
    "mainstream_explorer": {
        "name": "Mainstream Explorer", "emoji": "🎯",
        "description": "Te gustan los éxitos del momento y sigues las tendencias musicales",
        "characteristics": "Popularidad alta (>65), actividad media, horario diurno",
        "criteria": "high_popularity + moderate_activity + day_listening"},
    "underground_hunter": {
        "name": "Underground Hunter", "emoji": "🔍",
        "description": "Descubres artistas antes que nadie y prefieres música alternativa",
        "characteristics": "Popularidad baja (<45), alta diversidad, exploración alta",
        "criteria": "low_popularity + high_diversity + high_exploration"},
    "music_addict": {
        "name": "Music Addict", "emoji": "⚡",
        "description": "La música es tu vida - escuchas constantemente y de todo",
        "characteristics": "Actividad muy alta (>200), diversidad alta, todo el día",
        "criteria": "very_high_activity + high_diversity + consistent_listening"},
    "night_owl": {
        "name": "Night Owl", "emoji": "🌙",
        "description": "Tu momento musical es la noche - música para acompañar las horas tardías",
        "characteristics": "Escucha nocturna (>22h o <6h), actividad selectiva",
        "criteria": "night_listening + selective_activity"},
    "casual_listener": {
        "name": "Casual Listener", "emoji": "🎵",
        "description": "Escuchas música de fondo - prefieres lo conocido y familiar",
        "characteristics": "Baja actividad (<80), popularidad media, horario regular",
        "criteria": "low_activity + moderate_popularity + regular_schedule"},
}
PRIORITY = ["music_addict", "underground_hunter", "night_owl", "mainstream_explorer", "casual_listener"]
DEFAULT_PROFILE = {"cluster": 4, "name": "Casual Listener", "emoji": "🎵",
                   "description": "Escuchas música de fondo - prefieres lo conocido y familiar",
                   "characteristics": "Perfil musical estándar", "user_count": 1, "percentage": 0.0}
METRICS = ["avg_popularity", "daily_listening_intensity", "artist_diversity", "night_preference_ratio",
           "exploration_ratio", "peak_hour"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def profile_scores(features: DataFrame) -> DataFrame:
    """The five integer scores per user."""
    ap, it, dv = _c("avg_popularity"), _c("daily_listening_intensity"), _c("artist_diversity")
    ex, ni, pk = _c("exploration_ratio"), _c("night_preference_ratio"), _c("peak_hour")
    we, lk = _c("weekend_preference_ratio"), _c("like_ratio")

    def pts(cond, n):
        return F.when(cond, F.lit(n)).otherwise(F.lit(0))

    mainstream = (F.when(ap > 65, 3).when(ap > 55, 1).otherwise(0)
                  + pts((it > 3) & (it < 15), 2) + pts((pk >= 9) & (pk <= 18), 2))
    underground = (F.when(ap < 45, 3).when(ap < 55, 1).otherwise(0)
                   + F.when(ex > 25, 2).when(ex > 15, 1).otherwise(0) + pts(dv > 30, 2))
    addict = (F.when(it > 15, 4).when(it > 8, 2).otherwise(0)
              + F.when(dv > 50, 2).when(dv > 25, 1).otherwise(0) + pts(ex > 20, 1))
    night = (F.when(ni > 40, 3).when(ni > 25, 1).otherwise(0)
             + F.when((pk >= 22) | (pk <= 6), 3).when(pk >= 20, 1).otherwise(0) + pts(we > 60, 1))
    casual = pts(it < 8, 2) + pts((ap >= 50) & (ap <= 70), 2) + pts(ex < 20, 1) + pts(lk < 10, 1)
    return features.select("*", mainstream.alias("mainstream_explorer_score"),
                           underground.alias("underground_hunter_score"), addict.alias("music_addict_score"),
                           night.alias("night_owl_score"), casual.alias("casual_listener_score"))


def best_profile_expr() -> Column:
    """Argmax with priority order; all-zero -> casual_listener."""
    scores = {p: F.col(f"{p}_score") for p in PRIORITY}
    top = F.greatest(*scores.values())
    expr = F.when(top == 0, F.lit("casual_listener"))
    for p in PRIORITY:
        expr = expr.when(scores[p] == top, F.lit(p))
    return expr.otherwise(F.lit("casual_listener"))


def _lookup(attr: str, key: Column) -> Column:
    m = F.create_map(*[F.lit(x) for k, v in PROFILES.items() for x in (k, v[attr])])
    return F.element_at(m, key)


def assign_profiles(features: DataFrame) -> DataFrame:
    """M05 + W04 + M06: profile key and display attributes per user."""
    s = profile_scores(features)
    s = s.withColumn("profile_key", best_profile_expr())
    return s.select("*", *[_lookup(a, F.col("profile_key")).alias(f"profile_{a}")
                           for a in ("name", "emoji", "description", "characteristics", "criteria")])


def profile_table(profiled: DataFrame, rounded: bool = True, with_time: bool = True) -> DataFrame:
    """User, cluster, profile attributes, six key metrics (half-even to 2 places), generated_at."""
    metric = (lambda c: F.bround(F.col(c).cast("double"), 2)) if rounded else (lambda c: F.col(c).cast("double"))
    cluster = F.col("cluster") if "cluster" in profiled.columns else F.lit(None).cast("int")
    return profiled.select(
        "user_id", cluster.alias("cluster"), "profile_name", "profile_emoji", "profile_description",
        "profile_characteristics", "profile_criteria", *[metric(c).alias(c) for c in METRICS],
        (F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") if with_time
         else F.lit(None).cast("string")).alias("generated_at"))


def profile_summary(profiled: DataFrame) -> DataFrame:
    """Per profile user count, share of users, mean of four features.

    The share uses a window over the (<= 5 row) aggregate, never over users.
    """
    per = profiled.groupBy("profile_name", "profile_emoji").agg(
        F.count(F.lit(1)).alias("user_count"),
        F.avg("avg_popularity").alias("avg_popularity_mean"),
        F.avg("daily_listening_intensity").alias("daily_intensity_mean"),
        F.avg("artist_diversity").alias("artist_diversity_mean"),
        F.avg("night_preference_ratio").alias("night_preference_mean"))
    total = F.sum("user_count").over(Window.partitionBy())
    return per.withColumn("percentage", F.col("user_count") / total * 100)


def profile_stats(profiles: DataFrame) -> DataFrame:
    """Users and share per profile name from a stored profile table, and the totals over all profiles.

    The windows run over the (<= 5 row) aggregate.
    """
    per = profiles.groupBy("profile_name").agg(F.count(F.lit(1)).alias("user_count"))
    whole = Window.partitionBy()
    return per.select("profile_name", "user_count", (F.col("user_count") / F.sum("user_count").over(whole) * 100).alias("percentage"),
                      F.sum("user_count").over(whole).alias("total_users"), F.count(F.lit(1)).over(whole).alias("profiles"))


def lookup_profiles(probes: DataFrame, profiles: DataFrame, stats: DataFrame) -> DataFrame:
    """J04 + J05 + C09: probe users -> stored profile with its stats, or the default profile.

    ``profiles`` has one row per user; ``stats`` has one row per profile name
    (<= 5 rows, a fixed bound), so it is broadcast.
    """
    p = profiles.select("user_id", "cluster", "profile_name", "profile_emoji", "profile_description",
                        "profile_characteristics")
    j = (probes.select("user_id").join(p, "user_id", "left")
         .join(F.broadcast(stats.select("profile_name", "user_count", "percentage")), "profile_name", "left"))
    found = F.col("cluster").isNotNull() | F.col("profile_name").isNotNull()
    d = DEFAULT_PROFILE
    return j.select(
        "user_id",
        F.when(found, F.coalesce("cluster", F.lit(0))).otherwise(F.lit(d["cluster"])).alias("cluster"),
        F.when(found, F.col("profile_name")).otherwise(F.lit(d["name"])).alias("name"),
        F.when(found, F.col("profile_emoji")).otherwise(F.lit(d["emoji"])).alias("emoji"),
        F.when(found, F.col("profile_description")).otherwise(F.lit(d["description"])).alias("description"),
        F.when(found, F.col("profile_characteristics")).otherwise(F.lit(d["characteristics"])).alias("characteristics"),
        F.when(found, F.col("user_count")).otherwise(F.lit(d["user_count"])).cast("bigint").alias("stats_user_count"),
        F.when(found, F.col("percentage")).otherwise(F.lit(d["percentage"])).cast("double").alias("stats_percentage"),
        found.alias("profile_found"),
    )
