"""Registered feature / profile queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from encore.operators import clustering as CL
from encore.operators import features as FE
from encore.operators import profiles as PR
from encore.plans.registry import query
from encore.session import scratch_path
from encore.sources import fixtures as fx


def _features(spark, sf, period_days=30):
    return FE.user_features(fx.plays(spark, sf), fx.likes(spark, sf), fx.follows(spark, sf),
                            fx.top_tracks(spark, sf), period_days=period_days)


def _profiled(spark, sf, period_days=30):
    return PR.assign_profiles(_features(spark, sf, period_days))


VP = "case when cast({c} as double) between 0 and 100 then cast({c} as double) end"
USER_STATS = f"""us as (
  select user_id, count(*) total_plays, count(distinct artist_id) artist_diversity, count(distinct track_id) track_diversity,
    avg({VP.format(c='popularity')}) avg_popularity, avg(cast(play_hour as double)) peak_hour,
    avg(case when explicit = true then 1.0 else 0.0 end) * 100 explicit_percentage,
    avg(cast(duration_minutes as double)) avg_track_duration, stddev_samp({VP.format(c='popularity')}) popularity_variance,
    count(*) filter (where play_hour between 22 and 23 or play_hour between 0 and 5) night_plays,
    count(*) filter (where play_hour between 6 and 21) day_plays,
    count(*) filter (where play_hour between 9 and 17) work_hours_plays,
    count(*) filter (where play_day_of_week in (1, 7)) weekend_plays,
    count(*) filter (where play_day_of_week between 2 and 6) weekday_plays
  from plays where user_id is not null and play_hour is not null and play_day_of_week is not null
  group by user_id having count(*) >= 20)"""
LIKE_STATS = f"""ul as (
  select user_id, count(*) total_likes, avg({VP.format(c='track_popularity')}) avg_like_popularity,
    count(distinct artists_id) liked_artists_count
  from likes where user_id is not null and artists_id is not null and artists_id <> '' group by user_id)"""
FOLLOW_STATS = """uf as (select user_id, count(*) total_follows from follows where user_id is not null group by user_id)"""
TOP_STATS = f"""ut as (
  select user_id, count(*) total_top_tracks, avg({VP.format(c='track_popularity')}) avg_top_popularity,
    count(distinct artists_id) top_artists_diversity
  from top_tracks where user_id is not null and artists_id is not null and artists_id <> '' group by user_id)"""


def PCT(n, d):
    return f"case when coalesce({d}, 0) > 0 then cast({n} as double) / ({d}) * 100 else 0.0 end"


def _features_sql(period_days: int) -> str:
    return f"""{USER_STATS},
{LIKE_STATS},
{FOLLOW_STATS},
{TOP_STATS},
f0 as (
  select us.user_id, us.total_plays daily_activity, us.artist_diversity, us.track_diversity,
    coalesce(us.avg_popularity, 50.0) avg_popularity, us.peak_hour, us.explicit_percentage, us.avg_track_duration,
    coalesce(us.popularity_variance, 0.0) popularity_variance,
    {PCT('us.night_plays', 'us.night_plays + us.day_plays')} night_preference_ratio,
    {PCT('us.weekend_plays', 'us.weekend_plays + us.weekday_plays')} weekend_preference_ratio,
    {PCT('us.work_hours_plays', 'us.total_plays')} work_hours_ratio,
    coalesce(ul.total_likes, 0) total_likes, coalesce(ul.avg_like_popularity, us.avg_popularity) avg_like_popularity,
    coalesce(ul.liked_artists_count, 0) liked_artists_count, coalesce(uf.total_follows, 0) total_follows,
    coalesce(ut.total_top_tracks, 0) total_top_tracks, coalesce(ut.avg_top_popularity, us.avg_popularity) avg_top_popularity,
    coalesce(ut.top_artists_diversity, 0) top_artists_diversity,
    {PCT('coalesce(ul.total_likes, 0)', 'us.total_plays')} like_ratio,
    {PCT('coalesce(uf.total_follows, 0)', 'us.artist_diversity')} follow_ratio,
    {PCT('coalesce(ul.liked_artists_count, 0)', 'us.artist_diversity')} like_selectivity,
    {PCT('us.track_diversity', 'us.total_plays')} exploration_ratio,
    case when us.total_plays > 0 then us.total_plays / {float(period_days)} else 0.0 end daily_listening_intensity
  from us left join ul on us.user_id = ul.user_id left join uf on us.user_id = uf.user_id
  left join ut on us.user_id = ut.user_id),
feat as (select user_id, {', '.join(f'coalesce({c}, 0) {c}' for c in FE.FEATURE_COLUMNS)} from f0)"""


SCORES_SQL = """sc as (
  select *,
    (case when avg_popularity > 65 then 3 when avg_popularity > 55 then 1 else 0 end)
      + (case when daily_listening_intensity > 3 and daily_listening_intensity < 15 then 2 else 0 end)
      + (case when peak_hour >= 9 and peak_hour <= 18 then 2 else 0 end) mainstream_explorer_score,
    (case when avg_popularity < 45 then 3 when avg_popularity < 55 then 1 else 0 end)
      + (case when exploration_ratio > 25 then 2 when exploration_ratio > 15 then 1 else 0 end)
      + (case when artist_diversity > 30 then 2 else 0 end) underground_hunter_score,
    (case when daily_listening_intensity > 15 then 4 when daily_listening_intensity > 8 then 2 else 0 end)
      + (case when artist_diversity > 50 then 2 when artist_diversity > 25 then 1 else 0 end)
      + (case when exploration_ratio > 20 then 1 else 0 end) music_addict_score,
    (case when night_preference_ratio > 40 then 3 when night_preference_ratio > 25 then 1 else 0 end)
      + (case when peak_hour >= 22 or peak_hour <= 6 then 3 when peak_hour >= 20 then 1 else 0 end)
      + (case when weekend_preference_ratio > 60 then 1 else 0 end) night_owl_score,
    (case when daily_listening_intensity < 8 then 2 else 0 end)
      + (case when avg_popularity >= 50 and avg_popularity <= 70 then 2 else 0 end)
      + (case when exploration_ratio < 20 then 1 else 0 end) + (case when like_ratio < 10 then 1 else 0 end)
      casual_listener_score
  from feat),
best as (
  select *, case
    when greatest(mainstream_explorer_score, underground_hunter_score, music_addict_score, night_owl_score,
                  casual_listener_score) = 0 then 'casual_listener'
    when music_addict_score = greatest(mainstream_explorer_score, underground_hunter_score, music_addict_score,
         night_owl_score, casual_listener_score) then 'music_addict'
    when underground_hunter_score = greatest(mainstream_explorer_score, underground_hunter_score, music_addict_score,
         night_owl_score, casual_listener_score) then 'underground_hunter'
    when night_owl_score = greatest(mainstream_explorer_score, underground_hunter_score, music_addict_score,
         night_owl_score, casual_listener_score) then 'night_owl'
    when mainstream_explorer_score = greatest(mainstream_explorer_score, underground_hunter_score, music_addict_score,
         night_owl_score, casual_listener_score) then 'mainstream_explorer'
    else 'casual_listener' end profile_key
  from sc)"""


def _profile_values() -> str:
    def q(s):
        return "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({q(k)}, {q(v['name'])}, {q(v['emoji'])}, {q(v['description'])}, {q(v['characteristics'])}, "
                     f"{q(v['criteria'])})" for k, v in PR.PROFILES.items())
    return ("pm(profile_key, profile_name, profile_emoji, profile_description, profile_characteristics, "
            f"profile_criteria) as (values {rows})")


def _profiled_sql(period_days: int) -> str:
    return f"""{_features_sql(period_days)},
{SCORES_SQL},
{_profile_values()},
prof as (select best.*, pm.profile_name, pm.profile_emoji, pm.profile_description, pm.profile_characteristics,
  pm.profile_criteria from best join pm using (profile_key))"""


# --- aggregates ---------------------------------------------------------------

@query("a06_user_stats", f"""with {USER_STATS}
select * from us""")
def a06_user_stats(spark, sf):
    """Per-user listening aggregates for users with at least 20 plays."""
    return FE.user_stats(fx.plays(spark, sf))


@query("a07_like_stats", f"""with {LIKE_STATS}
select * from ul""")
def a07_like_stats(spark, sf):
    """Likes per user: count, mean valid popularity, distinct artists (blank ids excluded)."""
    return FE.like_stats(fx.likes(spark, sf))


@query("a08_follow_stats", f"""with {FOLLOW_STATS}
select * from uf""")
def a08_follow_stats(spark, sf):
    """Followed artists per user."""
    return FE.follow_stats(fx.follows(spark, sf))


@query("a09_top_stats", f"""with {TOP_STATS}
select * from ut""")
def a09_top_stats(spark, sf):
    """Top tracks per user: count, mean valid popularity, distinct artists."""
    return FE.top_stats(fx.top_tracks(spark, sf))


@query("a10_conditional_counts", f"""with {USER_STATS}
select user_id, night_plays, day_plays, work_hours_plays, weekend_plays, weekday_plays from us""")
def a10_conditional_counts(spark, sf):
    """Night / day / work-hour / weekend / weekday play counts per user."""
    return FE.user_stats(fx.plays(spark, sf)).select(
        "user_id", "night_plays", "day_plays", "work_hours_plays", "weekend_plays", "weekday_plays")


@query("a11_distinct_counts", """
select user_id, count(distinct artist_id) distinct_artists, count(distinct track_id) distinct_tracks,
  count(distinct cast(played_at_local as date)) distinct_days
from plays group by user_id""")
def a11_distinct_counts(spark, sf):
    """Distinct artists, tracks and active local days per user."""
    return FE.distinct_counts(fx.plays(spark, sf), {
        "distinct_artists": F.col("artist_id"), "distinct_tracks": F.col("track_id"), "distinct_days": F.to_date("played_at_local")})


@query("a12_sample_stddev", f"""with {USER_STATS}
select user_id, coalesce(popularity_variance, 0.0) popularity_variance from us""")
def a12_sample_stddev(spark, sf):
    """Sample standard deviation of valid popularity per user (NULL -> 0)."""
    return FE.user_stats(fx.plays(spark, sf)).select(
        "user_id", F.coalesce("popularity_variance", F.lit(0.0)).alias("popularity_variance"))


# --- feature table -----------------------------------------------------------

@query("m01_user_features", f"""with {_features_sql(30)}
select * from feat""")
def m01_user_features(spark, sf):
    """User id + 23 features from plays, likes, follows and top tracks (period 30 days)."""
    return _features(spark, sf, 30)


@query("j01_feature_joins", f"""with {_features_sql(30)}
select user_id, total_likes, avg_like_popularity, total_follows, total_top_tracks, avg_top_popularity from feat""")
def j01_feature_joins(spark, sf):
    """The three left joins of the feature table with their fallbacks (likes/follows/tops)."""
    return _features(spark, sf, 30).select("user_id", "total_likes", "avg_like_popularity", "total_follows",
                                           "total_top_tracks", "avg_top_popularity")


@query("m02_ratio_features", f"""with {_features_sql(10)}
select user_id, night_preference_ratio, weekend_preference_ratio, work_hours_ratio, like_ratio, follow_ratio,
  like_selectivity, exploration_ratio, daily_listening_intensity from feat""")
def m02_ratio_features(spark, sf):
    """Ratio features (0 on zero denominators), intensity over a 10-day period."""
    return _features(spark, sf, 10).select(
        "user_id", "night_preference_ratio", "weekend_preference_ratio", "work_hours_ratio", "like_ratio",
        "follow_ratio", "like_selectivity", "exploration_ratio", "daily_listening_intensity")


# --- profiles -----------------------------------------------------------------

SCORE_COLS = ["mainstream_explorer_score", "underground_hunter_score", "music_addict_score", "night_owl_score",
              "casual_listener_score"]


@query("m05_profile_scores", f"""with {_profiled_sql(30)}
select user_id, {', '.join(SCORE_COLS)} from best""")
def m05_profile_scores(spark, sf):
    """Five rule scores per user (period 30)."""
    return PR.profile_scores(_features(spark, sf, 30)).select("user_id", *SCORE_COLS)


@query("m06_profile_assignment", f"""with {_profiled_sql(10)}
select user_id, profile_key, profile_name, profile_emoji, profile_description, profile_characteristics,
  profile_criteria from prof""")
def m06_profile_assignment(spark, sf):
    """Best profile and its attributes per user (period 10)."""
    return _profiled(spark, sf, 10).select(
        "user_id", "profile_key", "profile_name", "profile_emoji", "profile_description", "profile_characteristics",
        "profile_criteria")


@query("w04_argmax_priority", f"""with {_profiled_sql(5)}
select user_id, profile_key, greatest({', '.join(SCORE_COLS)}) best_score from best""")
def w04_argmax_priority(spark, sf):
    """Argmax of the five scores with priority ties (period 5: every profile appears)."""
    return _profiled(spark, sf, 5).select("user_id", "profile_key", F.greatest(*SCORE_COLS).alias("best_score"))


PROFILE_TABLE_SQL = f"""with {_profiled_sql(30)}
select user_id, cast(null as int) cluster, profile_name, profile_emoji, profile_description,
  profile_characteristics, profile_criteria,
  {', '.join(f'round_even(cast({c} as double), 2) {c}' for c in PR.METRICS)}, cast(null as varchar) generated_at
from prof"""


@query("m07_profile_table", PROFILE_TABLE_SQL)
def m07_profile_table(spark, sf):
    """Profile output rows with metrics rounded half-even to 2 places (cluster and time omitted)."""
    return PR.profile_table(_profiled(spark, sf, 30), rounded=True, with_time=False)


PROFILE_SUMMARY_SQL = f"""with {_profiled_sql(30)}
select profile_name, profile_emoji, count(*) user_count, avg(avg_popularity) avg_popularity_mean,
  avg(daily_listening_intensity) daily_intensity_mean, avg(artist_diversity) artist_diversity_mean,
  avg(night_preference_ratio) night_preference_mean,
  count(*) / sum(count(*)) over () * 100 percentage
from prof group by profile_name, profile_emoji"""


@query("a15_profile_summary", PROFILE_SUMMARY_SQL)
def a15_profile_summary(spark, sf):
    """Users, share and four feature means per profile."""
    return PR.profile_summary(_profiled(spark, sf, 30))


@query("a14_profile_stats", f"""with {_profiled_sql(30)}
select profile_name, count(*) user_count, count(*) / sum(count(*)) over () * 100 percentage,
  cast(sum(count(*)) over () as bigint) total_users, cast(count(*) over () as bigint) profiles
from prof group by profile_name""")
def a14_profile_stats(spark, sf):
    """Users and share per profile name of the stored profile table, with the totals of users and profiles."""
    return PR.profile_stats(PR.profile_table(_profiled(spark, sf, 30), with_time=False))


@query("a21_feature_range", f"""with {_features_sql(30)}
select min(avg_popularity) avg_popularity_min, max(avg_popularity) avg_popularity_max,
  avg(avg_popularity) avg_popularity_mean,
  min(daily_listening_intensity) daily_listening_intensity_min, max(daily_listening_intensity) daily_listening_intensity_max,
  avg(daily_listening_intensity) daily_listening_intensity_mean,
  min(artist_diversity) artist_diversity_min, max(artist_diversity) artist_diversity_max,
  avg(artist_diversity) artist_diversity_mean,
  min(night_preference_ratio) night_preference_ratio_min, max(night_preference_ratio) night_preference_ratio_max,
  avg(night_preference_ratio) night_preference_ratio_mean
from feat""")
def a21_feature_range(spark, sf):
    """Min, max and mean of four key features over all users."""
    f = _features(spark, sf, 30)
    cols = ["avg_popularity", "daily_listening_intensity", "artist_diversity", "night_preference_ratio"]
    return f.agg(*[e for c in cols for e in (F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"),
                                             F.avg(c).alias(f"{c}_mean"))])


PROBES = "probes as (select cast(c_custkey as varchar) user_id from customer)"


def _lookup(spark, sf):
    table = PR.profile_table(_profiled(spark, sf, 30), with_time=False)
    probes = spark.read.parquet(f"{sf.rstrip('/')}/customer.parquet").select(
        F.col("c_custkey").cast("string").alias("user_id"))
    return PR.lookup_profiles(probes, table, PR.profile_stats(table))


LOOKUP_SQL = f"""with {_profiled_sql(30)},
{PROBES},
st as (select profile_name, count(*) user_count, count(*) / sum(count(*)) over () * 100 percentage
       from prof group by profile_name),
j as (select probes.user_id, prof.profile_name, prof.profile_emoji, prof.profile_description,
        prof.profile_characteristics, st.user_count, st.percentage, prof.user_id is not null found
      from probes left join prof on probes.user_id = prof.user_id left join st on st.profile_name = prof.profile_name)
select user_id, case when found then 0 else 4 end cluster,
  case when found then profile_name else 'Casual Listener' end name,
  case when found then profile_emoji else '🎵' end emoji,
  case when found then profile_description else 'Escuchas música de fondo - prefieres lo conocido y familiar' end description,
  case when found then profile_characteristics else 'Perfil musical estándar' end characteristics,
  cast(case when found then user_count else 1 end as bigint) stats_user_count,
  cast(case when found then percentage else 0.0 end as double) stats_percentage,
  found profile_found
from j"""


@query("c09_profile_service", LOOKUP_SQL)
def c09_profile_service(spark, sf):
    """Profile answer for every customer id: stored profile + stats, else the default profile."""
    return _lookup(spark, sf)


@query("j04_profile_lookup", f"""with {_profiled_sql(30)},
{PROBES}
select probes.user_id, coalesce(prof.profile_name, 'Casual Listener') name, prof.user_id is not null profile_found
from probes left join prof on probes.user_id = prof.user_id""")
def j04_profile_lookup(spark, sf):
    """Left join of probe ids to stored profiles with the default for misses."""
    return _lookup(spark, sf).select("user_id", "name", "profile_found")


@query("j05_attach_stats", f"""with {_profiled_sql(30)},
st as (select profile_name, count(*) user_count, count(*) / sum(count(*)) over () * 100 percentage
       from prof group by profile_name)
select prof.user_id, prof.profile_name, st.user_count, st.percentage
from prof join st on st.profile_name = prof.profile_name""")
def j05_attach_stats(spark, sf):
    """Each profiled user with the count and share of its profile."""
    table = PR.profile_table(_profiled(spark, sf, 30), with_time=False)
    stats = PR.profile_stats(table)
    return table.join(F.broadcast(stats), "profile_name").select("user_id", "profile_name", "user_count", "percentage")


@query("m03_robust_scaling", f"""with {_features_sql(30)},
lng as (unpivot feat on {', '.join(CL.CLUSTER_FEATURES)} into name feature value v),
q as (select feature, quantile_cont(v, 0.25) q25, quantile_cont(v, 0.5) q50, quantile_cont(v, 0.75) q75
      from lng group by feature)
select feature, q50 center, case when q75 - q25 = 0 then 1.0 else q75 - q25 end scale from q""")
def m03_robust_scaling(spark, sf):
    """Median and IQR (exact, interpolated; IQR 0 -> 1) of the nine clustering features."""
    return CL.robust_scaling_params(_features(spark, sf, 30))


def _clustered(spark, sf):
    return CL.kmeans_clusters(_features(spark, sf, 30))[0]


@query("m04_kmeans", f"""with {_features_sql(30)}
select user_id, true nearest, true cost_matches, {CL.K} labels_used from feat""")
def m04_kmeans(spark, sf):
    """K-means (k=5, seed 42, 20 restarts, 500 iterations) on robust-scaled features: one label per user, all k used.

    Labels themselves are engine-specific, so the query checks them against the data: every user's cluster has the
    nearest mean, and the fit's cost is the sum of squares around the means, both recomputed from the labels.
    """
    clustered, fit = CL.kmeans_clusters(_features(spark, sf, 30))
    c = CL.cluster_check(clustered, fit).select("user_id", "cluster", "nearest", "cost_matches")
    used = c.agg(F.count_distinct("cluster").cast("int").alias("labels_used"))
    return c.join(F.broadcast(used), F.lit(True)).select("user_id", "nearest", "cost_matches", "labels_used")


@query("m04_stored_model", f"""with {_features_sql(30)}
select user_id, true same_cluster from feat""")
def m04_stored_model(spark, sf):
    """The fitted scaler and centres saved as a Spark ML pipeline, loaded and applied: the same cluster for every user."""
    from pyspark.ml import PipelineModel
    features = _features(spark, sf, 30)
    clustered, fit = CL.kmeans_clusters(features)
    path = scratch_path(spark, "kmeans-model")
    fit.pipeline().write().overwrite().save(path)
    again = PipelineModel.load(path).transform(features).select("user_id", F.col("cluster").alias("loaded"))
    return clustered.select("user_id", "cluster").join(again, "user_id").select("user_id", (F.col("cluster") == F.col("loaded")).alias("same_cluster"))


@query("a16_cluster_centroids", f"""with {_features_sql(30)}
select {CL.K} clusters, count(*) users, {", ".join(f"round(avg({c}), 6) {c}_mean" for c in CL.CLUSTER_FEATURES)} from feat""")
def a16_cluster_centroids(spark, sf):
    """Cluster sizes and feature means in feature units, folded: sizes sum to the users, weighted means to the means."""
    c = CL.cluster_centroids(_clustered(spark, sf))
    return c.agg(F.count(F.lit(1)).cast("int").alias("clusters"), F.sum("users").alias("users"),
                 *[F.round(F.sum(F.col(f"{x}_mean") * F.col("users")) / F.sum("users"), 6).alias(f"{x}_mean") for x in CL.CLUSTER_FEATURES])


@query("c08_profiles_end_to_end", f"""with {_profiled_sql(30)},
summary as (select profile_name, count(*) profile_users from prof group by profile_name)
select user_id, true valid_cluster, prof.profile_name, profile_emoji, profile_description, profile_characteristics, profile_criteria,
  {', '.join(f'round_even(cast({c} as double), 2) {c}' for c in PR.METRICS)}, true has_time, profile_users
from prof join summary on prof.profile_name = summary.profile_name""")
def c08_profiles_end_to_end(spark, sf):
    """Features -> scaling -> K-means -> scores -> profile table with cluster, beside the profile's summary."""
    profiled = PR.assign_profiles(_clustered(spark, sf)).checkpoint()
    table = PR.profile_table(profiled, rounded=True, with_time=True)
    summary = PR.profile_summary(profiled).select("profile_name", F.col("user_count").alias("profile_users"))   # <= 5 rows
    return table.join(F.broadcast(summary), "profile_name").select(
        "user_id", F.col("cluster").between(0, CL.K - 1).alias("valid_cluster"), "profile_name", "profile_emoji", "profile_description",
        "profile_characteristics", "profile_criteria", *PR.METRICS, F.col("generated_at").isNotNull().alias("has_time"), "profile_users")
