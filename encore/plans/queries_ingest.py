"""Registered ingest queries that go through files: sinks, raw-document ETLs and the streams
(P02, S10, K03, C02-C04, Z01-Z03).

Raw inputs are derived from the driver tables (the fixture views), landed in the
collector's layout under the session's checkpoint folder, and read back by the
real readers; so the work grows with the tables and the oracle can check it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from encore.functions.output import instants_as_ntz
from encore.operators import etl
from encore.operators import genres as G
from encore.operators import profiles as PR
from encore.plans import jobs
from encore.plans.queries_catalog import CATALOG
from encore.plans.queries_clean import CLEAN_ROWS, DEDUP, DEDUP_CSV, SEASON
from encore.plans.queries_profiles import PROFILE_SUMMARY_SQL, PROFILE_TABLE_SQL
from encore.plans.registry import query
from encore.session import scratch_path
from encore.sources import fixtures as fx
from encore.sources import catalog, raw, sinks
from encore.sources.tables import read_table
from encore.streaming import ingest

OUT_COLS = ["user_id", "played_at_utc", "played_at_local", "track_id", "track_name", "artist_id", "artist_name",
            "album_id", "album_name", "duration_ms", "duration_minutes", "popularity", "explicit", "play_hour",
            "play_day_of_week", "play_month", "play_year", "season"]
C01_TEMPLATE = """with {dedup}
select user_id, played_at_utc, played_at_local, track_id, track_name, artist_id, artist_name, album_id, album_name,
  duration_ms, floor((duration_ms + 300) / 600) / 100 duration_minutes, popularity, explicit,
  cast(hour(played_at_local) as int) play_hour, cast(dayofweek(played_at_local) + 1 as int) play_day_of_week,
  cast(month(played_at_local) as int) play_month, cast(year(played_at_local) as int) play_year, {season} season
from dedup"""
C01_SQL = C01_TEMPLATE.format(dedup=DEDUP, season=SEASON)
C01_CSV_SQL = C01_TEMPLATE.format(dedup=DEDUP_CSV, season=SEASON)


@query("p02_domain_filters", """
select user_id, track_id, artists_id, track_popularity from likes
where user_id is not null and artists_id is not null and artists_id <> '' and track_popularity is not null""")
def p02_domain_filters(spark, sf):
    """Null / blank domain filters (user, artist id not blank, popularity present)."""
    lk = fx.likes(spark, sf)
    cond = (F.col("user_id").isNotNull() & F.col("artists_id").isNotNull() & (F.col("artists_id") != "")
            & F.col("track_popularity").isNotNull())
    return lk.filter(cond).select("user_id", "track_id", "artists_id", "track_popularity")


def _written_user_tracks(spark, sf):
    clean = etl.clean_plays(fx.raw_play_rows(spark, sf), with_time=False)
    path = sinks.write_per_user(clean, scratch_path(spark, "user_tracks"), ["played_at_utc"], new=True)
    return ingest.read_user_table(spark, path)


@query("s10_per_user_sink", C01_SQL)
def s10_per_user_sink(spark, sf):
    """Cleaned plays written as one folder per user (sorted, snappy) and read back."""
    return instants_as_ntz(_written_user_tracks(spark, sf).select(*OUT_COLS))


@query("k03_storage_ordering", f"""with {DEDUP}
select distinct user_id, cast(0 as bigint) out_of_order from dedup""")
def k03_storage_ordering(spark, sf):
    """Rows inside every written file follow played_at_utc (checked by file row index): 0 per user.

    The window is per file, and files are bounded by ``maxRecordsPerFile``.
    """
    t = _written_user_tracks(spark, sf).select(
        "user_id", "played_at_utc", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
    prev = F.lag("played_at_utc").over(Window.partitionBy("f").orderBy("i"))
    bad = F.coalesce((prev > F.col("played_at_utc")) | (prev.isNotNull() & F.col("played_at_utc").isNull()),
                     F.lit(False))
    return t.select("user_id", bad.alias("bad")).groupBy("user_id").agg(F.count_if("bad").alias("out_of_order"))


# --- raw documents from the driver tables --------------------------------------------

def raw_likes_rows(spark, sf):
    """Likes in the raw document shape: id arrays, ISO text time without millis."""
    lk = fx.likes(spark, sf)
    return lk.select(
        "user_id", "track_id", F.lit(None).cast("string").alias("album_id"),
        F.when(F.col("artists_id") == "", F.array().cast("array<string>"))
        .otherwise(F.array("artists_id")).alias("artists_id"),
        "explicit", F.col("duration_ms").cast("int").alias("duration_ms"),
        F.lit(None).cast("string").alias("track_name"), "track_popularity",
        F.date_format("added_at_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("added_at"))


C02_SQL = """
with r as (
  select user_id, track_id, cast(null as varchar) album_id,
    case when artists_id = '' then [] else [artists_id] end artists_id, explicit, duration_ms,
    cast(null as varchar) track_name, track_popularity, strftime(added_at_utc, '%Y-%m-%dT%H:%M:%SZ') added_at
  from likes),
c as (
  select user_id, track_id, coalesce(album_id, '-1') album_id, coalesce(explicit, false) explicit,
    coalesce(duration_ms, 0) duration_ms, coalesce(trim(track_name), 'Unknown Track') track_name,
    coalesce(track_popularity, 0) track_popularity, strptime(added_at, '%Y-%m-%dT%H:%M:%SZ') added_at_utc,
    case when artists_id is not null and len(artists_id) > 0 then artists_id[1] else '-1' end artists_id
  from r),
d as (select *, added_at_utc - interval 6 hour added_at_local, row_number() over (
        partition by user_id, track_id, added_at_utc order by album_id asc nulls last, explicit asc nulls last,
        duration_ms asc nulls last, track_name asc nulls last, track_popularity asc nulls last,
        artists_id asc nulls last) rn from c)
select user_id, added_at_utc, added_at_local, track_id, track_name, artists_id, album_id, track_popularity,
  explicit, duration_ms from d where rn = 1"""


@query("c02_likes_etl", C02_SQL)
def c02_likes_etl(spark, sf):
    """Raw like documents of all users -> likes (first artist, defaults, dedup, local time)."""
    out = etl.clean_likes(raw_likes_rows(spark, sf), with_time=False).drop("processed_at")
    return instants_as_ntz(out)


C03_SQL = "select distinct user_id, artist_id from follows_raw"


@query("c03_follows_etl", C03_SQL)
def c03_follows_etl(spark, sf):
    """Exploded follow documents -> followed_artists (dedup on user and artist)."""
    return etl.clean_follows(fx.follows_raw(spark, sf), with_time=False).drop("processed_at")


C04_SQL = """
select user_id, ith_preference, track_id, 'Unknown Track' track_name, artists_id, '-1' album_id,
  track_popularity, false explicit, cast(track_popularity * 1000 as bigint) duration_ms
from top_tracks"""


def raw_top_rows(spark, sf):
    """Ranked tracks in the raw document shape, the duration under the writer's ``duration`` key."""
    return fx.top_tracks(spark, sf).select(
        "user_id", "ith_preference", "track_id", F.lit(None).cast("string").alias("album_id"), F.array("artists_id").alias("artists_id"),
        F.lit(None).cast("boolean").alias("explicit"), F.lit(None).cast("int").alias("duration_ms"),
        (F.col("track_popularity") * 1000).cast("int").alias("duration"), F.lit(None).cast("string").alias("track_name"), "track_popularity")


@query("c04_top_tracks_etl", C04_SQL)
def c04_top_tracks_etl(spark, sf):
    """Raw ranked documents (duration under the writer's ``duration`` key) -> top_tracks."""
    return etl.clean_top_tracks(raw_top_rows(spark, sf), with_time=False).drop("processed_at")


# --- streams over landed CSV files -------------------------------------------------------

def _landed(spark, sf, grouped: bool = False):
    return raw.stage_plays_csv(fx.raw_play_rows(spark, sf), scratch_path(spark, "raw_plays_csv"), grouped=grouped)


def _streamed(spark, sf) -> str:
    """Two runs: the files of the later half of the month, then the late files of the earlier half."""
    rows = fx.raw_play_rows(spark, sf)
    late = F.coalesce(F.col("played_at") < "2024-01-16", F.lit(False))
    root = scratch_path(spark, "raw_plays_csv")
    table, ckpt = scratch_path(spark, "user_tracks_stream"), scratch_path(spark, "ingest_ckpt")
    for part in (rows.filter(~late), rows.filter(late)):
        raw.stage_plays_csv(part, root, mode="append", grouped=True)
        ingest.ingest_available(spark, root, table, ckpt, grouped=True)
    return table


@query("z02_stream_batch_equivalence", C01_CSV_SQL)
def z02_stream_batch_equivalence(spark, sf):
    """Incremental ingest (availableNow + per-batch merge) over landed CSVs; equals the batch ETL.

    Landing in CSV turns an empty name into an empty field, which reads back as
    NULL (then 'Unknown Artist'), exactly as the batch job reading the same files.
    """
    return instants_as_ntz(ingest.read_plays(spark, _streamed(spark, sf)).select(*OUT_COLS))


@query("z01_incremental_ingest", f"""with {CLEAN_ROWS}
select distinct user_id, track_id, played_at_utc from clean_rows""")
def z01_incremental_ingest(spark, sf):
    """Keys in the table after two runs over new files, the second with older plays: none is lost, none is double."""
    return instants_as_ntz(ingest.read_plays(spark, _streamed(spark, sf)).select("user_id", "track_id", "played_at_utc"))


@query("z03_hourly_stream", f"""with {CLEAN_ROWS},
k as (select distinct user_id, track_id, played_at_utc from clean_rows where played_at_utc is not null),
w as (select user_id, time_bucket(interval 1 hour, played_at_utc) hour_start_utc, count(*) plays from k group by all)
select user_id, hour_start_utc, hour_start_utc - interval 6 hour hour_start_local,
  cast(hour(hour_start_utc - interval 6 hour) as int) play_hour, plays from w""")
def z03_hourly_stream(spark, sf):
    """Plays per user and hour kept by the stream, late plays included, all hours."""
    return instants_as_ntz(ingest.read_hourly(spark, _streamed(spark, sf)))


# --- sources over landed files, catalog, profile sinks ------------------------------------

RAW_CSV = """landed as (
  select user_id, played_at, cast(null as varchar) track_name, nullif(artist_name, '') artist_name,
    cast(null as varchar) album_name, track_id, artist_id, cast(null as varchar) album_id, cast(null as int) duration_ms,
    cast(null as int) popularity, cast(null as boolean) explicit
  from raw_plays)"""


@query("s01_plays_csv_scan", f"""with {RAW_CSV}
select * from landed""")
def s01_plays_csv_scan(spark, sf):
    """Declared-schema CSV scan of every user's folder (header, no inference, '' reads as NULL)."""
    r = raw.read_plays_csv(spark, _landed(spark, sf))
    return r.drop("source_file")


@query("s06_user_discovery", "select distinct user_id from raw_plays")
def s06_user_discovery(spark, sf):
    """Users found from a listing of the input folders; no file is opened."""
    return raw.list_files(spark, _landed(spark, sf), "*.csv").select("user_id").distinct()


@query("s08_input_presence", """
select cast(c_custkey as varchar) user_id, cast(c_custkey as varchar) in (select user_id from raw_plays) has_input
from customer""")
def s08_input_presence(spark, sf):
    """Requested users (every customer id) against users with input files."""
    requested = read_table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("user_id"))
    return raw.user_presence(raw.list_files(spark, _landed(spark, sf), "*.csv"), requested)


@query("s09_per_file_counts", "select user_id, count(*) records from raw_plays group by user_id")
def s09_per_file_counts(spark, sf):
    """Rows per source file, rolled up per user (file names are the writer's)."""
    per_file = raw.per_file_counts(raw.read_plays_csv(spark, _landed(spark, sf)))
    return per_file.groupBy("user_id").agg(F.sum("records").alias("records"))


def _job_input(spark, sf, name: str) -> tuple[str, dict]:
    """The raw documents of one kind, landed: root and read options."""
    if name == "user_tracks":
        return _landed(spark, sf, grouped=True), {"grouped": True}
    if name == "followed_artists":
        rows = (_pages(fx.follows_raw(spark, sf), ["artist_id"], FOLLOW_DOC_SIZE).groupBy("user_id", "_chunk", "_page")
                .agg(F.collect_list("artist_id").alias("artists_ids")).drop("_chunk", "_page"))
    else:
        rows = raw_likes_rows(spark, sf) if name == "likes" else raw_top_rows(spark, sf)
    return raw.land_grouped(rows, scratch_path(spark, f"raw_{name}"), "json"), {"multi_line": False, "routed": False, "grouped": True}


def _job(spark, sf, name: str) -> jobs.JobResult:
    root, options = _job_input(spark, sf, name)
    return jobs.run_job(spark, name, root, scratch_path(spark, "processed"), with_time=False, new=True, **options)


def _job_table(spark, sf, name: str):
    return instants_as_ntz(_job(spark, sf, name).table.drop("processed_at"))


@query("c01_plays_job", C01_CSV_SQL)
def c01_plays_job(spark, sf):
    """Plays from the raw CSV files to the written per-user table, read back."""
    return instants_as_ntz(_job(spark, sf, "user_tracks").table.select(*OUT_COLS))


@query("c02_likes_job", C02_SQL)
def c02_likes_job(spark, sf):
    """Likes from the raw documents to the written per-user table, read back."""
    return _job_table(spark, sf, "likes")


@query("c03_follows_job", C03_SQL)
def c03_follows_job(spark, sf):
    """Followed artists from the raw documents to the written per-user table, read back."""
    return _job_table(spark, sf, "followed_artists")


@query("c04_top_tracks_job", C04_SQL)
def c04_top_tracks_job(spark, sf):
    """Top tracks from the raw documents to the written per-user table, read back."""
    return _job_table(spark, sf, "top_tracks")


@query("a17_quality_all_tables", f"""with {DEDUP_CSV},
lk as (select user_id, count(*) raw_records, date_trunc('second', min(added_at_utc)) lo, date_trunc('second', max(added_at_utc)) hi,
         count(distinct (track_id, date_trunc('second', added_at_utc))) clean from likes group by user_id),
fo as (select user_id, count(*) raw_records, count(distinct artist_id) clean from follows_raw group by user_id),
tt as (select user_id, count(*) raw_records from top_tracks group by user_id),
r as (select user_id, count(*) raw_records, count(*) filter (where track_id is null) null_track_ids,
        count(*) filter (where played_at is not null and track_id is not null and artist_id is not null) valid_records,
        count(*) filter (where played_at = 'bad' and track_id is not null and artist_id is not null) unparsed_times
      from raw_rows group by user_id),
c as (select user_id, count(*) clean_records, min(played_at_utc) min_utc, max(played_at_utc) max_utc, min(played_at_local) min_local,
        max(played_at_local) max_local from dedup group by user_id)
select 'user_tracks' table_name, r.user_id, raw_records, null_track_ids, valid_records, unparsed_times, coalesce(clean_records, 0) clean_records,
  valid_records - coalesce(clean_records, 0) duplicates_removed, min_utc, max_utc, min_local, max_local from r left join c using (user_id)
union all select 'likes', user_id, raw_records, 0, raw_records, 0, clean, raw_records - clean, lo, hi, lo - interval 6 hour, hi - interval 6 hour from lk
union all select 'followed_artists', user_id, raw_records, 0, raw_records, 0, clean, raw_records - clean, null, null, null, null from fo
union all select 'top_tracks', user_id, raw_records, 0, raw_records, 0, raw_records, 0, null, null, null, null from tt""")
def a17_quality_all_tables(spark, sf):
    """The quality reports of all four jobs, per table and user (the number of source files is the writer's)."""
    reports = [_job(spark, sf, name).quality.drop("source_files") for name in jobs.JOBS]
    return instants_as_ntz(reduce(lambda a, b: a.unionByName(b), reports))


@query("a26_job_summary", f"""with {DEDUP_CSV},
q as (select cast(c_custkey as varchar) user_id from customer),
r as (select user_id, count(*) n from raw_rows group by user_id),
c as (select user_id, count(*) n from dedup group by user_id)
select count(*) users, count(*) filter (where coalesce(c.n, 0) > 0) processed,
  count(*) filter (where r.n is not null and coalesce(c.n, 0) = 0) failed, count(*) filter (where r.n is null) skipped,
  cast(coalesce(sum(c.n), 0) as bigint) clean_records, cast(coalesce(sum(r.n), 0) as bigint) file_records
from q left join r on q.user_id = r.user_id left join c on q.user_id = c.user_id""")
def a26_job_summary(spark, sf):
    """Outcome of the plays job for every customer id: processed, failed, skipped, rows (the number of files is the writer's)."""
    requested = read_table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("user_id"))
    root, options = _job_input(spark, sf, "user_tracks")
    res = jobs.run_job(spark, "user_tracks", root, scratch_path(spark, "processed"), requested, with_time=False, new=True, **options)
    return jobs.outcome_summary(res.outcome).drop("files")


#: Stand-in for damaged input: plays of these tracks come with text as duration, likes of them with text as popularity.
BAD_TRACK = "right(track_id, 1) = '3'"
GOOD = f"track_id is null or not ({BAD_TRACK})"
REJECTED_CSV = DEDUP_CSV.replace("from raw_plays)", f"from raw_plays where {GOOD})", 1)
assert REJECTED_CSV != DEDUP_CSV


@query("a26_rejected_records", f"""with {REJECTED_CSV},
f as (select 'user_tracks' table_name, user_id, count(*) filter (where {GOOD}) file_records, count(*) filter (where {BAD_TRACK}) rejected_records
      from raw_plays group by user_id
      union all select 'likes', user_id, count(*) filter (where {GOOD}), count(*) filter (where {BAD_TRACK}) from likes group by user_id),
c as (select 'user_tracks' table_name, user_id, count(*) n from dedup group by user_id
      union all select 'likes', user_id, count(distinct (track_id, date_trunc('second', added_at_utc))) from likes where {GOOD} group by user_id)
select table_name, f.user_id, case when coalesce(n, 0) > 0 then 'processed' else 'failed' end status, coalesce(n, 0) clean_records, file_records,
  rejected_records from f left join c using (table_name, user_id)""")
def a26_rejected_records(spark, sf):
    """Plays and likes jobs over input with records that do not fit the schema: rows kept, records in quarantine, status per user."""
    text = lambda df, c: df.withColumn(c, F.lit("n/a"))
    plays, likes, of = fx.raw_play_rows(spark, sf), raw_likes_rows(spark, sf), {}
    of["user_tracks"] = raw.stage_plays_csv(plays.where(GOOD), scratch_path(spark, "raw_plays_damaged"), grouped=True), {"grouped": True}
    raw.stage_plays_csv(text(plays.where(BAD_TRACK), "duration_ms"), of["user_tracks"][0], mode="append", grouped=True)
    of["likes"] = scratch_path(spark, "raw_likes_damaged"), {"multi_line": False, "routed": False, "grouped": True}
    for rows in (likes.where(GOOD), text(likes.where(BAD_TRACK), "track_popularity")):
        raw.land_grouped(rows, of["likes"][0], "json", mode="append")
    runs = {name: jobs.run_job(spark, name, root, scratch_path(spark, "processed"), with_time=False, new=True,
                               quarantine=scratch_path(spark, "quarantine"), **options) for name, (root, options) in of.items()}
    return reduce(lambda a, b: a.unionByName(b), [run.outcome.drop("files").withColumn("table_name", F.lit(name)) for name, run in runs.items()])


@query("a26_catalog_run", f"""with {CATALOG}
select case when count(*) > 0 then 'processed' else 'failed' end status, (select count(*) from artists_raw) original_records, count(*) processed_records,
  (select count(*) from artists_raw) - count(*) dropped_records,
  (select count(*) from (select distinct popularity_range, primary_genre from cat) d) partitions, true timed from cat""")
def a26_catalog_run(spark, sf):
    """The report of a catalog run over landed artist documents: records in, kept, dropped, partitions (files are the writer's)."""
    root = scratch_path(spark, "artists_json")
    fx.artists_raw(spark, sf).write.mode("overwrite").json(root)
    run = jobs.run_catalog_job(spark, root, scratch_path(spark, "artists_catalog"), multi_line=False)
    return run.report.select("status", "original_records", "processed_records", "dropped_records", "partitions", (F.col("duration_seconds") > 0).alias("timed"))


@query("s13_catalog_build", f"""with {CATALOG},
p as (
  select 'artists_catalog' table_name, count(*) partitions from (select distinct popularity_range, primary_genre from cat) d
  union all select 'user_tracks', count(distinct user_id) from raw_plays where played_at is not null and track_id is not null and artist_id is not null
  union all select 'likes', count(distinct user_id) from likes
  union all select 'followed_artists', count(distinct user_id) from follows_raw
  union all select 'top_tracks', count(distinct user_id) from top_tracks)
select table_name, true created, true "exists", true columns_match, true properties_match, true partitioned, partitions from p""")
def s13_catalog_build(spark, sf):
    """Create the database and its five external tables over what the jobs wrote, repair partitions, verify (S13 + S14)."""
    at = {name: _job(spark, sf, name).path for name in jobs.JOBS}
    at["artists_catalog"] = sinks.write_catalog(G.artist_catalog(sinks.spread(fx.artists_raw(spark, sf))))
    db = "encore_s13_" + at["artists_catalog"].rsplit("-", 1)[-1]
    try:
        return catalog.build_catalog(spark, db, at, replace=True)
    finally:
        catalog.drop_database(spark, db)


@query("s14_catalog_verify", f"""with {CATALOG}
select popularity_range, primary_genre, count(*) artists from cat group by popularity_range, primary_genre""")
def s14_catalog_verify(spark, sf):
    """Query the registered table through the catalog: rows per registered partition."""
    path = sinks.write_catalog(G.artist_catalog(fx.artists_raw(spark, sf)))
    db = "encore_s14_" + path.rsplit("-", 1)[-1]
    catalog.build_catalog(spark, db, {"artists_catalog": path}, replace=True)
    try:
        return (spark.table(f"{db}.artists_catalog").groupBy("popularity_range", "primary_genre")
                .agg(F.count(F.lit(1)).alias("artists")).checkpoint())
    finally:
        catalog.drop_database(spark, db)


def _profile_table(spark, sf):
    from encore.plans.queries_profiles import _profiled
    return PR.profile_table(_profiled(spark, sf, 30), rounded=True, with_time=False)


@query("s16_profile_csv_sink", PROFILE_TABLE_SQL)
def s16_profile_csv_sink(spark, sf):
    """Profile table written as header CSV (no index column) and read back with its schema."""
    path = sinks.write_csv(_profile_table(spark, sf), scratch_path(spark, "profiles_csv"))
    return raw.read_profiles(spark, path, fmt="csv")


@query("s16_cluster_stats_csv", PROFILE_SUMMARY_SQL)
def s16_cluster_stats_csv(spark, sf):
    """The profile statistics written beside the profile CSV, read back."""
    from encore.plans.queries_profiles import _profiled
    profiled = _profiled(spark, sf, 30)
    _, path = sinks.write_profiles(PR.profile_table(profiled, rounded=True, with_time=False), PR.profile_summary(profiled),
                                   scratch_path(spark, "profiles_csv"))
    return spark.read.schema("profile_name string, profile_emoji string, user_count bigint, avg_popularity_mean double, "
                             "daily_intensity_mean double, artist_diversity_mean double, night_preference_mean double, "
                             "percentage double").option("header", True).csv(path)


@query("s17_profile_scan", PROFILE_TABLE_SQL)
def s17_profile_scan(spark, sf):
    """Stored profile table read back (an absent path gives an empty table with the schema)."""
    path = scratch_path(spark, "profiles")
    _profile_table(spark, sf).write.mode("overwrite").parquet(path)
    return raw.read_profiles(spark, path)


# --- API pages built from the driver tables, landed as JSON lines, flattened (S19-S21, S23) -------

PAGE_SIZE = 50          # items per page, the API's page limit
TOP_PAGE_SIZE = 20


def _track(track_id, name, duration_ms, popularity, explicit, artists) -> F.Column:
    no_album = F.struct(F.lit(None).cast("string").alias("id"), F.lit(None).cast("string").alias("name"))
    return F.struct(track_id.alias("id"), name.alias("name"), duration_ms.cast("int").alias("duration_ms"),
                    popularity.cast("int").alias("popularity"), explicit.alias("explicit"),
                    artists.alias("artists"), no_album.alias("album"))


def _pages(df, order_cols: list[str], size: int):
    """``df`` with the page of every row: rows of a user in order, ``size`` to a page, none larger.

    A user's rows are first spread over hash chunks of about 64 pages; rows are numbered inside a chunk, so no sort
    runs over a whole hot user, and equal keys fill pages like any others.
    """
    counts = df.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    spread = df.join(counts, "user_id").withColumn("_row", F.monotonically_increasing_id()).checkpoint()   # ids are drawn once
    chunks = F.ceil(F.col("_n") / F.lit(64.0 * size))
    spread = spread.withColumn("_chunk", F.pmod(F.xxhash64("_row"), chunks))
    w = Window.partitionBy("user_id", "_chunk").orderBy(*order_cols, "_row")
    return spread.withColumn("_page", F.floor((F.row_number().over(w) - 1) / size)).drop("_n", "_row")


@query("s19_flatten_play_items", """
select user_id, strftime(played_at_utc, '%Y-%m-%dT%H:%M:%S.') || strftime(played_at_utc, '%g') || 'Z' played_at,
  'Track ' || track_id track_name, artist_name, cast(null as varchar) album_name, track_id, artist_id,
  cast(null as varchar) album_id, cast(duration_ms as int) duration_ms, popularity, explicit
from plays""")
def s19_flatten_play_items(spark, sf):
    """Recently-played pages (<= 50 items, two artists per track) landed as JSON, read back and flattened."""
    p = fx.plays(spark, sf)
    artists = F.array(F.struct(F.col("artist_id").alias("id"), F.col("artist_name").alias("name")),
                      F.struct(F.concat(F.lit("X"), "artist_id").alias("id"), F.lit("featured").alias("name")))
    item = F.struct(F.date_format("played_at_utc", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("played_at"),
                    _track(F.col("track_id"), F.concat(F.lit("Track "), "track_id"), F.col("duration_ms"),
                           F.col("popularity"), F.col("explicit"), artists).alias("track"))
    pages = (p.groupBy("user_id", F.floor(F.col("event_id") / PAGE_SIZE).alias("_page"))
             .agg(F.collect_list(item).alias("items")).drop("_page"))
    root = raw.stage_pages(pages, scratch_path(spark, "play_pages"), grouped=True)
    return raw.flatten_play_items(raw.read_pages(spark, root, raw.PLAYS_PAGE_DDL, "*.json", multi_line=False, grouped=True))


@query("s20_flatten_like_items", """
select user_id, track_id, cast(null as varchar) album_id,
  case when artists_id = '' then cast([] as varchar[]) else [artists_id] end artists_id, explicit,
  cast(duration_ms as int) duration_ms, cast(null as varchar) track_name, track_popularity,
  strftime(added_at_utc, '%Y-%m-%dT%H:%M:%SZ') added_at
from likes""")
def s20_flatten_like_items(spark, sf):
    """Saved-track pages landed as JSON, read back and flattened to like documents (all artist ids)."""
    lk = fx.likes(spark, sf)
    artists = (F.when(F.col("artists_id") == "", F.array().cast(f"array<{raw.ARTIST}>"))
               .otherwise(F.array(F.struct(F.col("artists_id").alias("id"), F.lit(None).cast("string").alias("name")))))
    item = F.struct(F.date_format("added_at_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("added_at"),
                    _track(F.col("track_id"), F.lit(None).cast("string"), F.col("duration_ms"),
                           F.col("track_popularity"), F.col("explicit"), artists).alias("track"))
    pages = (_pages(lk, ["track_id", "added_at_utc"], PAGE_SIZE).groupBy("user_id", "_chunk", "_page")
             .agg(F.collect_list(item).alias("items")).drop("_chunk", "_page"))
    root = raw.stage_pages(pages, scratch_path(spark, "like_pages"), grouped=True)
    return raw.flatten_like_items(raw.read_pages(spark, root, raw.LIKES_PAGE_DDL, "*.json", multi_line=False, grouped=True))


@query("s21_top_item_pages", """
select user_id, ith_preference, track_id, cast(null as varchar) album_id, [artists_id] artists_id,
  cast(null as boolean) explicit, cast(track_popularity * 1000 as int) duration, cast(null as varchar) track_name,
  track_popularity
from top_tracks""")
def s21_top_item_pages(spark, sf):
    """S21 + S23: ranked top-track pages (20 items each, with the API's offset) landed as JSON lines,
    concatenated in page order and ranked by position: the ranks come back as stored."""
    return raw.flatten_top_items(_top_pages(spark, sf), F.col("offset"))


def _top_pages(spark, sf):
    t = fx.top_tracks(spark, sf)
    artists = F.array(F.struct(F.col("artists_id").alias("id"), F.lit(None).cast("string").alias("name")))
    track = _track(F.col("track_id"), F.lit(None).cast("string"), F.col("track_popularity") * 1000,
                   F.col("track_popularity"), F.lit(None).cast("boolean"), artists)
    page_no = F.floor((F.col("ith_preference") - 1) / TOP_PAGE_SIZE)
    pages = (t.groupBy("user_id", page_no.alias("_page"))
             .agg(F.array_sort(F.collect_list(F.struct(F.col("ith_preference").alias("pos"), track.alias("t"))))
                  .alias("_items"))
             .select("user_id", (F.col("_page") * TOP_PAGE_SIZE).cast("int").alias("offset"),
                     F.transform("_items", lambda x: x["t"]).alias("items")))
    root = raw.stage_pages(pages, scratch_path(spark, "top_pages"), grouped=True)
    return raw.read_pages(spark, root, raw.TOP_PAGE_DDL, "*.json", multi_line=False, grouped=True)


@query("s23_page_concatenation", f"""
select user_id, cast(ceil(count(*) / {TOP_PAGE_SIZE}.0) as bigint) pages, count(*) items,
  string_agg(track_id, ',' order by ith_preference) track_ids from top_tracks group by user_id""")
def s23_page_concatenation(spark, sf):
    """The pages of every user put together in page order: how many, and the tracks (at most 50) in their order."""
    pages = _top_pages(spark, sf)
    tracks = raw.flatten_top_items(pages, F.col("offset")).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("items"), F.array_sort(F.collect_list(F.struct("ith_preference", "track_id"))).alias("t"))
    n = pages.groupBy("user_id").agg(F.count(F.lit(1)).alias("pages"))
    return n.join(tracks, "user_id").select("user_id", "pages", "items", F.array_join(F.transform("t", lambda x: x["track_id"]), ",").alias("track_ids"))


@query("s05_artists_json_scan", "select id, name, popularity, followers, genres from artists_raw")
def s05_artists_json_scan(spark, sf):
    """Artist catalog documents landed as JSON lines (null fields omitted, as the writer does) and read
    back with the declared schema: padded names, NULL popularity and NULL / empty genre lists survive."""
    root = scratch_path(spark, "artists_json")
    fx.artists_raw(spark, sf).write.mode("overwrite").json(root)
    return raw.read_artists_json(spark, root, multi_line=False)


# --- raw documents landed per kind as JSON lines and read back by the document readers (S02-S04) ----

FOLLOW_DOC_SIZE = 1000   # ids per followed-artists document; larger users get several documents


@query("s02_likes_json_scan", """
select user_id, track_id, cast(null as varchar) album_id,
  case when artists_id = '' then cast([] as varchar[]) else [artists_id] end artists_id, explicit,
  cast(duration_ms as int) duration_ms, cast(null as varchar) track_name, track_popularity,
  strftime(added_at_utc, '%Y-%m-%dT%H:%M:%SZ') added_at
from likes""")
def s02_likes_json_scan(spark, sf):
    """Like documents of every user landed as JSON lines (one folder per user) and read with the declared schema."""
    root = scratch_path(spark, "likes_json")
    raw.land_per_user(raw_likes_rows(spark, sf), root, "json")
    return raw.read_likes_json(spark, root, multi_line=False, routed=False).drop("source_file")


@query("s03_followed_json_scan", "select user_id, artist_id from follows_raw")
def s03_followed_json_scan(spark, sf):
    """Followed-artist documents ({"artists_ids": [...]}, at most 1000 ids each) landed and exploded back."""
    docs = (_pages(fx.follows_raw(spark, sf), ["artist_id"], FOLLOW_DOC_SIZE)
            .groupBy("user_id", "_chunk", "_page").agg(F.collect_list("artist_id").alias("artists_ids")).drop("_chunk", "_page"))
    root = scratch_path(spark, "followed_json")
    raw.land_per_user(docs, root, "json")
    return raw.read_followed_json(spark, root, multi_line=False, routed=False).select("user_id", "artist_id")


@query("s04_top_tracks_json_scan", """
select user_id, ith_preference, track_id, cast(null as varchar) album_id, [artists_id] artists_id,
  cast(null as boolean) explicit, cast(null as int) duration_ms, cast(track_popularity * 1000 as int) duration,
  cast(null as varchar) track_name, track_popularity
from top_tracks""")
def s04_top_tracks_json_scan(spark, sf):
    """Ranked top-track documents (duration under the writer's ``duration`` key, T9) landed and read back."""
    t = fx.top_tracks(spark, sf)
    docs = t.select("user_id", "ith_preference", "track_id", F.array("artists_id").alias("artists_id"),
                    (F.col("track_popularity") * 1000).cast("int").alias("duration"), "track_popularity")
    root = scratch_path(spark, "top_tracks_json")
    raw.land_per_user(docs, root, "json")
    return raw.read_top_tracks_json(spark, root, multi_line=False, routed=False).drop("source_file")


# Fixed values of this check: file-name prefixes the collector writes, plus an
# ambiguous one ('top_likes_') where the first matching pattern must win.
ROUTING_PREFIXES = ["likes_list_", "followed_artists_", "top_tracks_", "recently_played_", "top_likes_"]


@query("s07_file_kind_routing", """
with m as (
  select source user_id,
    case doc_id % 5 when 0 then 'likes_list_' when 1 then 'followed_artists_' when 2 then 'top_tracks_'
      when 3 then 'recently_played_' else 'top_likes_' end || cast(doc_id as varchar) ||
    case when lang = 'en' then '.csv' else '.json' end file_name
  from documents)
select user_id, file_name,
  case when contains(file_name, 'likes') and suffix(file_name, '.json') then 'likes'
       when contains(file_name, 'followed') and suffix(file_name, '.json') then 'followed'
       when contains(file_name, 'top_') and suffix(file_name, '.json') then 'top_tracks' end kind
from m""")
def s07_file_kind_routing(spark, sf):
    """Document kind of every file in a listing derived from the documents table (first match wins, JSON only)."""
    d = read_table(spark, sf, "documents").select("doc_id", "source", "lang")
    prefix = F.element_at(F.array(*[F.lit(p) for p in ROUTING_PREFIXES]), (F.col("doc_id") % 5 + 1).cast("int"))
    ext = F.when(F.col("lang") == "en", F.lit(".csv")).otherwise(F.lit(".json"))
    files = d.select(F.col("source").alias("user_id"),
                     F.concat(prefix, F.col("doc_id").cast("string"), ext).alias("file_name"))
    return files.select("user_id", "file_name", raw.file_kind(F.col("file_name")).alias("kind"))
