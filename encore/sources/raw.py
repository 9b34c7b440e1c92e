"""Raw file sources.

Layout: ``<root>/<user_id>/<file>``. Every reader scans ALL users in one
multi-path read with a declared schema (no inference pass) and takes
``user_id`` from the file path (S06), so there is no driver loop over users.
Options that keep one bad file or row from failing the job: PERMISSIVE mode,
``ignoreMissingFiles``, ``try_*`` parsing downstream.

``multiLine`` JSON (one document per file) is not splittable: each file is one
task. That is fine for per-user documents; large catalogs should come as JSON
lines (``multi_line=False``).

A folder per user costs a folder, a file and its commit per user, whatever their size. Where many users land at once,
``land_grouped`` puts the files of all users into one folder and every record names its user; the readers take such
files with ``grouped=True``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from encore.sources import sinks
from encore.sources.schemas import (RAW_ARTISTS_DDL, RAW_FOLLOWED_DDL, RAW_LIKES_DDL, RAW_PLAYS_DDL,
                                    RAW_TOP_TRACKS_DDL)

ALL_USERS = "ALL"
#: The folder of grouped files.
GROUPED = "all_users"
#: What a folder per user calls rows without a user (Spark's name for the partition).
NO_USER = "__HIVE_DEFAULT_PARTITION__"

# File naming used by the collector.
KIND_PATTERNS = [("likes", "likes"), ("followed", "followed"), ("top_tracks", "top_")]   # ordered: first match wins


def user_from_path() -> Column:
    """The parent folder name of each input file (``<user>`` or Hive-style ``user_id=<user>``)."""
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+$", 1)
    return F.regexp_replace(folder, r"^user_id=", "")


def _scope(df: DataFrame, user_id: str | None) -> DataFrame:
    if user_id is None or user_id == ALL_USERS:
        return df
    return df.filter(F.col("user_id") == F.lit(str(user_id)))


def _base(spark: SparkSession, ddl: str, corrupt: str | None = None):
    """``corrupt`` names a column that gets the text of a record that does not fit the schema (NULL for good ones)."""
    reader = spark.read.option("mode", "PERMISSIVE").option("ignoreMissingFiles", True)
    if corrupt is None:
        return reader.schema(StructType.fromDDL(ddl))
    return reader.schema(StructType.fromDDL(f"{ddl}, {corrupt} string")).option("columnNameOfCorruptRecord", corrupt)


def declared(ddl: str, grouped: bool) -> str:
    return f"{ddl}, user_id string" if grouped else ddl


def folders(root: str, grouped: bool) -> str:
    return f"{root.rstrip('/')}/{GROUPED if grouped else '*'}/"


def land_grouped(rows: DataFrame, root: str, fmt: str, mode: str = "overwrite") -> str:
    """Land raw rows or documents with their ``user_id`` (the last field) as ``<root>/all_users/*``; a user's rows stay
    together unless the user is hot. The number of files follows the bytes, not the users."""
    user = F.coalesce(F.nullif("user_id", F.lit("")), F.lit(NO_USER)).alias("user_id")
    (rows.hint("rebalance", "user_id").select(*[c for c in rows.columns if c != "user_id"], user).write.mode(mode)
     .options(**(CSV_OPTIONS if fmt == "csv" else {})).format(fmt).save(f"{root.rstrip('/')}/{GROUPED}"))
    return root


def read_plays_csv(spark: SparkSession, root: str, user_id: str | None = ALL_USERS, corrupt: str | None = None,
                   grouped: bool = False) -> DataFrame:
    """S01 + S06 + S09: every ``<root>/<user>/*.csv`` with the declared 10-column schema.

    ``source_file`` keeps provenance. Users without any CSV produce no rows; see ``list_files`` and
    ``user_presence`` (S08) for who has input.
    """
    df = (_base(spark, declared(RAW_PLAYS_DDL, grouped), corrupt).option("header", True).option("pathGlobFilter", "*.csv")
          .csv(folders(root, grouped)))
    df = with_path_user(df, grouped).withColumn("source_file", F.col("_metadata.file_name"))
    return _scope(df, user_id)


def with_path_user(df: DataFrame, grouped: bool = False) -> DataFrame:
    """Add ``user_id`` (text) from the folder; replaces a discovered ``user_id=`` partition column. Grouped files name it themselves."""
    if grouped:
        return df.select(*[c for c in df.columns if c != "user_id"], "user_id")
    return df.drop("user_id").withColumn("user_id", user_from_path())


def file_kind(name: Column) -> Column:
    """Ordered routing by file name (first matching pattern wins), JSON only."""
    expr = None
    for kind, pat in KIND_PATTERNS:
        cond = name.contains(pat) & name.endswith(".json")
        expr = F.when(cond, F.lit(kind)) if expr is None else expr.when(cond, F.lit(kind))
    return expr


def _read_json_kind(spark: SparkSession, root: str, kind: str, ddl: str, glob: str,
                    multi_line: bool = True, routed: bool = True, corrupt: str | None = None, grouped: bool = False) -> DataFrame:
    """Documents of one kind under ``<root>/<user>/``.

    ``routed`` picks them by file name among the collector's mixed files (S07);
    ``routed=False`` reads every ``*.json`` of a folder that holds only this kind
    (e.g. a landing zone written by Spark, whose files are named ``part-*``).
    ``multi_line=False`` reads JSON lines instead of one array/object per file.
    """
    df = (_base(spark, declared(ddl, grouped), corrupt).option("multiLine", multi_line).option("pathGlobFilter", glob if routed else "*.json")
          .json(folders(root, grouped)))
    df = with_path_user(df, grouped).withColumn("source_file", F.col("_metadata.file_name"))
    return df.filter(file_kind(F.col("source_file")) == kind) if routed else df


def read_likes_json(spark: SparkSession, root: str, user_id: str | None = ALL_USERS,
                    multi_line: bool = True, routed: bool = True, corrupt: str | None = None, grouped: bool = False) -> DataFrame:
    """S02 (+S07, S09): every likes document (JSON array) of every user, one row per like."""
    df = _read_json_kind(spark, root, "likes", RAW_LIKES_DDL, "*likes*.json", multi_line, routed, corrupt, grouped)
    return _scope(df, user_id)


def read_followed_json(spark: SparkSession, root: str, user_id: str | None = ALL_USERS,
                       multi_line: bool = True, routed: bool = True, corrupt: str | None = None, grouped: bool = False) -> DataFrame:
    """``{"artists_ids": [...]}`` documents exploded to (user_id, artist_id, source_file)."""
    df = _read_json_kind(spark, root, "followed", RAW_FOLLOWED_DDL, "*followed*.json", multi_line, routed, corrupt, grouped)
    if corrupt is None:
        df = df.select("user_id", "source_file", F.explode("artists_ids").alias("artist_id"))
    else:  # a document that could not be read keeps one row, for its text
        ids = F.when(F.col(corrupt).isNotNull(), F.array(F.lit(None).cast("string"))).otherwise(F.col("artists_ids"))
        df = df.select("user_id", "source_file", corrupt, F.explode(ids).alias("artist_id"))
    return _scope(df, user_id)


def read_top_tracks_json(spark: SparkSession, root: str, user_id: str | None = ALL_USERS,
                         multi_line: bool = True, routed: bool = True, corrupt: str | None = None, grouped: bool = False) -> DataFrame:
    """Ranked top-track documents; both ``duration_ms`` and the writer's ``duration`` key are read."""
    df = _read_json_kind(spark, root, "top_tracks", RAW_TOP_TRACKS_DDL, "*top_*.json", multi_line, routed, corrupt, grouped)
    return _scope(df, user_id)


def read_artists_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Artist catalog documents (JSON array, or JSON lines with ``multi_line=False``)."""
    return _base(spark, RAW_ARTISTS_DDL).option("multiLine", multi_line).json(path)


CSV_OPTIONS = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def land_per_user(rows: DataFrame, root: str, fmt: str, mode: str = "overwrite") -> str:
    """Land raw rows or documents as ``<root>/user_id=<user>/*`` (the collector's layout)."""
    with sinks.many_folders(rows.sparkSession) as n:
        (rows.hint("rebalance", n, "user_id").write.mode(mode).option("partitionOverwriteMode", "static")
         .options(**(CSV_OPTIONS if fmt == "csv" else {}), **sinks.PLAIN_FILES).partitionBy("user_id").format(fmt).save(root))
    return root


def stage_plays_csv(rows: DataFrame, root: str, mode: str = "overwrite", grouped: bool = False) -> str:
    """Land raw play rows as header CSV files, a folder per user (the collector's layout) or grouped."""
    return (land_grouped if grouped else land_per_user)(rows, root, "csv", mode)


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(user_id, file_name, bytes) of the files under ``<root>/<user>/``: a listing, no file is opened."""
    try:
        found = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(f"{root.rstrip('/')}/*/")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "user_id string, file_name string, bytes bigint")
    parts = F.split("path", "/")
    return found.select(F.regexp_replace(F.element_at(parts, -2), r"^user_id=", "").alias("user_id"), F.element_at(parts, -1).alias("file_name"),
                        F.col("length").alias("bytes"))


def per_file_counts(df: DataFrame) -> DataFrame:
    """Rows per source file (and user), one aggregation."""
    return df.groupBy("user_id", "source_file").agg(F.count(F.lit(1)).alias("records"))


def user_presence(found: DataFrame, requested: DataFrame | None = None) -> DataFrame:
    """S08 + A26: (user_id, has_input) for requested users; found-only when no request list is given.

    ``found`` is a listing (``list_files``): a user with a file has input, whatever the file holds.
    """
    f = found.select("user_id").distinct().withColumn("has_input", F.lit(True))
    if requested is None:
        return f
    return requested.select("user_id").distinct().join(f, "user_id", "left").select(
        "user_id", F.coalesce("has_input", F.lit(False)).alias("has_input"))


# --- nested API payloads (S19-S21, S23) --------------------------------------------

ARTIST = "struct<id:string,name:string>"
TRACK = (f"struct<id:string,name:string,duration_ms:int,popularity:int,explicit:boolean,"
         f"artists:array<{ARTIST}>,album:struct<id:string,name:string>>")
PLAYS_PAGE_DDL = f"items array<struct<played_at:string,track:{TRACK}>>"
LIKES_PAGE_DDL = f"items array<struct<added_at:string,track:{TRACK}>>"
TOP_PAGE_DDL = f"offset int, items array<{TRACK}>"


def read_pages(spark: SparkSession, root: str, ddl: str, glob: str, multi_line: bool = True, grouped: bool = False) -> DataFrame:
    """API response pages with user and page file name: one JSON document per file
    (as the collector saves them), or JSON lines (one page per line) with ``multi_line=False``."""
    df = (_base(spark, declared(ddl, grouped)).option("multiLine", multi_line).option("pathGlobFilter", glob)
          .json(folders(root, grouped)))
    return with_path_user(df, grouped).withColumn("page_file", F.col("_metadata.file_name"))


def stage_pages(pages: DataFrame, root: str, grouped: bool = False) -> str:
    """Land page documents (``user_id`` + page fields) as JSON lines, a folder per user or grouped."""
    return (land_grouped if grouped else land_per_user)(pages, root, "json")


def flatten_play_items(pages: DataFrame) -> DataFrame:
    """Recently-played items -> the 10 CSV columns (first artist only)."""
    it = pages.select("user_id", F.explode("items").alias("it"))
    t = F.col("it.track")
    first = F.get(t["artists"], 0)
    return it.select(
        "user_id", F.col("it.played_at").alias("played_at"), t["name"].alias("track_name"),
        first["name"].alias("artist_name"), t["album"]["name"].alias("album_name"), t["id"].alias("track_id"),
        first["id"].alias("artist_id"), t["album"]["id"].alias("album_id"), t["duration_ms"].alias("duration_ms"),
        t["popularity"].alias("popularity"), t["explicit"].alias("explicit"))


def flatten_like_items(pages: DataFrame) -> DataFrame:
    """Saved-track items -> likes document rows (all artist ids kept as an array)."""
    it = pages.select("user_id", F.explode("items").alias("it"))
    t = F.col("it.track")
    return it.select(
        "user_id", t["id"].alias("track_id"), t["album"]["id"].alias("album_id"),
        F.transform(t["artists"], lambda a: a["id"]).alias("artists_id"), t["explicit"].alias("explicit"),
        t["duration_ms"].alias("duration_ms"), t["name"].alias("track_name"),
        t["popularity"].alias("track_popularity"), F.col("it.added_at").alias("added_at"))


def flatten_top_items(pages: DataFrame, page_order: Column | None = None) -> DataFrame:
    """S21 + S23: top-track items with rank = position + 1 across pages in (page, position) order.

    Writes the duration under ``duration`` like the collector does (trap T9).
    The rank is the item's position plus the sizes of the user's earlier pages:
    the only window runs over one row per (user, page), never over a user's
    items, so a user with very many pages does not become one sorted group.
    """
    page_order = page_order if page_order is not None else F.col("page_file")
    paged = pages.select("user_id", page_order.alias("_page"), "items")
    sizes = paged.select("user_id", "_page", F.size("items").alias("_n"))
    before = Window.partitionBy("user_id").orderBy("_page").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("user_id", "_page", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    it = paged.join(offsets, ["user_id", "_page"]).select(
        "user_id", "_offset", F.posexplode("items").alias("_pos", "t"))
    t = F.col("t")
    return it.select(
        "user_id", (F.col("_offset") + F.col("_pos") + 1).cast("int").alias("ith_preference"),
        t["id"].alias("track_id"),
        t["album"]["id"].alias("album_id"), F.transform(t["artists"], lambda a: a["id"]).alias("artists_id"),
        t["explicit"].alias("explicit"), t["duration_ms"].alias("duration"), t["name"].alias("track_name"),
        t["popularity"].alias("track_popularity"))


def read_profiles(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Stored profile table, or an empty frame with the table's schema when absent.

    Missing users then get the default profile from ``profiles.lookup_profiles`` (J04).
    """
    ddl = ("user_id string, cluster int, profile_name string, profile_emoji string, profile_description string, "
           "profile_characteristics string, profile_criteria string, avg_popularity double, "
           "daily_listening_intensity double, artist_diversity double, night_preference_ratio double, "
           "exploration_ratio double, peak_hour double, generated_at string")
    schema = StructType.fromDDL(ddl)
    try:
        reader = spark.read.schema(schema)
        df = reader.option("header", True).csv(path) if fmt == "csv" else reader.parquet(path)
        df.schema  # resolve the path now
        return df
    except AnalysisException as e:  # only a missing path falls back
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
