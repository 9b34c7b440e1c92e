"""Exploration / notebook operators.

Everything is one aggregation or one projection over the full table; the only
``limit`` is the head/tail sample, where the limit is the feature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from encore.functions import labels as L
from encore.functions.time import EXPORT_FORMAT
from encore.operators.clustering import exact_quantiles

# Display headers of the play export.
EXPORT_HEADERS = {"played_at": "Reproducido el", "track": "Canción", "artists": "Artista(s)", "album": "Álbum",
                  "duration_ms": "Duración (ms)", "popularity": "Popularidad"}


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Frequency of each value, most frequent first."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), F.asc(col))


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, std, min, 25 %, 50 %, 75 %, max per numeric column, long format.

    Moments come from one aggregation; quartiles are exact and interpolated
    (distributed order statistics, see ``clustering.exact_quantiles``).
    """
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).cast("double").alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    moments = df.agg(*aggs)
    stats = ["count", "mean", "std", "min", "max"]
    long = moments.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(s).alias("stat"), F.col(f"{c}__{s}").alias("value"))
        for c in cols for s in stats])))
    q = exact_quantiles(df, cols).select(
        F.col("feature").alias("column"),
        F.concat((F.col("p") * 100).cast("int").cast("string"), F.lit("%")).alias("stat"),
        F.col("q").alias("value"))
    return long.unionByName(q)


def null_profile(df: DataFrame) -> DataFrame:
    """Per column its type, non-null and null counts (one aggregation)."""
    counts = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"),
                              F.col(f"`{c}`").alias("non_null")) for c in df.columns])
    return (counts.select("__rows", F.inline(rows))
            .select("column_name", "data_type", "non_null", (F.col("__rows") - F.col("non_null")).alias("nulls")))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def head_tail(df: DataFrame, order_cols: list[str], n: int = 5) -> DataFrame:
    """First and last ``n`` rows under a total order (TakeOrderedAndProject, no global sort)."""
    head = df.orderBy(*[F.asc(c) for c in order_cols]).limit(n).withColumn("part", F.lit("head"))
    tail = df.orderBy(*[F.desc(c) for c in order_cols]).limit(n).withColumn("part", F.lit("tail"))
    return head.unionByName(tail)


def numeric_coercion(df: DataFrame, cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """P25: strict per-row coercion (bad -> 0) and the lenient per-column decision.

    Returns (rows with ``<c>_num``, one-row frame ``<c>_is_numeric``).
    """
    strict = df.select("*", *[L.strict_numeric(c).alias(f"{c}_num") for c in cols])
    lenient = df.agg(*[L.lenient_numeric_ok(c).alias(f"{c}_is_numeric") for c in cols])
    return strict, lenient


def export_plays(plays: DataFrame) -> DataFrame:
    """Play export with display headers (time formatted, names as stored)."""
    h = EXPORT_HEADERS
    cols = [F.date_format("played_at_utc", EXPORT_FORMAT).alias(h["played_at"])]
    cols.append(F.col("track_name" if "track_name" in plays.columns else "track_id").alias(h["track"]))
    cols.append(F.col("artist_name").alias(h["artists"]))
    if "album_name" in plays.columns:
        cols.append(F.col("album_name").alias(h["album"]))
    cols += [F.col("duration_ms").alias(h["duration_ms"]), F.col("popularity").alias(h["popularity"])]
    return plays.select(*cols)


def sync_plan(manifest: DataFrame, ledger: DataFrame, skip_extension: str = "csv") -> DataFrame:
    """Per file, whether it is skipped (``skip_extension`` key already synced) or uploaded."""
    present = ledger.select("user_id", "file_name").distinct().withColumn("present", F.lit(True))
    j = manifest.join(present, ["user_id", "file_name"], "left")
    skip = F.coalesce(F.col("present"), F.lit(False)) & F.col("file_name").endswith("." + skip_extension)
    return j.select("user_id", "file_name", skip.alias("skipped"))


def sync_summary(plan: DataFrame) -> DataFrame:
    """(processed, uploaded, skipped) per user."""
    return plan.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("processed"), F.count_if(~F.col("skipped")).alias("uploaded"),
        F.count_if(F.col("skipped")).alias("skipped"))


def files_to_send(manifest: DataFrame, ledger: DataFrame, skip_extension: str = "csv") -> DataFrame:
    """Manifest entries whose ``skip_extension`` key is not in the ledger, plus every other file."""
    is_skip_ext = F.col("file_name").endswith("." + skip_extension)
    new_keys = manifest.filter(is_skip_ext).join(ledger, ["user_id", "file_name"], "left_anti")
    return new_keys.unionByName(manifest.filter(~is_skip_ext))


def followed_document(follows: DataFrame, max_ids: int = 100_000) -> DataFrame:
    """(user_id, document_no, document): ``{"artists_ids": [...]}`` JSON documents per user (ids sorted).

    Every user's artists are dealt by hash to ceil(n / max_ids) documents, numbered from 0, so the list of one
    document has an expected bound whatever a user follows; a user with up to ``max_ids`` artists has document 0
    only. Readers explode the documents of all numbers.
    """
    counts = follows.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    chunk = F.pmod(F.xxhash64("artist_id"), F.ceil(F.col("_n") / F.lit(float(max_ids)))).cast("int")
    tagged = follows.join(counts, "user_id").select("user_id", "artist_id", chunk.alias("document_no"))
    return (tagged.groupBy("user_id", "document_no")
            .agg(F.to_json(F.struct(F.array_sort(F.collect_list("artist_id")).alias("artists_ids"))).alias("document")))
