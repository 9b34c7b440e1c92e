"""Artist catalog: cleaning, tiers and weighted genre categories.

Genre scoring sums, over every (genre element, rule pattern) pair where the
lower-cased genre *contains* the pattern, the rule weight into the rule's
category; the best category wins with ties going to the earlier category, and
artists with no hit get ``other`` (an empty genre list was replaced by
``['unknown']``, which hits nothing).

With the fixed rules the score depends on the row alone and is an expression of
the row: one ``aggregate`` over the genres per category with the rules as
literals. No join, no shuffle; rows that share an id are scored apart.

Rules of any number come as a DataFrame (``*_by_rules``): distinct genres and
patterns meet on the pattern's rarest trigram, an equi-join, and ``contains``
decides; shorter patterns meet on themselves. Scores of distinct genres are then
joined to the artists' genre elements.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.functions import labels as L

# Category order (ties go to the earlier one) and the scoring rules
# (category, weight, patterns), in the reference's order.
GENRE_CATEGORIES = ["latin", "pop", "rock", "electronic", "hip_hop",
                    "jazz_blues", "country_folk", "classical", "reggae", "world"]
GENRE_RULES = [
    ("latin", 10, ["reggaeton", "bachata", "salsa", "merengue", "cumbia", "tango"]),
    ("latin", 8, ["latin", "latino", "spanish", "mexican", "colombian", "argentinian"]),
    ("latin", 9, ["bossa nova", "flamenco", "fado"]),
    ("pop", 7, ["pop"]),
    ("pop", 9, ["k-pop", "j-pop"]),
    ("pop", 5, ["mainstream", "chart", "commercial"]),
    ("rock", 10, ["heavy metal", "death metal", "black metal", "power metal"]),
    ("rock", 9, ["indie rock", "alternative rock", "punk rock", "prog rock"]),
    ("rock", 7, ["rock", "metal"]),
    ("rock", 6, ["alternative", "indie", "punk", "grunge"]),
    ("electronic", 10, ["house", "techno", "trance", "dubstep", "drum and bass"]),
    ("electronic", 8, ["electronic", "edm", "electronica"]),
    ("electronic", 5, ["dance", "club", "synthesizer", "ambient"]),
    ("hip_hop", 10, ["hip hop", "rap", "trap", "drill", "grime"]),
    ("hip_hop", 6, ["urban", "street", "conscious rap"]),
    ("jazz_blues", 8, ["jazz", "blues", "soul", "funk"]),
    ("jazz_blues", 9, ["neo soul", "jazz fusion", "smooth jazz", "bebop"]),
    ("jazz_blues", 7, ["swing", "dixieland", "gospel"]),
    ("country_folk", 8, ["country", "folk", "americana", "bluegrass"]),
    ("country_folk", 7, ["country pop", "folk rock", "alt-country"]),
    ("country_folk", 4, ["acoustic", "roots", "singer-songwriter"]),
    ("world", 8, ["world", "traditional", "ethnic", "international"]),
    ("world", 9, ["african", "indian", "middle eastern", "celtic"]),
    ("reggae", 10, ["reggae", "ska", "dancehall"]),
    ("reggae", 8, ["jamaican", "dub", "roots reggae"]),
    ("classical", 10, ["classical", "orchestral", "opera", "symphony", "baroque"]),
    ("classical", 8, ["instrumental", "chamber music", "contemporary classical"]),
]
# The empty-genres placeholder, the no-match category and the
# lineage literal written into every catalog / play row.
UNKNOWN_GENRE = "unknown"
OTHER = "other"
DATA_SOURCE = "spotify_api"

CATALOG_COLUMNS = ["id", "name", "popularity", "followers", "genres", "popularity_range",
                   "primary_genre", "followers_tier", "processed_at", "data_source"]
PARTITION_COLUMNS = ["popularity_range", "primary_genre"]


def rule_rows(rules=None) -> list[tuple]:
    """Flatten the rules to (rule_no, category, category_ordinal, weight, pattern) rows."""
    rules = rules or GENRE_RULES
    rows = []
    for i, (cat, weight, patterns) in enumerate(rules):
        for p in patterns:
            rows.append((i, cat, GENRE_CATEGORIES.index(cat), weight, p))
    return rows


def clean_artists(raw: DataFrame) -> DataFrame:
    """Drop rows without id/name, strip names, default numbers and genres."""
    genres = F.coalesce(F.col("genres"), F.array().cast("array<string>"))
    return raw.dropna(subset=["id", "name"]).select(
        "id",
        F.regexp_replace("name", r"^\s+|\s+$", "").alias("name"),
        F.coalesce(F.col("popularity"), F.lit(0)).cast("int").alias("popularity"),
        F.coalesce(F.col("followers"), F.lit(0)).cast("bigint").alias("followers"),
        F.when(F.size(genres) > 0, genres).otherwise(F.array(F.lit(UNKNOWN_GENRE))).alias("genres"),
    )


def _genre_weight(genre: Column, rules: list[tuple]) -> Column:
    """Weights of the rules whose patterns the lower-cased genre contains."""
    text, total = F.lower(genre), F.lit(0)
    for _, weight, patterns in rules:
        for p in patterns:
            total = total + F.when(text.contains(p), weight).otherwise(0)
    return F.coalesce(total, F.lit(0))


def _category_score(genres, rules: list[tuple]) -> Column:
    return F.aggregate(genres, F.lit(0), lambda acc, g: acc + _genre_weight(g, rules))


def category_scores(genres="genres", rules=None) -> Column:
    """Per row: array<struct<score, minus_ord, category>> of the categories with a hit, in category order."""
    rules = rules or GENRE_RULES
    entries = []
    for k, cat in enumerate(GENRE_CATEGORIES):
        own = [r for r in rules if r[0] == cat]
        entries.append(F.struct(_category_score(genres, own).cast("bigint").alias("score"), F.lit(-k).alias("minus_ord"), F.lit(cat).alias("category")))
    return F.filter(F.array(*entries), lambda e: e["score"] > 0)


def genre_scores(artists: DataFrame, rules=None) -> DataFrame:
    """(id, category, score) for every artist row and category with at least one pattern hit."""
    return artists.select("id", F.explode(category_scores("genres", rules)).alias("e")).select("id", "e.category", "e.score")


def best_category(artists: DataFrame, rules=None) -> DataFrame:
    """(id, best, best_score) for artist rows with hits; ties go to the earlier category."""
    best = artists.select("id", F.array_max(category_scores("genres", rules)).alias("b")).where("b is not null")
    return best.select("id", F.col("b.category").alias("best"), F.col("b.score").alias("best_score"))


def primary_genre_of(genres="genres", rules=None) -> Column:
    """The best category of a genre list, ``other`` without hits."""
    return F.coalesce(F.array_max(category_scores(genres, rules))["category"], F.lit(OTHER))


def primary_genre(artists: DataFrame, rules=None) -> DataFrame:
    """(id, primary_genre) for every artist row, ``other`` without hits."""
    return artists.select("id", primary_genre_of("genres", rules).alias("primary_genre"))


RULES_DDL = "rule_no int, category string, category_ord int, weight int, pattern string"


def rules_table(spark, rules=None) -> DataFrame:
    """The fixed rules as a DataFrame (rule_no, category, category_ord, weight, pattern)."""
    return spark.createDataFrame(rule_rows(rules), RULES_DDL)


def _grams(text: Column, size: int) -> Column:
    """Distinct pieces of ``size`` characters of a text."""
    return F.when(F.length(text) >= size, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length(text) - size + 1), lambda i: F.substring(text, i, F.lit(size))))).otherwise(F.array().cast("array<string>"))


def genre_hits_by_rules(genres: DataFrame, rules: DataFrame) -> DataFrame:
    """J07 on distinct lower-cased texts (``genre``): (genre, category, category_ord, score) by rules of any number.

    A pattern of three or more characters meets the genres that hold its rarest trigram, a shorter one those that hold
    itself as a piece, an empty one every genre; ``contains`` then decides. Patterns that occur in several rules count
    for each; NULL patterns hit nothing.
    """
    text, pattern = F.col("genre"), F.col("pattern")
    pieces = F.concat(F.array(F.lit("")), *[_grams(text, n) for n in (1, 2, 3)])
    held = genres.select("genre", F.explode(pieces).alias("piece"))
    often = held.where(F.length("piece") == 3).groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    distinct = rules.where(pattern.isNotNull()).select("pattern").distinct()
    # the trigram in the fewest genres; a pattern one of whose trigrams no genre holds hits nothing
    long = distinct.where(F.length("pattern") >= 3).withColumn("asked", _grams(pattern, 3)).select("pattern", F.size("asked").alias("size"), F.explode("asked").alias("piece"))
    rarest = long.join(often, "piece").groupBy("pattern", "size").agg(F.min(F.struct("n", "piece")).alias("best"), F.count(F.lit(1)).alias("met")) \
        .where(F.col("met") == F.col("size")).select("pattern", F.col("best.piece").alias("piece"))
    keyed = rarest.unionByName(distinct.where(F.length("pattern") < 3).select("pattern", F.col("pattern").alias("piece")))
    found = held.join(keyed, "piece").where(text.contains(pattern)).select("genre", "pattern")
    return found.join(rules, "pattern").groupBy("genre", "category", "category_ord").agg(F.sum(F.col("weight").cast("bigint")).alias("score")) \
        .where(F.col("score") > 0)


def genre_scores_by_rules(artists: DataFrame, rules: DataFrame) -> DataFrame:
    """J07 with rules as data: (row, id, category, category_ord, score) for every artist row and category with a hit.

    ``row`` tells rows that share an id apart. Every genre element of an artist counts, also a repeated one.
    """
    elements = artists.select(F.monotonically_increasing_id().alias("row"), "id", F.col("genres").alias("own")).checkpoint() \
        .select("row", "id", F.explode("own").alias("g")).select("row", "id", F.lower("g").alias("genre")).where("genre is not null")
    times = elements.groupBy("row", "id", "genre").agg(F.count(F.lit(1)).alias("times"))
    hits = genre_hits_by_rules(elements.select("genre").distinct(), rules)
    return times.join(hits, "genre").groupBy("row", "id", "category", "category_ord").agg(F.sum(F.col("score") * F.col("times")).alias("score"))


def best_category_by_rules(artists: DataFrame, rules: DataFrame) -> DataFrame:
    """W05 with rules as data: (row, id, best, best_score) for artist rows with hits; ties go to the earlier category."""
    best = genre_scores_by_rules(artists, rules).groupBy("row", "id").agg(
        F.max(F.struct("score", (-F.col("category_ord")).alias("early"), "category")).alias("b"))
    return best.select("row", "id", F.col("b.category").alias("best"), F.col("b.score").alias("best_score"))


def primary_genre_by_rules(artists: DataFrame, rules: DataFrame) -> DataFrame:
    """G01 with rules as data: (id, primary_genre) for every artist row, ``other`` without hits."""
    numbered = artists.select(F.monotonically_increasing_id().alias("n"), "id", "genres").checkpoint()
    keyed = numbered.select(F.struct("n", "id").alias("id"), "genres")
    best = best_category_by_rules(keyed, rules).select(F.col("id.n").alias("n"), "best")
    return numbered.join(best, "n", "left").select("id", F.coalesce("best", F.lit(OTHER)).alias("primary_genre"))


def artist_catalog(raw: DataFrame, rules=None, with_time: bool = True) -> DataFrame:
    """Cleaned catalog with popularity range, primary genre and followers tier (P14 order)."""
    return clean_artists(raw).select(
        "id", "name", "popularity", "followers", "genres",
        L.popularity_range("popularity").alias("popularity_range"),
        primary_genre_of("genres", rules).alias("primary_genre"),
        L.followers_tier("followers").alias("followers_tier"),
        (F.current_timestamp() if with_time else F.lit(None).cast("timestamp")).alias("processed_at"),
        F.lit(DATA_SOURCE).alias("data_source"),
    )


def categorization_report(catalog: DataFrame) -> DataFrame:
    """Share of artists with a category other than ``other`` (one row)."""
    return catalog.agg(
        F.count(F.lit(1)).alias("artists"),
        F.count_if(F.col("primary_genre") != OTHER).alias("categorized"),
        L.pct(F.count_if(F.col("primary_genre") != OTHER), F.count(F.lit(1))).alias("categorization_rate"))


def genre_distribution(catalog: DataFrame) -> DataFrame:
    """Artist count and average popularity per primary genre."""
    return catalog.groupBy("primary_genre").agg(
        F.count(F.lit(1)).alias("artist_count"), F.avg("popularity").alias("avg_popularity"))
