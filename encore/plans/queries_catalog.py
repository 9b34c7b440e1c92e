"""Registered artist-catalog queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from encore.functions import labels as L
from encore.operators import etl
from encore.operators import genres as G
from encore.plans.registry import query
from encore.sources import fixtures as fx
from encore.sources import sinks


def _rules_values() -> str:
    rows = ", ".join(f"({n}, '{c}', {o}, {w}, '{p}')" for n, c, o, w, p in G.rule_rows())
    return f"rules(rule_no, category, category_ord, weight, pattern) as (values {rows})"


CLEAN = """ca as (
  select row_number() over () rn_, id, regexp_replace(name, '^\\s+|\\s+$', '', 'g') name, coalesce(popularity, 0) popularity,
    coalesce(followers, 0) followers,
    case when len(coalesce(genres, [])) > 0 then genres else ['unknown'] end genres
  from artists_raw where id is not null and name is not null)"""
SCORES = f"""{_rules_values()},
{CLEAN},
ex as (select rn_, id, lower(unnest(genres)) g from ca),
sc as (select ex.rn_, ex.id, r.category, r.category_ord, cast(sum(r.weight) as bigint) score
       from ex join rules r on contains(ex.g, r.pattern) group by ex.rn_, ex.id, r.category, r.category_ord),
best as (select rn_, id, category best, score best_score from (
  select *, row_number() over (partition by rn_ order by score desc, category_ord) rn from sc) where rn = 1)"""
RANGE_SQL = ("case when popularity >= 80 then 'very_high' when popularity >= 60 then 'high' "
             "when popularity >= 40 then 'medium' when popularity >= 20 then 'low' else 'very_low' end")
TIER_SQL = ("case when followers >= 10000000 then 'mega' when followers >= 1000000 then 'major' "
            "when followers >= 100000 then 'established' when followers >= 10000 then 'emerging' else 'niche' end")
CATALOG = f"""{SCORES},
cat as (select ca.id, ca.name, ca.popularity, ca.followers, ca.genres, {RANGE_SQL} popularity_range,
  coalesce(best.best, 'other') primary_genre, {TIER_SQL} followers_tier, '{G.DATA_SOURCE}' data_source
  from ca left join best using (rn_))"""


def _raw(spark, sf):
    return fx.artists_raw(spark, sf)


def _catalog(spark, sf):
    return G.artist_catalog(_raw(spark, sf))


@query("g02_artist_catalog", f"""with {CATALOG}
select id, name, popularity, followers, to_json(genres) genres_json, popularity_range, primary_genre,
  followers_tier, data_source from cat""")
def g02_artist_catalog(spark, sf):
    """Cleaned artist catalog with range, primary genre and followers tier (processed_at omitted)."""
    c = _catalog(spark, sf)
    return c.select("id", "name", "popularity", "followers", F.to_json("genres").alias("genres_json"),
                    "popularity_range", "primary_genre", "followers_tier", "data_source")


@query("g01_genre_scoring", f"""with {SCORES}
select ca.id, coalesce(best.best, 'other') primary_genre from ca left join best using (rn_)""")
def g01_genre_scoring(spark, sf):
    """Primary genre per artist from the 27 weighted substring rules."""
    a = G.clean_artists(_raw(spark, sf))
    return G.primary_genre(a)


@query("j07_substring_theta_join", f"""with {SCORES}
select id, category, score from sc""")
def j07_substring_theta_join(spark, sf):
    """Per artist and category, summed weights of all (genre, pattern) substring hits."""
    a = G.clean_artists(_raw(spark, sf))
    return G.genre_scores(a)


@query("g01_rules_as_data", f"""with {SCORES}
select ca.id, coalesce(best.best, 'other') primary_genre from ca left join best using (rn_)""")
def g01_rules_as_data(spark, sf):
    """Primary genre per artist with the rules as a DataFrame, by a join on the patterns' rarest trigrams."""
    return G.primary_genre_by_rules(G.clean_artists(_raw(spark, sf)), G.rules_table(spark))


@query("j07_trigram_join", f"""with {SCORES}
select id, category, score from sc""")
def j07_trigram_join(spark, sf):
    """The substring join with the rules as a DataFrame: equi-join on trigrams, then contains."""
    return G.genre_scores_by_rules(G.clean_artists(_raw(spark, sf)), G.rules_table(spark)).select("id", "category", "score")


@query("w05_argmax_category", f"""with {SCORES}
select id, best, best_score from best""")
def w05_argmax_category(spark, sf):
    """Best category and its score per scored artist (ties to the earlier category)."""
    a = G.clean_artists(_raw(spark, sf))
    return G.best_category(a)


@query("p07_drop_missing", """
select id, name from artists_raw where id is not null and name is not null""")
def p07_drop_missing(spark, sf):
    """Catalog rows without id or name are dropped."""
    return _raw(spark, sf).dropna(subset=["id", "name"]).select("id", "name")


@query("p04_trim", f"""with {CLEAN}
select id, name from ca""")
def p04_trim(spark, sf):
    """Artist names with surrounding whitespace removed."""
    return G.clean_artists(_raw(spark, sf)).select("id", "name")


@query("p06_empty_list_default", f"""with {CLEAN}
select id, to_json(genres) genres_json, popularity, followers from ca""")
def p06_empty_list_default(spark, sf):
    """NULL/empty genre lists become ['unknown']; NULL numbers become 0."""
    c = G.clean_artists(_raw(spark, sf))
    return c.select("id", F.to_json("genres").alias("genres_json"), "popularity", "followers")


@query("p15_primary_artist", """
select id, case when len(genres) > 0 then genres[1] else '-1' end first_genre from artists_raw""")
def p15_primary_artist(spark, sf):
    """First element of a list column, '-1' when the list is NULL or empty."""
    return _raw(spark, sf).select("id", etl.first_or_sentinel("genres").alias("first_genre"))


@query("p17_popularity_range", f"""with {CLEAN}
select id, popularity, {RANGE_SQL} popularity_range from ca""")
def p17_popularity_range(spark, sf):
    """Five popularity ranges (>=80, 60, 40, 20)."""
    c = G.clean_artists(_raw(spark, sf))
    return c.select("id", "popularity", L.popularity_range("popularity").alias("popularity_range"))


@query("p18_followers_tier", f"""with {CLEAN}
select id, followers, {TIER_SQL} followers_tier from ca""")
def p18_followers_tier(spark, sf):
    """Five follower tiers (10M, 1M, 100K, 10K)."""
    c = G.clean_artists(_raw(spark, sf))
    return c.select("id", "followers", L.followers_tier("followers").alias("followers_tier"))


@query("p24_join_genres", """
select id, case when len(coalesce(genres, [])) > 0 then array_to_string(genres, ', ') else 'No genres' end genres_text
from artists_raw""")
def p24_join_genres(spark, sf):
    """Genre list as ', '-joined text, 'No genres' when NULL or empty."""
    r = _raw(spark, sf)
    return r.select("id", L.join_or("genres").alias("genres_text"))


@query("a22_categorization_rate", f"""with {CATALOG}
select count(*) artists, count(*) filter (where primary_genre <> 'other') categorized,
  case when count(*) > 0 then cast(count(*) filter (where primary_genre <> 'other') as double) / count(*) * 100
       else 0.0 end categorization_rate
from cat""")
def a22_categorization_rate(spark, sf):
    """Share of artists whose primary genre is not 'other'."""
    return G.categorization_report(_catalog(spark, sf))


@query("a25_genre_distribution", f"""with {CATALOG}
select primary_genre, count(*) artist_count, avg(popularity) avg_popularity from cat group by primary_genre""")
def a25_genre_distribution(spark, sf):
    """Artists and average popularity per primary genre."""
    return G.genre_distribution(_catalog(spark, sf))


@query("a22_range_distribution", f"""with {CATALOG}
select popularity_range, primary_genre, count(*) artists from cat group by popularity_range, primary_genre""")
def a22_range_distribution(spark, sf):
    """Artist counts by popularity range and primary genre (the partition grid)."""
    return _catalog(spark, sf).groupBy("popularity_range", "primary_genre").agg(F.count(F.lit(1)).alias("artists"))


@query("k06_partition_pruned_lookup", f"""with {CATALOG}
select id, name, followers from cat where popularity_range = 'very_high' and primary_genre = 'latin' order by followers desc, id""")
def k06_partition_pruned_lookup(spark, sf):
    """Write the catalog partitioned (S11), read back with a partition filter (pruned scan).

    The most followed artists come first. The catalog is written under the session's checkpoint folder; the lookup
    plan carries PartitionFilters on both partition columns.
    """
    path = sinks.write_catalog(_catalog(spark, sf))
    return (spark.read.parquet(path)
            .filter((F.col("popularity_range") == "very_high") & (F.col("primary_genre") == "latin"))
            .select("id", "name", "followers").orderBy(F.desc("followers"), "id"))


@query("s11_partitioned_sink", f"""with {CATALOG}
select popularity_range, primary_genre, count(*) artists, sum(followers) followers from cat
group by popularity_range, primary_genre""")
def s11_partitioned_sink(spark, sf):
    """Round trip through the two-level partitioned layout: per-partition counts read back."""
    path = sinks.write_catalog(_catalog(spark, sf))
    return (spark.read.parquet(path).groupBy("popularity_range", "primary_genre")
            .agg(F.count(F.lit(1)).alias("artists"), F.sum("followers").alias("followers")))


@query("s12_partition_layout", f"""with {CATALOG}
select popularity_range, primary_genre, count(*) "rows", true has_files, true has_bytes from cat
group by popularity_range, primary_genre""")
def s12_partition_layout(spark, sf):
    """Rows per partition directory of the written catalog, and that it holds files with bytes."""
    path = sinks.write_catalog(_catalog(spark, sf))
    layout = sinks.partition_layout(spark.read.parquet(path), G.PARTITION_COLUMNS)
    return layout.select("popularity_range", "primary_genre", "rows", (F.col("files") >= 1).alias("has_files"), (F.col("bytes") > 0).alias("has_bytes"))
