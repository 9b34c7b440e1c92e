"""SQL functions with parameters, month-pruned history, bucketed tables, catalog updates in place."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from encore.operators import insights as I
from encore.plans import queries_sql as Q
from encore.plans.registry import load_all
from encore.sources import catalog, layout, sql_functions
from encore.sources import fixtures as fx
from encore.sources.schemas import TABLES, TableSpec

AT = dt.date(2024, 1, 31)


def formatted(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def one_user(spark):
    return fx.users(spark, SF001).orderBy("user_id").first().user_id


@pytest.mark.parametrize("name,build,extra", [
    ("top_artists", lambda p, u, n: I.top_artists(p, AT, n, 10, u), {"top_n": 10}),
    ("hourly_pattern", lambda p, u, n: I.hourly_pattern(p, AT, n, u), {}),
    ("weekday_weekend", lambda p, u, n: I.weekday_weekend(p, AT, n, u), {}),
    ("popularity_tiers", lambda p, u, n: I.popularity_distribution(p, AT, n, u), {})])
def test_functions_equal_the_insights(spark, name, build, extra):
    user = one_user(spark)
    for who in (None, user):
        for days in (90, 12):
            got = Q.ask(spark, SF001, name, only_user=who, as_of=AT, days_back=days, **extra)
            assert rows(got) == rows(build(fx.plays(spark, SF001), who, days)), (name, who, days)
    text = formatted(Q.ask(spark, SF001, name, only_user=user, as_of=AT, days_back=12, **extra))
    filters = [x for x in text.splitlines() if x.startswith("PartitionFilters")]
    assert any(f"({layout.MONTH}" in x and ">= 2024-01)" in x for x in filters) and all(f"{layout.BUCKET}" in x for x in filters)


def test_a_quote_in_an_argument_is_a_character(spark):
    for evil in ("x' OR '1'='1", "'; DROP TABLE play_history; --", "\\' OR 1=1 --"):
        got = Q.ask(spark, SF001, "top_artists", only_user=evil, as_of=AT, days_back=90, top_n=5)
        assert got.count() == 0
        assert Q.ask(spark, SF001, "artists_by", in_range=evil, in_genre="latin").count() == 0
    assert Q.ask(spark, SF001, "plays_per_user").count() == fx.users(spark, SF001).count()


def test_arguments_are_checked_and_prune(spark):
    with pytest.raises(ValueError, match="takes"):
        Q.ask(spark, SF001, "top_ranked_tracks", rank=3)
    text = formatted(Q.ask(spark, SF001, "artists_by", in_range="high", in_genre="rock"))
    line = next(x for x in text.splitlines() if x.startswith("PartitionFilters"))
    assert "popularity_range" in line and "primary_genre" in line and "high" in line and "rock" in line
    assert set(sql_functions.FUNCTIONS) >= {"plays_per_user", "likes_per_artist", "genre_counts"}


def test_a_window_opens_its_months_only(spark, tmp_dir):
    days = spark.sql("select explode(sequence(timestamp_ntz'2023-02-01 12:00:00', timestamp_ntz'2024-01-31 12:00:00', interval 1 day)) as played_at_local")
    plays = days.withColumn("u", F.explode(F.sequence(F.lit(0), F.lit(39)))).selectExpr(
        "concat('u', u) as user_id", "cast(played_at_local as timestamp) as played_at_utc", "played_at_local", "'t' as track_id")
    plays = plays.unionByName(spark.sql("select 'u1' as user_id, cast(null as timestamp) as played_at_utc, cast(null as timestamp_ntz) as played_at_local, 't' as track_id"))
    stored = spark.read.parquet(layout.write_history(plays, f"{tmp_dir}/h"))
    every = len(stored.inputFiles())
    window = layout.history_scan(stored, AT, 30)
    assert window.count() == 40 * 31 and stored.count() == 40 * 365 + 1
    for df, most in ((window, 1 / 12), (layout.history_scan(stored, AT, 30, "u7"), 1 / 150)):
        text = formatted(df)
        assert f"{layout.MONTH}" in next(x for x in text.splitlines() if x.startswith("PartitionFilters"))
        read = df.select("user_id").withColumn("f", F.input_file_name()).select("f").distinct().count()
        assert 0 < read <= every * most + 1
    assert layout.history_scan(stored, AT, 30, "u7").count() == 31


def test_bucketed_features_need_no_exchange(spark):
    df = load_all()["j01_bucketed_features"].build(spark, SF001)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in text and "Exchange hashpartitioning" not in text


def spec(ddl, **kw):
    return TableSpec("grown", ddl, key=("id",), partition_by=("part",), **kw)


def test_update_in_place(spark, tmp_dir):
    db = "encore_update"
    old = spec("id string, part string", description="one")
    spark.createDataFrame([("a", "x"), ("b", "y")], "id string, part string").write.partitionBy("part").parquet(f"{tmp_dir}/t")
    catalog.create_database(spark, db)
    try:
        catalog.create_table(spark, db, old, f"{tmp_dir}/t")
        made = {r.col_name: r.data_type for r in spark.sql(f"describe table extended {db}.grown").collect()}["Created Time"]
        assert catalog.update_table(spark, db, old, f"{tmp_dir}/t") == "unchanged"
        # an added column and a changed property
        new = spec("id string, n bigint, part string", properties={"steward": "team"})
        spark.createDataFrame([("c", 3, "z")], "id string, n bigint, part string").write.mode("append").partitionBy("part").parquet(f"{tmp_dir}/t")
        assert catalog.update_table(spark, db, new, f"{tmp_dir}/t") == "updated"
        assert sorted(tuple(r) for r in spark.table(f"{db}.grown").select("id", "n", "part").collect()) == [("a", None, "x"), ("b", None, "y"), ("c", 3, "z")]
        assert {r.key: r.value for r in spark.sql(f"show tblproperties {db}.grown").collect()}["steward"] == "team"
        assert spark.sql(f"show partitions {db}.grown").count() == 3
        assert {r.col_name: r.data_type for r in spark.sql(f"describe table extended {db}.grown").collect()}["Created Time"] == made
        assert catalog.update_table(spark, db, new, f"{tmp_dir}/t") == "unchanged"
        # another type, other partitions: nothing is touched
        for bad in (spec("id string, n string, part string"), TableSpec("grown", "id string, n bigint, part string", key=("id",))):
            with pytest.raises(catalog.IncompatibleTable):
                catalog.update_table(spark, db, bad, f"{tmp_dir}/t")
        assert spark.table(f"{db}.grown").schema["n"].dataType.simpleString() == "bigint" and "play_history" in TABLES
    finally:
        catalog.drop_database(spark, db)
    assert not spark.catalog.databaseExists(db)
