"""Plan-shape checks: no Python in the hot path, no cartesian products, pushdown / pruning / top-k shapes."""

import pytest

from conftest import SF01
from encore.plans.registry import load_all
from encore.session import scratch_path
from encore.sources.tables import read_table

REG = load_all()
PLANNED = sorted(n for n, q in REG.items() if q.sql)   # builders without eager actions


def plan_of(df) -> str:
    """Formatted physical plan text (untruncated scan metadata)."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", PLANNED)
def test_no_python_udf_and_no_cartesian(spark, name):
    df = REG[name].build(spark, SF01)
    text = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "CartesianProduct",
                "PythonUDF"):
        assert bad not in text, f"{name}: {bad}"


def test_top_k_uses_partial_window_group_limit(spark):
    text = REG["a01_top_artists"].build(spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and "Partial" in text


def test_dedup_keep_one_is_limited_before_shuffle(spark):
    text = REG["c01_plays_etl"].build(spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text


def test_scan_pushdown_and_pruning(spark):
    text = REG["s15_parquet_scan"].build(spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,value:double>" in text
    views = read_table(spark, SF01, "events").filter("event_type = 'view'").select("event_id")
    text = views._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,view)" in text and "ReadSchema: struct<event_id:bigint,event_type:string>" in text


def test_partition_pruning(spark):
    df = REG["k06_partition_pruned_lookup"].build(spark, SF01)
    text = plan_of(df)
    line = [x for x in text.splitlines() if x.startswith("PartitionFilters")][0]
    assert "popularity_range" in line and "= very_high" in line
    assert "primary_genre" in line and "= latin" in line


def test_genre_rules_stay_in_the_row(spark):
    text = plan_of(REG["j07_substring_theta_join"].build(spark, SF01))
    assert "Join" not in text and "Exchange" not in text and "Contains(" in text


def test_window_insights_read_the_window_and_the_user_dimension(spark):
    """Every scan of the plays carries the window's time bound; the spine is the one-row-per-user dimension."""
    from encore.operators import insights as I
    from encore.plans import dashboard as D
    from encore.sources import fixtures as fx
    path = scratch_path(spark, "stored_plays")
    fx.plays(spark, SF01).write.parquet(path)
    plays, users = spark.read.parquet(path), fx.users(spark, SF01)
    for df, most in ((D.insights_summary(plays, "2024-01-31", 30, users=users), 3), (D.executive_summary(plays, "2024-01-31", 30, users=users), 3),
                     (I.hourly_pattern(plays, "2024-01-31", 7, users=users), 1), (I.insights_available(plays, "2024-01-31", users=users), 1)):
        scans = [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x and "stored_plays" in x]
        assert 1 <= len(scans) <= most and all("GreaterThanOrEqual(played_at_local" in x for x in scans), scans


def test_user_features_copy_no_play(spark):
    for name in ("m01_user_features", "a06_user_stats", "a11_distinct_counts"):
        assert "Expand" not in plan_of(REG[name].build(spark, SF01)), name


@pytest.mark.parametrize("name", ["c05_insights_summary", "c01_plays_etl", "a17_quality_report",
                                  "j06_rank_comparison", "g02_artist_catalog"])
def test_results_do_not_depend_on_partitioning(spark, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = sorted(map(repr, REG[name].build(spark, SF01).collect()))
        spark.conf.set("spark.sql.shuffle.partitions", "11")
        b = sorted(map(repr, REG[name].build(spark, SF01).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert a == b


@pytest.mark.parametrize("name", ["c05_insights_summary", "c07_executive_summary", "a03_weekday_weekend",
                                  "a04_popularity_distribution"])
def test_category_distinct_counts_do_not_expand_plays(spark, name):
    """Distinct days / artists come from a two-level aggregation, not an Expand of every play."""
    text = REG[name].build(spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in text


def test_window_insights_push_time_bound_and_read_user_spine_only(spark, tmp_path):
    """On a stored play table the window reaches the scan as a time bound; the user spine reads user_id only."""
    from conftest import SF001
    from encore.operators import insights as I
    from encore.plans.oracle_views import AS_OF
    from encore.sources import fixtures as fx
    path = str(tmp_path / "user_tracks")
    fx.plays(spark, SF001).write.mode("overwrite").parquet(path)
    df = spark.read.parquet(path)
    for built in (I.hourly_pattern(df, AS_OF, 30), I.user_category_aggregates(df, AS_OF, 30, 90, 90)):
        scans = [x for x in built._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x]
        assert any("GreaterThanOrEqual(played_at_local," in x for x in scans)
        assert any("ReadSchema: struct<user_id:string>" in x for x in scans)


def test_range_rankings_do_not_copy_plays_per_range(spark):
    """Conditional per-range aggregates, no explode of plays into ranges before the aggregation."""
    text = REG["w06_top_by_range"].build(spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert "explode(" not in text and "WindowGroupLimit" in text
