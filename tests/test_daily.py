"""Daily partials: windows added up equal the direct insights, also after late plays; sketches within their bound."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from encore.operators import daily as DY
from encore.operators import insights as I
from encore.plans import dashboard as D
from encore.sources import fixtures as fx

AT = dt.date(2024, 1, 31)


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))


def same(daily, plays, users, days):
    for name in D.INSIGHTS:
        assert rows(D.run_daily_insight(name, daily, AT, days, 10, users)) == rows(D.run_insight(name, plays, AT, days, 10, users)), (name, days)
    assert rows(D.daily_summary(daily, AT, days, users=users)) == rows(D.insights_summary(plays, AT, days, users=users))


def test_three_windows_and_a_late_file(spark, tmp_dir):
    every, users = fx.plays(spark, SF001), fx.users(spark, SF001)
    late = (F.to_date("played_at_local").isin([dt.date(2024, 1, 4), dt.date(2024, 1, 20)])) & (F.col("event_id") % 3 == 0)
    first = every.filter(~late)
    daily = DY.read(spark, DY.build(first, f"{tmp_dir}/d"))
    for days in (3, 14, 90):
        same(daily, first, users, days)
    hours = {f: f for f in daily.hours.inputFiles()}
    for _ in range(2):  # a second run changes nothing
        assert DY.update(every, f"{tmp_dir}/d", every.filter(late)) == [dt.date(2024, 1, 4), dt.date(2024, 1, 20)]
    daily = DY.read(spark, f"{tmp_dir}/d")
    untouched = [f for f in daily.hours.inputFiles() if "d=2024-01-04" not in f and "d=2024-01-20" not in f]
    assert untouched and set(untouched) <= set(hours)
    for days in (3, 14, 90):
        same(daily, every, users, days)
    assert DY.update(every, f"{tmp_dir}/d", every.limit(0)) == []
    with pytest.raises(ValueError, match="invalid insight"):
        D.run_daily_insight("nope", daily)


def test_windows_read_the_partials_days_only(spark, tmp_dir):
    daily = DY.read(spark, DY.build(fx.plays(spark, SF001), f"{tmp_dir}/d"))
    text = D.daily_summary(daily, AT, 7, users=fx.users(spark, SF001))._jdf.queryExecution().executedPlan().toString()
    assert "events.parquet" not in text and "/d/hours" in text and "/d/tracks" in text and "d#" in text.split("PartitionFilters: [", 1)[1][:60]


def test_sketches_of_a_hot_user(spark):
    plays = spark.range(300_000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('u', id % 50)) as user_id", "timestamp_ntz'2024-01-31 12:00:00' - make_interval(0, 0, 0, cast(id % 100 as int)) as played_at_local",
        "concat('t', if(id % 3 = 0, id, id % 977)) as track_id", "if(id % 1000 = 1, null, concat('a', id % 7919)) as artist_id", "'x' as artist_name", "12 as play_hour",
        "cast(id % 90 as int) as popularity")
    got = {(r.user_id, r.days_back): (r.tracks, r.artists) for r in DY.sketch_counts(DY.partials(plays), AT).collect()}
    exact = {}
    for days in DY.WINDOWS:
        for r in plays.filter(F.to_date("played_at_local") >= F.lit(AT) - F.expr(f"interval {days} days")).groupBy("user_id").agg(
                F.count_distinct("track_id").alias("t"), F.count_distinct("artist_id").alias("a")).collect():
            exact[r.user_id, days] = (r.t, r.a)
    assert set(exact) <= set(got) and exact["hot", 90][0] > 80_000
    for k, (t, a) in got.items():
        et, ea = exact.get(k, (0, 0))
        assert abs(t - et) <= DY.ERROR_BOUND * et + 0.5 and abs(a - ea) <= DY.ERROR_BOUND * ea + 0.5, k


def test_empty_plays(spark):
    none = DY.partials(fx.plays(spark, SF001).limit(0))
    assert none.hours.count() == 0 and DY.top_artists(none, AT).count() == 0 and DY.sketch_counts(none, AT).count() == 0


def test_weekly_evolution_with_a_pause(spark):
    days = ["2024-01-02", "2024-01-03", "2024-02-13", "2024-02-20", "2024-02-21", "2024-02-22"]
    plays = spark.createDataFrame([("u", d + " 10:00:00", "a") for d in days], "user_id string, t string, artist_id string").selectExpr(
        "user_id", "cast(t as timestamp_ntz) as played_at_local", "artist_id")
    got = [tuple(r)[1:] for r in D.weekly_evolution(plays).orderBy("week_start").collect()]
    assert got == [(dt.date(2024, 1, 1), 2, 1, None, None), (dt.date(2024, 2, 12), 1, 1, 1, None), (dt.date(2024, 2, 19), 3, 1, 2, 200.0)]


def test_times_with_any_fraction(spark):
    from encore.functions.time import parse_utc
    texts = ["2024-01-10T03:46:02Z", *(f"2024-01-10T03:46:02.{'123456'[:n]}Z" for n in range(1, 7)), "2024-01-10T03:46:02.123+02", "2024-01-10", "10:00", "bad", None,
             "2024-01-10T03:46:02.Z", "2024-01-10T03:46:02.1234567Z", "2024-01-10 03:46:02"]
    got = [r.x for r in spark.createDataFrame([(t,) for t in texts], "t string").select(F.date_format(parse_utc("t"), "HH:mm:ss.SSSSSS").alias("x")).collect()]
    assert got == ["03:46:02.000000", *(f"03:46:02.{'123456'[:n].ljust(6, '0')}" for n in range(1, 7)), "01:46:02.123000", None, None, None, None, None, None, None]


def test_catalog_run_report(spark, tmp_dir):
    from encore.plans import jobs
    spark.createDataFrame([("a", "A", 85, 1, ["pop"]), (None, "B", 1, 1, []), ("c", "C", 10, 2, ["rock"])],
                          "id string, name string, popularity int, followers bigint, genres array<string>").write.json(f"{tmp_dir}/in")
    run = jobs.run_catalog_job(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", multi_line=False)
    r = run.report.first()
    assert (r.status, r.original_records, r.processed_records, r.dropped_records, r.partitions, r.files) == ("processed", 3, 2, 1, 2, 2) and r.duration_seconds > 0
    assert run.table.count() == 2
