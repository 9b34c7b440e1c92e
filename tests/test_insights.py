"""Category insights (A02-A05, C05/C07 aggregates) against a brute-force Python computation on edge cases:
NULL popularity, NULL artist, plays after as_of (lower bound only, T24), users with only old plays, window edges."""

import datetime as dt
import random

import pytest

from encore.operators import insights as I

AS_OF = dt.date(2024, 3, 31)
HOURLY, WEEKLY, POP = 7, 20, 15
TIERS = ("emergent", "growing", "established")


def _tier(p):
    return "emergent" if p <= 40 else "growing" if p <= 70 else "established"


def _mean(xs):
    return sum(xs) / len(xs) if xs else None


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    out = []
    for i in range(400):
        user = f"u{i % 7}"
        if user == "u6":                                  # only plays long before every window
            day = AS_OF - dt.timedelta(days=60 + i % 5)
        else:
            day = AS_OF + dt.timedelta(days=rnd.randint(-25, 3))   # includes window edges and future days
        ts = dt.datetime.combine(day, dt.time(rnd.randint(0, 23), rnd.randint(0, 59)))
        pop = None if rnd.random() < 0.15 else rnd.choice([0, 40, 41, 70, 71, 100, rnd.randint(0, 100)])
        artist = None if rnd.random() < 0.1 else f"A{rnd.randint(0, 6)}"
        out.append((user, ts, ts.hour, ts.isoweekday() % 7 + 1, pop, artist))
    return out


def _expected(rows):
    users = sorted({r[0] for r in rows})
    exp = {}
    for u in users:
        mine = [r for r in rows if r[0] == u]
        e = {"hourly": [sum(1 for r in mine if r[1].date() >= AS_OF - dt.timedelta(days=HOURLY) and r[2] == h)
                        for h in range(24)]}
        wk = [r for r in mine if r[1].date() >= AS_OF - dt.timedelta(days=WEEKLY)]
        for name, sel in (("weekday", [r for r in wk if r[3] not in (1, 7)]), ("weekend", [r for r in wk if r[3] in (1, 7)])):
            e[f"{name}_plays"] = len(sel)
            e[f"{name}_days"] = len({r[1].date() for r in sel})
            e[f"{name}_pop"] = _mean([r[4] for r in sel if r[4] is not None])
        pw = [r for r in mine if r[1].date() >= AS_OF - dt.timedelta(days=POP) and r[4] is not None]
        for t in TIERS:
            sel = [r for r in pw if _tier(r[4]) == t]
            e[f"{t}_plays"] = len(sel)
            e[f"{t}_artists"] = len({r[5] for r in sel if r[5] is not None})
            e[f"{t}_pop"] = _mean([r[4] for r in sel])
        exp[u] = e
    return exp


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return abs(a - b) < 1e-9


def test_category_aggregates_match_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "user_id string, played_at_local timestamp_ntz, play_hour int, "
                                     "play_day_of_week int, popularity int, artist_id string")
    got = {r.user_id: r.asDict() for r in I.user_category_aggregates(df, AS_OF, HOURLY, WEEKLY, POP).collect()}
    exp = _expected(rows)
    assert set(got) == set(exp)                                         # u6 (old plays only) is kept
    for u, e in exp.items():
        for k, v in e.items():
            if k.endswith("_pop"):
                assert _close(got[u][k], v), (u, k, got[u][k], v)
            else:
                assert list(got[u][k]) == v if k == "hourly" else got[u][k] == v, (u, k, got[u][k], v)
    assert got["u6"]["weekday_plays"] == 0 and got["u6"]["emergent_pop"] is None


def test_single_family_insights_match_combined(spark, rows):
    df = spark.createDataFrame(rows, "user_id string, played_at_local timestamp_ntz, play_hour int, "
                                     "play_day_of_week int, popularity int, artist_id string")
    exp = _expected(rows)
    week = {(r.user_id, r.day_type): r for r in I.weekday_weekend(df, AS_OF, WEEKLY).collect()}
    tiers = {(r.user_id, r.popularity_tier): r for r in I.popularity_distribution(df, AS_OF, POP).collect()}
    for u, e in exp.items():
        for n in ("weekday", "weekend"):
            assert week[(u, n)].play_count == e[f"{n}_plays"] and week[(u, n)].active_days == e[f"{n}_days"]
        for t in TIERS:
            assert tiers[(u, t)].play_count == e[f"{t}_plays"] and tiers[(u, t)].unique_artists == e[f"{t}_artists"]
            assert _close(tiers[(u, t)].avg_popularity, e[f"{t}_pop"] if e[f"{t}_pop"] is not None else 0.0)


def test_hours_sum_to_window_plays_and_shares_to_100(spark):
    from pyspark.sql import functions as F

    from conftest import SF01
    from encore.functions.time import in_trailing_window
    from encore.plans.oracle_views import AS_OF
    from encore.sources import fixtures as fx
    p = fx.plays(spark, SF01)
    hours = I.hourly_pattern(p, AS_OF, 30).groupBy("user_id").agg(F.sum("play_count").alias("h"))
    direct = p.groupBy("user_id").agg(F.count_if(in_trailing_window("played_at_local", AS_OF, 30)).alias("h"))
    assert hours.exceptAll(direct).count() == 0 and direct.exceptAll(hours).count() == 0
    for df in (I.weekday_weekend(p, AS_OF, 90), I.popularity_distribution(p, AS_OF, 90)):
        s = df.groupBy("user_id").agg(F.sum("percentage").alias("s"), F.sum("play_count").alias("n"))
        bad = s.filter((F.col("n") > 0) & (F.abs(F.col("s") - 100) > 1e-9)).count()
        assert bad == 0


def test_top_by_range_matches_brute_force(spark):
    """W06 on edge cases: NULL popularity, plays older than every range, rank ties broken by name."""
    from encore.plans import dashboard as D
    rnd = random.Random(9)
    ranges = {"short": 3, "long": 10}
    rows = []
    for i in range(300):
        day = AS_OF + dt.timedelta(days=rnd.randint(-14, 1))
        ts = dt.datetime.combine(day, dt.time(rnd.randint(0, 23)))
        pop = None if rnd.random() < 0.3 else rnd.randint(0, 100)
        rows.append((f"u{i % 4}", f"Artist {rnd.randint(0, 5)}", ts, pop))
    df = spark.createDataFrame(rows, "user_id string, artist_name string, played_at_local timestamp_ntz, popularity int")
    got = {(r.user_id, r.time_range, r.rank): (r.artist_name, r.play_count, r.popularity)
           for r in D.top_by_range(df, AS_OF, ranges, 2).collect()}
    exp = {}
    for u in sorted({r[0] for r in rows}):
        for name, days in ranges.items():
            sel = [r for r in rows if r[0] == u and r[2].date() >= AS_OF - dt.timedelta(days=days)]
            per = {}
            for r in sel:
                n, p = per.get(r[1], (0, None))
                per[r[1]] = (n + 1, p if r[3] is None else (r[3] if p is None else max(p, r[3])))
            ranked = sorted(per.items(), key=lambda kv: (-kv[1][0], kv[0]))[:2]
            for k, (artist, (n, p)) in enumerate(ranked, 1):
                exp[(u, name, k)] = (artist, n, p)
    assert got == exp
