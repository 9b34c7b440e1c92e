"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (all rows computed,
nothing collected); the best of ``$BENCH_REPEAT`` runs is reported. Prints ONE
JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "c05_insights_summary", "a01_top_artists", "a02_hourly_pattern", "a03_weekday_weekend",
    "a04_popularity_distribution", "c07_executive_summary", "c01_plays_etl", "a17_quality_report",
    "m01_user_features", "m06_profile_assignment", "c09_profile_service", "g02_artist_catalog",
    "w06_top_by_range", "j06_rank_comparison", "c10_recents_card", "c11_weekly_evolution", "s18_sync_ledger",
    "m03_robust_scaling",
]

# slower paths, run once each: K-means, the full profile pipeline, the stream, the per-user sink
ONCE = ["m04_kmeans", "c08_profiles_end_to_end", "z02_stream_batch_equivalence", "s10_per_user_sink"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from encore.plans.registry import load_all
    from encore.session import build_session

    # spark.checkpoint.dir: taken from the session config when given; only an unset
    # folder in local mode gets a scratch folder (encore.session.checkpoint_dir)
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8), app_name="encore-bench",
                          extra={"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m"})
    reg = load_all()
    names = only or HEADLINE + ONCE

    # warm-up: JVM, parquet footers, codegen caches
    reg["a23_plays_per_user"].build(spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for name in names:
        best = float("inf")
        for _ in range(1 if name in ONCE else repeat):
            t0 = time.perf_counter()
            reg[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - t0)
        timings[name] = round(best, 3)

    oracle: dict[str, float] = {}
    if os.environ.get("BENCH_ORACLE") == "1":
        # single-node comparison point: the same queries' DuckDB oracle SQL on the same files
        import duckdb

        from encore.sources.tables import DRIVER_TABLES, table_path
        con = duckdb.connect()
        for t in DRIVER_TABLES:
            con.execute(f"create view {t} as select * from read_parquet('{table_path(sf_dir, t)}')")
        for name in names:
            sql = reg[name].sql
            if not sql:
                continue
            best = float("inf")
            for _ in range(repeat):
                t0 = time.perf_counter()
                con.execute(sql).fetchall()
                best = min(best, time.perf_counter() - t0)
            oracle[name] = round(best, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(t for n, t in timings.items() if n not in ONCE), 3),
        "unit": "sec",
        "queries": timings,
        "once_total": round(sum(t for n, t in timings.items() if n in ONCE), 3),
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeat": repeat,
    }
    if oracle:
        out["duckdb_oracle"] = oracle
        out["duckdb_oracle_total"] = round(sum(oracle.values()), 3)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
