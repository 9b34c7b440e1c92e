"""Results whose order is part of the answer (A18, A23, A24, J06, K02, K04, K06): checked as they are collected."""

import pytest

from conftest import SF001
from encore.plans.registry import load_all

REG = load_all()
LAST = 1 << 30
KEYS = {
    "a18_value_counts": lambda r: (-r["count"], r["artist_name"] is not None, r["artist_name"] or ""),
    "a23_plays_per_user": lambda r: (-r["plays"], r["user_id"]),
    "a24_likes_per_artist": lambda r: (-r["likes"], r["artists_id"]),
    "k02_result_ordering": lambda r: (-r["total_plays"], r["user_id"]),
    "k02_order_by_hour": lambda r: (r["user_id"], r["hour"]),
    "k02_order_by_popularity": lambda r: (r["user_id"], r["avg_popularity"], r["popularity_tier"]),
    "j06_rank_comparison": lambda r: (r["user_id"], LAST if r["rank_medium_term"] is None else r["rank_medium_term"], r["artist_name"]),
    "k04_nulls_last_sort": lambda r: (r["user_id"], LAST if r["rank_medium_term"] is None else r["rank_medium_term"], r["artist_name"]),
    "k06_partition_pruned_lookup": lambda r: (-r["followers"], r["id"]),
}


@pytest.mark.parametrize("name", sorted(KEYS))
def test_order(spark, name):
    rows = [r.asDict() for r in REG[name].build(spark, SF001).collect()]
    assert len(rows) > 1 and rows == sorted(rows, key=KEYS[name])


def test_default_ranges_have_no_lower_bound_for_all_history(spark):
    from encore.plans import dashboard as D
    plays = spark.sql("""select 'u' user_id, 'Old' artist_name, timestamp_ntz '2001-01-01 00:00:00' played_at_local, 5 popularity
                         union all select 'u', 'New', timestamp_ntz '2024-01-20 00:00:00', 6""")
    got = {(r.time_range, r.artist_name) for r in D.top_by_range(plays, "2024-01-31").collect()}
    assert got == {("long_term", "Old"), ("long_term", "New"), ("medium_term", "New"), ("short_term", "New")}
