import __spark_entry__ as entry_mod
from encore.plans.registry import load_all


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["user_id", "insight", "item", "position", "play_count", "distinct_count",
                          "avg_popularity", "percentage"]
    assert df.count() > 0


def test_contract_keys():
    q = entry_mod.queries()
    o = entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100
    for name in load_all():
        assert name[0] in "apjkuwmgcsz" and name[1:3].isdigit(), name
