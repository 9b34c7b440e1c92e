"""Every registered query against its DuckDB oracle at sf0.01 (what the driver checks)."""

import pytest

from conftest import SF001, SF01
from encore.plans.registry import load_all
from oracle_harness import compare, duck

REG = load_all()
WITH_SQL = sorted(n for n, q in REG.items() if q.sql)
ROWS_ONLY = sorted(n for n, q in REG.items() if not q.sql)


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_matches_oracle(spark, con, name):
    problems, ns, nd = compare(spark, con, REG[name].build, REG[name].sql, SF01)
    assert not problems, problems
    assert ns == nd


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_queries_run(spark, name):
    df = REG[name].build(spark, SF001)
    assert df.count() > 0
