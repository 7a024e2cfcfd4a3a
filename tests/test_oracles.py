"""Every registered query: against DuckDB where SQL can say it, else that it runs and returns rows."""

import oracle
import pytest

from premisa.catalog import QUERIES, SQL


def test_compare_sees_differences(spark, duck, sf):
    df = "select 1 as a, 2.5 as b union all select 2, 3.5"
    assert oracle.compare(spark, duck, lambda s, d: s.sql(df), df, sf) is None
    assert oracle.compare(spark, duck, lambda s, d: s.sql(df), df.replace("3.5", "3.6"), sf)
    assert oracle.compare(spark, duck, lambda s, d: s.sql(df), df.replace("as b", "as c"), sf)
    assert oracle.compare(spark, duck, lambda s, d: s.sql(df), df + " union all select 2, 3.5", sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, sf, name):
    assert oracle.compare(spark, duck, QUERIES[name], SQL[name], sf) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf, name):
    df = QUERIES[name](spark, sf)
    assert len(df.columns) == len(set(df.columns))
    assert df.count() > 0
