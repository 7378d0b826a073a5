"""Every registered query of the engine runs; those with SQL give DuckDB's rows."""

import pytest

from pagestream.plans.queries import registered

from compare import assert_same


@pytest.mark.parametrize("name", [n for n, (_, sql) in registered.items() if sql])
def test_same_as_sql(spark, sf, duck, name):
    f, sql = registered[name]
    assert_same(f(spark, sf).toPandas(), duck.sql(sql).df())


@pytest.mark.parametrize("name", [n for n, (_, sql) in registered.items() if not sql])
def test_runs(spark, sf, name):
    assert registered[name][0](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 20
    assert set(e.oracle_sql()) <= set(e.queries())
