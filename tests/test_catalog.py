"""Every registered query beside its SQL, on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as driver
from check_oracle import connect, rows

STATEMENTS = driver.oracle_sql()


@pytest.fixture(scope="module")
def engine(tables):
    return connect(tables)


def test_statements_belong_to_queries():
    assert set(STATEMENTS) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(name, spark, tables, engine):
    got = driver.queries()[name](spark, tables).toPandas()
    assert len(got) > 0
    if name in STATEMENTS:
        want = engine.sql(STATEMENTS[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == [
        "order_date", "total_orders", "gross_revenue", "refund_amount", "net_revenue", "mismatch_count"
    ]
    assert result.count() > 0
