"""Every registered query against its DuckDB oracle on the smallest data set."""

import pytest

import __spark_entry__ as E
from oracle.catalog import ORACLE
from souk.catalog import QUERIES
from tests.compare import compare, duck
from tests.conftest import SF0001, SF001


def test_the_entry_has_them_all():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, con, key):
    ok, msg, _, _ = compare(spark, con, key, QUERIES[key], ORACLE[key], SF0001)
    assert ok, msg


def test_every_query_has_an_oracle_or_is_listed():
    rows_only = set(QUERIES) - set(ORACLE)
    assert not rows_only, rows_only


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["order_year", "order_month", "month_label",
                          "total_revenue", "running_total_revenue"]
    assert df.count() > 0


@pytest.mark.parametrize("key", ["q_repeat_by_city_all", "etl_validate_message",
                                 "q_category_revenue"])
def test_matches_oracle_sf001(spark, key):
    ok, msg, _, _ = compare(spark, duck(SF001), key, QUERIES[key], ORACLE[key], SF001)
    assert ok, msg


def test_outputs_have_clean_unique_columns(spark):
    for key, fn in QUERIES.items():
        cols = fn(spark, SF0001).columns
        assert len(set(cols)) == len(cols), key
        assert not any(c.startswith("_") for c in cols), (key, cols)
