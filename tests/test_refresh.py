"""Refreshed reports equal the full ones after every append."""

import os

import pytest
from pyspark.sql import functions as F

from souk.plans import customers as C
from souk.plans import refresh
from souk.plans import revenue as R
from souk.sources.proxies import DirtyRetail
from tests.conftest import SF0001


@pytest.fixture()
def retail(spark):
    """With orders without a date and customers without a person."""
    return DirtyRetail(spark, SF0001)


def parts(df, n, count=3):
    return df.filter(F.col("order_id") % count == n)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def check(states, r, seen):
    orders, items = (df.filter((F.col("order_id") % 3).isin(seen))
                     for df in (r.orders, r.order_items))
    assert rows(states.monthly_revenue_trend()) == rows(R.monthly_revenue_trend(orders, items))
    assert rows(states.repeat_rate(r.customers, min_orders=5)) == \
        rows(C.repeat_rate(orders, r.customers, min_orders=5))
    assert rows(states.churn(r.customers, cutoff="1997-01-01")) == \
        rows(C.churn(orders, r.customers, cutoff="1997-01-01"))


def test_three_appends(spark, tmp_dir, retail):
    states = refresh.ReportStates(spark, tmp_dir)
    with pytest.raises(FileNotFoundError):
        states.monthly_revenue_trend()
    for n in range(3):
        states.add(n + 1, parts(retail.orders, n), parts(retail.order_items, n))
        check(states, retail, list(range(n + 1)))


def test_a_refresh_reads_states_only(spark, tmp_dir, retail):
    states = refresh.ReportStates(spark, tmp_dir)
    for n in range(3):
        states.add(n + 1, parts(retail.orders, n), parts(retail.order_items, n))
    files = states.monthly_revenue_trend().inputFiles()
    assert files and all(f"{tmp_dir}/state/months/batch=" in f for f in files)
    months = states.read(refresh.MONTHS)
    assert months.count() == R.monthly_revenue(retail.orders, retail.order_items).count()


def test_compacted_states(spark, tmp_dir, retail):
    states = refresh.ReportStates(spark, tmp_dir)
    for n in range(2):
        states.add(n + 1, parts(retail.orders, n), parts(retail.order_items, n))
    states.compact()
    assert states.published() == [-2]
    check(states, retail, [0, 1])
    states.add(3, parts(retail.orders, 2), parts(retail.order_items, 2))
    assert states.published() == [-2, 3]
    check(states, retail, [0, 1, 2])
    states.compact()
    states.compact()
    assert states.published() == [-3]
    check(states, retail, [0, 1, 2])
    with pytest.raises(ValueError):
        states.add(2, retail.orders, retail.order_items)
    with pytest.raises(ValueError):
        states.add(0, retail.orders, retail.order_items)


def test_replays_and_failures_count_once_or_not(spark, tmp_dir, retail, monkeypatch):
    states = refresh.ReportStates(spark, tmp_dir)
    states.add(1, parts(retail.orders, 0), parts(retail.order_items, 0))
    states.add(1, parts(retail.orders, 0), parts(retail.order_items, 0))
    check(states, retail, [0])

    def crash(batch, upto):
        raise RuntimeError("lost driver")
    monkeypatch.setattr(states, "_publish", crash)
    with pytest.raises(RuntimeError):
        states.add(2, parts(retail.orders, 1), parts(retail.order_items, 1))
    with pytest.raises(RuntimeError):
        states.add(3, parts(retail.orders, 2), parts(retail.order_items, 2))
    check(states, retail, [0])
    monkeypatch.undo()
    states.add(2, parts(retail.orders, 1), parts(retail.order_items, 1))
    assert os.path.isdir(os.path.join(tmp_dir, "state", "months", "batch=3"))
    check(states, retail, [0, 1])


def test_an_empty_batch(spark, tmp_dir, retail):
    states = refresh.ReportStates(spark, tmp_dir)
    states.add(1, retail.orders.limit(0), retail.order_items.limit(0))
    assert states.monthly_revenue_trend().count() == 0
    states.add(2, parts(retail.orders, 1), parts(retail.order_items, 1))
    check(states, retail, [1])
