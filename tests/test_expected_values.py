"""Expected values measured independently (FIXTURES.md §3, §4)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF0001, SF001

Q = E.queries()


def one(spark, key, root):
    return Q[key](spark, root).collect()


@pytest.mark.parametrize("root,aov,churn,rate", [
    (SF0001, 52889.790787, (17, 75, 22.67), (75, 1500, 5.0)),
    (SF001, 53085.648983, (120, 750, 16.0), (750, 15000, 5.0)),
])
def test_customer_reports(spark, root, aov, churn, rate):
    assert one(spark, "q_aov_overall", root)[0][0] == aov
    assert tuple(one(spark, "q_churn", root)[0]) == churn
    assert tuple(one(spark, "q_repeat_rate", root)[0]) == rate
    assert len(one(spark, "q_repeat_by_state", root)) == 25
    assert len(one(spark, "q_repeat_by_city", root)) == 0          # > 500 persons


def test_revenue_and_delivery_sf001(spark):
    small = [r for r in one(spark, "q_category_revenue", SF001)
             if r.product_category_name == "small_en"][0]
    assert (small.total_revenue, small.revenue_percentage, small.number_of_orders) == \
        (498401993.30, 15.66, 7005)
    m = one(spark, "q_monthly_revenue_trend", SF001)
    assert len(m) == 80
    assert (m[0].month_label, m[0].total_revenue) == ("1995-01", 41185859.66)
    assert m[1].running_total_revenue == 79577079.60
    d = one(spark, "q_delivery_by_city", SF001)
    assert (d[0].customer_city, d[0].delivery_time, d[0].order_count) == \
        ("NATION_6_BUILDING", 19, 27)
    assert len(one(spark, "q_repeat_by_city_all", SF001)) == 56


@pytest.mark.parametrize("root,rows,rej_a,rej_b", [
    (SF0001, 204, 27, 35), (SF001, 2038, 245, 314)])
def test_dirty_products(spark, root, rows, rej_a, rej_b):
    audit = one(spark, "etl_audit_row", root)[0]
    assert audit.rows_loaded + audit.rows_rejected == rows
    assert audit.rows_rejected == rej_a
    assert len(one(spark, "etl_error_flags_rows", root)) == rej_b
