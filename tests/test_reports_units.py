"""Hand-made cases for the report quirks (FIXTURES.md §5) and properties."""

import datetime as dt

from pyspark.sql import functions as F

from souk.plans import customers as C
from souk.plans import logistics as L
from souk.plans import revenue as R
from souk.sources.proxies import Retail
from tests.conftest import SF001

T = dt.datetime

ORD = ("order_id long, customer_id long, order_status string, "
       "order_purchase_timestamp timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
       "order_delivered_customer_date timestamp_ntz")
CUST = ("customer_id long, customer_unique_id long, customer_zip_code_prefix string, "
        "customer_city string, customer_state string")
ITEMS = "order_id long, product_id long, price double"
GEO = "geolocation_zip_code_prefix string, geolocation_city string"


def orders(spark, rows):
    return spark.createDataFrame(rows, ORD)


def test_geolocation_fanout_faithful_vs_corrected(spark):
    # one order; its zip has two geolocation rows of the same city
    o = orders(spark, [(1, 10, "delivered", T(2020, 1, 1), None, None)])
    c = spark.createDataFrame([(10, 100, "00001", "x", "S")], CUST)
    g = spark.createDataFrame([("00001", "CITY_A"), ("00001", "CITY_A")], GEO)
    f = C.repeat_by_city(o, c, g, min_customers=0).collect()
    assert [(r.customer_city, r.total_customers, r.repeat_customers) for r in f] == \
        [("CITY_A", 1, 1)]
    k = C.repeat_by_city(o, c, g, min_customers=0, faithful=False).collect()
    assert [(r.total_customers, r.repeat_customers) for r in k] == [(1, 0)]


def test_two_addresses_match_in_both_states(spark):
    o = orders(spark, [(1, 10, "delivered", T(2020, 1, 1), None, None),
                       (2, 10, "delivered", T(2020, 2, 1), None, None),
                       (3, 11, "delivered", T(2020, 3, 1), None, None)])
    c = spark.createDataFrame([(10, 100, "1", "a", "S1"), (11, 100, "2", "b", "S2")], CUST)
    f = {r.customer_state: (r.total_customers, r.repeat_customers)
         for r in C.repeat_by_state(o, c).collect()}
    assert f == {"S1": (1, 1), "S2": (1, 1)}
    k = {r.customer_state: (r.total_customers, r.repeat_customers)
         for r in C.repeat_by_state(o, c, faithful=False).collect()}
    assert k == {"S1": (1, 1), "S2": (1, 0)}


def test_items_vs_orders(spark):
    o = orders(spark, [(1, 10, "delivered", T(2020, 1, 1), None, None)])
    c = spark.createDataFrame([(10, 100, "1", "a", "S")], CUST)
    i = spark.createDataFrame([(1, 5, 10.0), (1, 6, 30.0)], ITEMS)
    assert C.aov_overall(o, i, c).first()[0] == 20.0
    assert C.aov_overall(o, i, c, faithful=False).first()[0] == 40.0


def test_delivery_day_boundary_and_integer_average(spark):
    c = spark.createDataFrame([(10, 100, "1", "a", "S")], CUST)
    o = orders(spark, [(1, 10, "delivered", T(2020, 1, 1), T(2020, 1, 1, 23, 59),
                        T(2020, 1, 2, 0, 1)),
                       (2, 10, "delivered", T(2020, 1, 1), T(2020, 1, 1), T(2020, 1, 3))])
    r = L.delivery_by_city(o, c, min_orders=0).first()
    assert (r.delivery_time, r.order_count) == (1, 2)   # (1 + 2) / 2 truncated
    assert L.delivery_by_city(o, c, min_orders=0, exact=True).first().delivery_time == 1.5


def test_unmapped_category(spark):
    i = spark.createDataFrame([(1, 1, 10.0), (1, 2, 20.0), (2, 3, 5.0)], ITEMS)
    p = spark.createDataFrame([(1, "A"), (2, None), (3, "Z")],
                              "product_id long, product_category_name string")
    names = spark.createDataFrame([("A", "a_en")], "product_category_name string, "
                                  "product_category_name_english string")
    f = R.category_revenue(i, p, names).collect()
    assert [(r.product_category_name, r.total_revenue, r.revenue_percentage,
             r.number_of_orders) for r in f] == [("a_en", 10.0, 28.57, 1)]
    k = {r.product_category_name: r.total_revenue
         for r in R.category_revenue(i, p, names, keep_unmapped=True).collect()}
    assert k == {"a_en": 10.0, "Misc": 20.0, "Z": 5.0}


def test_running_total_resets_each_year(spark):
    o = orders(spark, [(1, 10, "x", T(2019, 12, 5), None, None),
                       (2, 10, "x", T(2020, 1, 5), None, None),
                       (3, 10, "x", T(2020, 2, 5), None, None)])
    i = spark.createDataFrame([(1, 1, 1.5), (2, 1, 2.25), (3, 1, 4.0)], ITEMS)
    got = [(r.month_label, r.total_revenue, r.running_total_revenue)
           for r in R.monthly_revenue_trend(o, i).collect()]
    assert got == [("2019-12", 1.5, 1.5), ("2020-01", 2.25, 2.25), ("2020-02", 4.0, 6.25)]


def test_churn_edges_and_empty_denominator(spark):
    c = spark.createDataFrame([(10, 100, "1", "a", "S"), (11, 101, "1", "a", "S"),
                               (12, 102, "1", "a", "S")], CUST)
    o = orders(spark, [(1, 10, "x", T(2020, 1, 1), None, None),   # last on cutoff day
                       (2, 10, "x", T(2019, 5, 1), None, None),
                       (3, 11, "x", T(2020, 1, 1, 8), None, None),  # first on cutoff
                       (4, 12, "x", T(2019, 3, 1), None, None)])  # churned
    r = C.churn(o, c, cutoff="2020-01-01").first()
    assert (r.Churned_Customers, r.Eligible_Customers, r.Churn_Rate) == (1, 2, 50.0)
    r0 = C.churn(o, c, cutoff="2000-01-01").first()
    assert (r0.Churned_Customers, r0.Eligible_Customers, r0.Churn_Rate) == (0, 0, None)
    over = C.churn_over_time(o, c, ["2000-01-01", "2020-01-01", "2021-01-01"]).collect()
    assert [(r.Churned_Customers, r.Eligible_Customers) for r in over] == \
        [(0, 0), (1, 2), (3, 3)]


def test_properties_on_test_data(spark):
    r = Retail(spark, SF001)
    # running total of December equals the year's sum
    trend = R.monthly_revenue_trend(r.orders, r.order_items)
    yearly = trend.groupBy("order_year").agg(F.round(F.sum("total_revenue"), 2).alias("s"),
                                             F.max("running_total_revenue").alias("m"))
    assert yearly.filter(F.abs(F.col("s") - F.col("m")) > 0.01).count() == 0
    ch = C.churn(r.orders, r.customers, cutoff="2001-01-01").first()
    assert ch.Churned_Customers <= ch.Eligible_Customers
    assert (ch.Churned_Customers, ch.Eligible_Customers, ch.Churn_Rate) == (120, 750, 16.0)


def test_repeat_by_city_equals_plain_fanout_join(spark):
    """The pre-aggregated plan gives the same numbers as the literal
    many-to-many join of the reference."""
    r = Retail(spark, SF001)
    for name, df in {"orders": r.orders, "customers": r.customers,
                     "geolocation": r.geolocation}.items():
        df.createOrReplaceTempView(f"t_{name}")
    plain = spark.sql("""
      WITH rc AS (
        SELECT c.customer_unique_id, g.geolocation_city AS customer_city, count(o.order_id) n
        FROM t_orders o JOIN t_customers c ON o.customer_id = c.customer_id
        JOIN t_geolocation g ON c.customer_zip_code_prefix = g.geolocation_zip_code_prefix
        GROUP BY 1, 2 HAVING count(o.order_id) > 1),
      ac AS (SELECT DISTINCT c.customer_unique_id, g.geolocation_city AS customer_city
        FROM t_customers c
        JOIN t_geolocation g ON c.customer_zip_code_prefix = g.geolocation_zip_code_prefix)
      SELECT ac.customer_city, count(ac.customer_unique_id) AS total_customers,
             count(rc.customer_unique_id) AS repeat_customers
      FROM ac LEFT JOIN rc ON rc.customer_unique_id = ac.customer_unique_id
      GROUP BY ac.customer_city""")
    mine = C.repeat_by_city(r.orders, r.customers, r.geolocation, min_customers=0) \
        .select("customer_city", "total_customers", "repeat_customers")
    assert sorted(plain.collect()) == sorted(mine.collect())
