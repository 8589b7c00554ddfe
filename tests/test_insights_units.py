"""Hand-made cases for the extension analyses (brute-force expectations)."""

import datetime as dt

from souk.plans.insights import experience as X
from souk.plans.insights import operations as OP
from souk.plans.insights import segments as SG

T = dt.datetime
ORD = ("order_id long, customer_id long, order_status string, "
       "order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
       "order_delivered_carrier_date timestamp_ntz, "
       "order_delivered_customer_date timestamp_ntz, "
       "order_estimated_delivery_date timestamp_ntz")
ITEMS = "order_id long, product_id long, seller_id long, price double, quantity double"
PRODUCTS = "product_id long, product_category_name string"


def test_weekend_holiday_classification(spark):
    rows = [  # 2020-12-25 is a Friday and a holiday, 26th Saturday, 28th Monday
        (1, 1, "delivered", T(2020, 12, 25), None, None, T(2020, 12, 30), T(2020, 12, 29)),
        (2, 1, "delivered", T(2020, 12, 26), None, None, T(2020, 12, 28), T(2020, 12, 29)),
        (3, 1, "delivered", T(2020, 12, 28), None, None, T(2021, 1, 2), T(2021, 1, 1)),
        (4, 1, "shipped", T(2020, 12, 28), None, None, None, T(2021, 1, 1))]
    got = {r.day_type: (r.orders, r.avg_delivery_days, r.avg_delay_days, r.late_share)
           for r in X.weekend_holiday_delay(spark.createDataFrame(rows, ORD)).collect()}
    assert got == {"holiday": (1, 5.0, 1.0, 100.0), "weekend": (1, 2.0, -1.0, 0.0),
                   "weekday": (1, 5.0, 1.0, 100.0)}


def test_basket_pairs_with_a_huge_order(spark):
    items = [(1, 10, 1, 1.0, 1.0), (1, 20, 1, 1.0, 1.0),                  # {A, B}
             (2, 10, 1, 1.0, 1.0), (2, 20, 1, 1.0, 1.0), (2, 30, 1, 1.0, 1.0),  # {A,B,C}
             (3, 30, 1, 1.0, 1.0)]                                          # {C}
    items += [(4, 10 if i % 2 else 30, 1, 1.0, 1.0) for i in range(5000)]  # {A, C}, huge
    prods = [(10, "A"), (20, "B"), (30, "C")]
    got = {(r.category_a, r.category_b): (r.orders, r.support, r.lift) for r in
           SG.basket_pairs(spark.createDataFrame(items, ITEMS),
                           spark.createDataFrame(prods, PRODUCTS)).collect()}
    # 4 orders; A in 3, B in 2, C in 3
    assert got == {("A", "B"): (2, 0.5, round(2 * 4 / (3 * 2), 6)),
                   ("A", "C"): (2, 0.5, round(2 * 4 / (3 * 3), 6)),
                   ("B", "C"): (1, 0.25, round(1 * 4 / (2 * 3), 6))}
    sets = SG.category_sets(spark.createDataFrame(items, ITEMS),
                            spark.createDataFrame(prods, PRODUCTS))
    assert sets.count() == 4            # one row per distinct set, not per order


def test_installment_value_bands(spark):
    pay = spark.createDataFrame(
        [(i, "x", inst, v) for i, (v, inst) in
         enumerate([(0.0, 1), (25.0, 2), (50.0, 1), (75.0, 3), (100.0, 4)])],
        "order_id long, payment_type string, payment_installments int, payment_value double")
    got = {r.value_band: (r.payments, r.multi_installment_share)
           for r in X.installments_by_value(pay).collect()}
    # quartile edges 25, 50, 75: an edge belongs to the band below it
    assert got == {1: (2, 50.0), 2: (1, 0.0), 3: (1, 100.0), 4: (1, 100.0)}


def test_seller_retention_month_end(spark):
    orders = spark.createDataFrame([
        (1, 1, "x", T(2020, 1, 31), None, None, None, None),
        (2, 1, "x", T(2020, 7, 30), None, None, None, None),   # add_months -> 07-31
        (3, 1, "x", T(2020, 1, 31), None, None, None, None),
        (4, 1, "x", T(2020, 7, 31), None, None, None, None)], ORD)
    items = spark.createDataFrame([(1, 1, 100, 1.0, 1.0), (2, 1, 100, 1.0, 1.0),
                                   (3, 1, 200, 1.0, 1.0), (4, 1, 200, 1.0, 1.0)], ITEMS)
    r = OP.seller_retention(orders, items).first()
    assert (r.sellers, r.retained_sellers, r.dropped_sellers, r.retention_rate) == \
        (2, 1, 1, 50.0)


def test_forecast_continues_a_straight_line(spark):
    months = [(i, T(2020, 1 + i, 15)) for i in range(6)]          # Jan .. Jun 2020
    orders = spark.createDataFrame(
        [(i, 1, "x", ts, None, None, None, None) for i, ts in months], ORD)
    items = spark.createDataFrame(
        [(i, 1, 1, 100.0 + 10.0 * i, 1.0) for i, _ in months], ITEMS)
    got = [(r.month_index, r.month_label, r.forecast_revenue)
           for r in SG.revenue_forecast(orders, items).orderBy("month_index").collect()]
    assert got == [(6, "2020-07", 160.0), (7, "2020-08", 170.0), (8, "2020-09", 180.0)]


def _curve(spark, spans, quiet):
    """(who, first month, last month) of 2000, to the rows of the curve."""
    rows = [(w, T(2000 + m // 12, 1 + m % 12, 15)) for w, a, b in spans for m in (a, b)]
    df = spark.createDataFrame(rows + [(None, T(2009, 1, 1)), ("x", None)],
                               "who string, d timestamp_ntz").repartition(4)
    return {r.months_since_first: (r.at_risk, r.dropped, r.censored, r.retained_share)
            for r in OP.retention_curve(df, "who", quiet).collect()}


def test_retention_curve_by_hand(spark):
    """Data end in month 11; whoever was last seen in month 6 or later is censored."""
    spans = [("a", 0, 0), ("b", 0, 3), ("c", 2, 5), ("d", 0, 11), ("e", 8, 11), ("f", 10, 10)]
    assert _curve(spark, spans, 6) == {
        0: (6, 1, 1, round(5 / 6, 6)),             # a dropped; f began too late to tell
        3: (4, 2, 1, round(5 / 6 * 2 / 4, 6)),     # b and c dropped, e censored
        11: (1, 0, 1, round(5 / 6 * 2 / 4, 6))}


def test_retention_curve_by_risk_sets(spark):
    import random
    rnd = random.Random(9)
    spans = []
    for i in range(300):
        first = rnd.randrange(60)
        spans.append((f"w{i}", first, min(first + int(rnd.expovariate(1 / 15)), 60)))
    end = max(b for _, _, b in spans)
    share, want = 1.0, {}
    for t in sorted({b - a for _, a, b in spans}):
        here = [end - b >= 4 for _, a, b in spans if b - a == t]
        risk = sum(b - a >= t for _, a, b in spans)
        share *= 1 - sum(here) / risk
        want[t] = (risk, sum(here), len(here) - sum(here), round(share, 6))
    assert _curve(spark, spans, 4) == want


def test_retention_curve_of_nobody_and_of_one(spark):
    assert _curve(spark, [], 6) == {}
    assert _curve(spark, [("a", 3, 3)], 6) == {0: (1, 0, 1, 1.0)}
