"""Exact ranks and bands against sorted lists; money sums; hot orders."""

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from souk.functions import money_sum
from souk.operators.ranks import ntile, ranked
from souk.plans.insights import common
from souk.plans.insights import experience as X
from souk.plans.insights import segments as SG


def bands_of(n, k):
    """Sizes differ by one at most, larger ones first."""
    return [b + 1 for b in range(k) for _ in range(n // k + (b < n % k))]


def key(x):
    """Spark's order: null, numbers, NaN."""
    return (x is not None, x is not None and math.isnan(x), 0.0 if x is None or x != x else x)


def test_ranks_in_groups(spark):
    rnd = random.Random(1)
    odd = [None, math.nan, math.inf, -math.inf, 0.0, 5e-324]
    rows = [(g, rnd.choice([*odd, rnd.random(), 2.0]), i)
            for i, g in enumerate(rnd.choices(["a", "b", None], [6, 1, 3], k=900))]
    rows.append(("alone", 1.0, 1000))
    df = spark.createDataFrame(rows, "g string, v double, id long").repartition(7)
    got = {r.id: (r["rank"], r.group_rows, r.band) for r in
           ranked(df, "g", ["v", "id"]).withColumn("band", ntile("rank", "group_rows", 7)).collect()}
    for g in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: (key(r[1]), r[2]))
        assert [got[r[2]] for r in mine] == \
            list(zip(range(len(mine)), [len(mine)] * len(mine), bands_of(len(mine), 7)))
    assert ranked(df.limit(0), "g", ["v", "id"]).count() == 0


@pytest.mark.parametrize("bands", [1, 4, 5])
def test_a_million_rows_of_one_group(spark, bands):
    """Nine in ten rows share one value; ties are split by id."""
    n = 1_000_003
    df = spark.range(n).select(
        "id", F.when(F.col("id") % 10 != 0, F.lit(7.0)).otherwise(F.col("id").cast("double"))
        .alias("v"), F.lit(0).alias("g"))
    got = ranked(df, "g", ["v", "id"]).withColumn("band", ntile("rank", "group_rows", bands))
    sizes = {r.band: r["count"] for r in got.groupBy("band").count().collect()}
    assert sizes == {b + 1: n // bands + (b < n % bands) for b in range(bands)}
    s = got.agg(F.count_distinct("rank"), F.min("rank"), F.max("rank")).first()
    assert tuple(s) == (n, 0, n - 1)


def test_ranking_spreads_one_group_over_many_tasks(spark):
    df = spark.range(100_000).select("id", F.lit(1).alias("g"), F.lit(2.0).alias("v"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ranked(df, "g", ["v", "id"])
        sizes = got.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 25_000


def test_rfm_scores_are_fifths(spark):
    """Equal values fall into different bands by person; undated persons come last."""
    import datetime as dt
    orders = spark.createDataFrame(
        [(i, i, None if i == 9 else dt.datetime(2020, 1, 1 + i % 3)) for i in range(10)],
        "order_id long, customer_id long, order_purchase_timestamp timestamp_ntz")
    customers = spark.createDataFrame([(i, f"p{i}") for i in range(10)],
                                      "customer_id long, customer_unique_id string")
    items = spark.createDataFrame([(i, 5.0) for i in range(0, 10, 2)],
                                  "order_id long, price double")
    got = {r.customer_unique_id: r for r in SG.rfm_scores(orders, items, customers).collect()}
    by_day = sorted(range(10), key=lambda i: (i != 9, i % 3, i))
    by_money = sorted(range(10), key=lambda i: (5.0 if i % 2 == 0 else 0.0, i))
    for scores, order in (("r_score", by_day), ("f_score", range(10)), ("m_score", by_money)):
        assert [got[f"p{i}"][scores] for i in order] == bands_of(10, 5), scores
    assert got["p9"].recency is None and got["p2"].monetary == 5.0


def test_infinite_payments(spark):
    """Values that no range can be cut around: each report ends."""
    pay = spark.createDataFrame(
        [(1, "a", 1, 1.0), (2, "a", 2, math.inf), (3, "a", 1, -math.inf), (4, "a", 3, 5e-324),
         (5, "a", 3, math.nan), (6, "a", 3, None), (7, "b", 1, math.inf)],
        "order_id long, payment_type string, payment_installments int, payment_value double")
    assert {r.payment_type: r.median_value for r in X.payment_vs_value(pay).collect()} == \
        {"a": 5e-324, "b": math.inf}
    got = {r.value_band: (r.payments, r.min_value, r.max_value)
           for r in X.installments_by_value(pay, bands=4).collect()}
    assert got == {1: (2, -math.inf, 5e-324), 2: (1, 1.0, 1.0), 3: (1, math.inf, math.inf),
                   4: (1, math.inf, math.inf)}


def test_money_sums(spark):
    def cents(values):
        df = spark.createDataFrame([(v,) for v in values], "p double").repartition(3)
        return df.agg(money_sum("p")).first()[0]
    rnd = random.Random(2)
    prices = [round(rnd.uniform(-500, 9000), 2) for _ in range(4000)]
    assert cents(prices) == sum(Decimal(str(p)) for p in prices) * 100
    assert cents([1e12, 1e12, 0.01]) == Decimal("200000000000001")
    assert cents([1e-6] * 5 + [-1e-6]) == Decimal("0.0004")
    assert cents([2.5, math.nan, math.inf, -math.inf, 1e300, None]) == 250
    assert cents([None]) is None


def test_an_order_with_a_third_of_all_items(spark):
    items = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("order_id"),
        (F.col("id") % 40).alias("product_id"), (F.col("id") % 11).alias("seller_id"))
    products = spark.range(40).select(F.col("id").alias("product_id"), F.when(
        F.col("id") % 4 != 3, F.concat(F.lit("c"), F.col("id") % 4))
        .alias("product_category_name"))
    cats = common.order_categories(items, products)
    assert cats.count() == 60_000 + 4
    assert sorted(r.category for r in cats.filter("order_id = 0").collect()) == \
        ["Misc", "c0", "c1", "c2"]
    assert common.order_sellers(items).filter("order_id = 0").count() == 11
