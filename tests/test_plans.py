"""Physical-plan properties that matter at scale (not only at test size)."""

import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from souk.catalog import WRITING_KEYS as WRITERS
from tests.conftest import SF001

QUERIES = E.queries()


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {k: plan_of(fn(spark, SF001)) for k, fn in QUERIES.items() if k not in WRITERS}


def test_no_cartesian_products(plans):
    bad = [k for k, p in plans.items() if "CartesianProduct" in p]
    assert not bad, bad


def test_fact_scans_read_only_needed_columns(plans):
    """No query reads every column of lineitem or orders."""
    full_items = "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint," \
                 "l_linenumber:int,l_quantity:double,l_extendedprice:double," \
                 "l_discount:double,l_tax:double,l_returnflag:string,l_linestatus:string," \
                 "l_shipdate:timestamp_ntz>"
    bad = [k for k, p in plans.items() if full_items in p]
    assert not bad, bad
    assert "o_totalprice" not in plans["q_monthly_revenue_trend"]


def test_top_k_per_group_limits_before_the_shuffle(plans):
    for k in ("x_holiday_products", "x_top_sellers", "x_recommend"):
        assert "WindowGroupLimit" in plans[k], k


def test_global_top_k_never_sorts_everything(plans):
    for k in ("q_delivery_by_city", "x_slowest_sellers", "x_seller_rating"):
        assert "TakeOrderedAndProject" in plans[k], k


def test_duplicate_detection_has_no_per_key_window(plans):
    for k in ("etl_validate_message", "etl_validate_flags", "etl_customers", "etl_orders"):
        assert "Window" not in plans[k], k


def test_copies_within_an_order_go_before_the_shuffle(spark):
    """A partial aggregate stands below the first exchange by order, so an order
    with a third of all items is combined where it is read."""
    from souk.catalog import retail
    from souk.plans.insights import common
    r = retail(spark, SF001)
    for df, name in ((common.order_categories(r.order_items, r.products), "collect_set"),
                     (common.order_sellers(r.order_items), "HashAggregate")):
        plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
        shuffle = next(i for i, x in enumerate(plan) if "Exchange hashpartitioning(order_id" in x)
        above, below = "\n".join(plan[:shuffle]), "\n".join(plan[shuffle:])
        assert name in above and ("partial_collect_set" in below if name == "collect_set"
                                  else name in below), plan


def test_nested_loop_joins_only_against_tiny_sides(plans):
    """BroadcastNestedLoopJoin appears only where one side is a one-row global
    aggregate or a driver-built list (cutoffs); never between two tables."""
    allowed = {"q_churn_over_time", "x_delay_vs_review", "x_basket_pairs",
               "x_payment_mix", "x_installments_by_value", "x_rfm", "x_forecast",
               "x_satisfaction_index", "x_recommend", "q_category_revenue",
               "q_category_revenue_unmapped", "q_category_revenue_dirty"}
    bad = [k for k, p in plans.items() if "BroadcastNestedLoopJoin" in p and k not in allowed]
    assert not bad, bad


def test_hot_null_key_is_split_by_aqe(spark, tmp_dir):
    """A third of the rows share the NULL key; with a shuffle join AQE cuts
    that partition instead of giving it to one task."""
    from souk.operators.dedupe import flag_duplicates
    path = os.path.join(tmp_dir, "skewed")
    spark.range(1_500_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None))
        .otherwise((F.col("id") % 250_000).cast("string")).alias("product_id"),
        (F.col("id") % 7).alias("v")).write.parquet(path)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512KB"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = flag_duplicates(spark.read.parquet(path), ["product_id"], "dup")
        agg = out.groupBy(F.col("product_id").isNull().alias("null_id"), "dup").count()
        got = {(r.null_id, r.dup): r["count"] for r in agg.collect()}
        final = agg._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got == {(True, False): 1, (True, True): 499_999,
                   (False, False): 250_000, (False, True): 750_000}
    assert "SortMergeJoin(skew=true)" in final


def test_bounded_broadcast_hints_only_under_the_bound(spark):
    from souk.operators.joins import bounded_broadcast
    big = spark.range(1000).withColumnRenamed("id", "k")
    small = spark.range(10).withColumnRenamed("id", "k")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # no automatic broadcast
    try:
        under = plan_of(big.join(bounded_broadcast(small, max_rows=20), "k"))
        over = plan_of(big.join(bounded_broadcast(small, max_rows=5), "k"))
        known = plan_of(big.join(bounded_broadcast(small, 5, known_rows=3), "k"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in under and "BroadcastHashJoin" in known
    assert "BroadcastHashJoin" not in over and "SortMergeJoin" in over
