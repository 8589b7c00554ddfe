"""Sellers, delivery and cancellation analyses (stated questions of the
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ...functions import correlation, day_diff, from_cents, money_sum, pct
from ...operators.topk import top_k_per_group
from .common import delivered, order_categories, order_sellers, revenue_per_order


def _avg(total: str, n: str, scale: int):
    """round(total / n, scale) as double; NULL when n is 0."""
    return F.round(F.try_divide(F.col(total).cast("double"), F.col(n).cast("double")), scale)


def revenue_per_seller(order_items: DataFrame) -> DataFrame:
    """Sellers, their total item revenue and the average per seller."""
    per = order_items.groupBy("seller_id").agg(money_sum("price").alias("cents"))
    return per.agg(F.count(F.lit(1)).alias("sellers"),
                   F.sum("cents").alias("cents")).select(
        "sellers", F.round(from_cents("cents"), 2).alias("total_revenue"),
        F.round(F.try_divide(F.col("cents").cast("double"), F.col("sellers")) / 100.0, 2)
        .alias("avg_revenue_per_seller"))


def cancellation_impact(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Share of cancelled orders and of the item revenue they carry."""
    o = (orders.select("order_id", (F.col("order_status") == "canceled").alias("c"))
         .join(revenue_per_order(order_items), "order_id", "left"))
    cents = F.coalesce("rev_cents", F.lit(0))
    return o.agg(F.count(F.lit(1)).alias("orders"),
                 F.count_if("c").alias("canceled_orders"),
                 F.sum(F.when(F.col("c"), cents).otherwise(0)).alias("cc"),
                 F.sum(cents).alias("all_cents")).select(
        "orders", "canceled_orders",
        pct("canceled_orders", "orders", 2).alias("cancellation_rate"),
        F.round(from_cents("cc"), 2).alias("canceled_revenue"),
        pct("cc", "all_cents", 2).alias("canceled_revenue_share"))


def state_revenue_corr(orders: DataFrame, order_items: DataFrame,
                       customers: DataFrame) -> DataFrame:
    """Correlation across states of item revenue and buying persons."""
    per_cust = (orders.select("order_id", "customer_id")
                .join(revenue_per_order(order_items), "order_id")
                .groupBy("customer_id").agg(F.sum("rev_cents").alias("cents")))
    per_state = (per_cust.join(customers.select("customer_id", "customer_state",
                                                "customer_unique_id"), "customer_id")
                 .groupBy("customer_state")
                 .agg(F.sum("cents").alias("cents"),
                      F.count_distinct("customer_unique_id").alias("persons")))
    return per_state.agg(
        F.count(F.lit(1)).alias("states"),
        F.round(correlation(from_cents("cents"), F.col("persons").cast("double")), 6)
        .alias("revenue_customers_corr"))


def delivery_actual_vs_estimate(orders: DataFrame) -> DataFrame:
    """Purchase-to-delivery days, actual against estimated."""
    d = delivered(orders).filter(F.col("order_estimated_delivery_date").isNotNull())
    d = d.select(
        day_diff("order_purchase_timestamp", "order_delivered_customer_date").alias("a"),
        day_diff("order_purchase_timestamp", "order_estimated_delivery_date").alias("e"),
        day_diff("order_estimated_delivery_date", "order_delivered_customer_date")
        .alias("g"))
    return d.agg(F.count(F.lit(1)).alias("orders"), F.sum("a").alias("a"),
                 F.sum("e").alias("e"), F.sum("g").alias("g"),
                 F.count_if(F.col("g") > 0).alias("late")).select(
        "orders", _avg("a", "orders", 2).alias("avg_actual_days"),
        _avg("e", "orders", 2).alias("avg_estimated_days"),
        _avg("g", "orders", 2).alias("avg_gap_days"),
        pct("late", "orders", 2).alias("late_share"))


def seller_ship_time(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Per seller: delivered orders and mean purchase-to-delivery days."""
    return _seller_days(orders, order_items).select(
        "seller_id", "orders", F.round("avg_ship_days", 2).alias("avg_ship_days"))


def _seller_days(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    d = delivered(orders).select(
        "order_id", day_diff("order_purchase_timestamp", "order_delivered_customer_date")
        .alias("days"))
    return (order_sellers(order_items).join(d, "order_id")
            .groupBy("seller_id")
            .agg(F.count(F.lit(1)).alias("orders"), F.sum("days").alias("days"))
            .select("seller_id", "orders",
                    (F.col("days") / F.col("orders")).alias("avg_ship_days")))


def slowest_sellers(orders: DataFrame, order_items: DataFrame, sellers: DataFrame,
                    top: int = 10) -> DataFrame:
    """The ``top`` sellers with the longest mean delivery (ties: seller id).

    A top-k over all sellers: Spark keeps the best k of every partition before
    the final merge (TakeOrderedAndProject), so nothing grows with the data.
    """
    t = _seller_days(orders, order_items)
    best = t.orderBy(F.desc("avg_ship_days"), "seller_id").limit(top)
    return (best.join(sellers.select("seller_id", "seller_state"), "seller_id", "left")
            .select("seller_id", "seller_state", "orders",
                    F.round("avg_ship_days", 2).alias("avg_ship_days")))


def slowest_places(orders: DataFrame, order_items: DataFrame, sellers: DataFrame,
                   place: str = "seller_region") -> DataFrame:
    """Mean delivery days by the sellers' state or region, slowest first; a
    seller without a place forms a row of its own."""
    d = delivered(orders).select(
        "order_id", day_diff("order_purchase_timestamp", "order_delivered_customer_date")
        .alias("days"))
    per = (order_sellers(order_items).join(d, "order_id").groupBy("seller_id")
           .agg(F.count(F.lit(1)).alias("orders"), F.sum("days").alias("days")))
    return (per.join(sellers.select("seller_id", place), "seller_id", "left").groupBy(place)
            .agg(F.sum("orders").alias("orders"), F.sum("days").alias("days"))
            .select(place, "orders", _avg("days", "orders", 2).alias("avg_ship_days"))
            .orderBy(F.desc("avg_ship_days"), place))


def ship_lag(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Per seller: mean days from approval to hand-over to the carrier."""
    o = orders.filter(F.col("order_approved_at").isNotNull()
                      & F.col("order_delivered_carrier_date").isNotNull()).select(
        "order_id", day_diff("order_approved_at", "order_delivered_carrier_date")
        .alias("lag"))
    return (order_sellers(order_items).join(o, "order_id").groupBy("seller_id")
            .agg(F.count(F.lit(1)).alias("orders"), F.sum("lag").alias("lag"))
            .select("seller_id", "orders", _avg("lag", "orders", 2).alias("avg_ship_lag_days")))


def category_cancel_rate(orders: DataFrame, order_items: DataFrame,
                         products: DataFrame) -> DataFrame:
    """Per category: orders, cancelled orders and their share."""
    o = orders.select("order_id", (F.col("order_status") == "canceled").alias("c"))
    return (order_categories(order_items, products).join(o, "order_id")
            .groupBy("category")
            .agg(F.count(F.lit(1)).alias("orders"), F.count_if("c").alias("canceled_orders"))
            .select(F.col("category").alias("product_category_name"), "orders",
                    "canceled_orders",
                    pct("canceled_orders", "orders", 2).alias("cancel_rate")))


def holiday_products(orders: DataFrame, order_items: DataFrame, *,
                     months: tuple[int, ...] = (11, 12), top: int = 10) -> DataFrame:
    """Best-selling products of the holiday season, per year.

    The rank filter lets Spark insert a partial per-partition group limit
    before the shuffle, so a year with millions of products costs the final
    window only ``top`` rows per map partition.
    """
    ts = F.col("order_purchase_timestamp")
    o = orders.filter(F.month(ts).isin(*months)).select(
        "order_id", F.year(ts).alias("order_year"))
    per = (order_items.select("order_id", "product_id", "price", "quantity")
           .join(o, "order_id").groupBy("order_year", "product_id")
           .agg(money_sum("price").alias("cents"), F.sum("quantity").alias("units")))
    best = top_k_per_group(per, ["order_year"], [F.desc("cents"), F.col("product_id")], top)
    return (best.select("order_year", "rank", "product_id",
                    F.round(from_cents("cents"), 2).alias("revenue"), "units"))


def top_sellers(order_items: DataFrame, top: int = 10) -> DataFrame:
    """Revenue leaders and volume (items sold) leaders, ``top`` each."""
    per = order_items.groupBy("seller_id").agg(
        money_sum("price").alias("cents"), F.count(F.lit(1)).alias("items"))
    long = (per.select("seller_id", F.lit("revenue").alias("metric"),
                       from_cents("cents").alias("value"))
            .unionByName(per.select("seller_id", F.lit("volume").alias("metric"),
                                    F.col("items").cast("double").alias("value"))))
    best = top_k_per_group(long, ["metric"], [F.desc("value"), F.col("seller_id")], top)
    return (best.select("metric", "rank", "seller_id", F.round("value", 2).alias("value")))


def seller_retention(orders: DataFrame, order_items: DataFrame,
                     months: int = 6) -> DataFrame:
    """Sellers still selling ``months`` after their first sale."""
    day = F.col("order_purchase_timestamp").cast("date")
    per = (order_sellers(order_items)
           .join(orders.select("order_id", day.alias("d")), "order_id")
           .groupBy("seller_id").agg(F.min("d").alias("first"), F.max("d").alias("last")))
    kept = F.col("last") >= F.add_months("first", months)
    return per.agg(F.count(F.lit(1)).alias("sellers"),
                   F.count_if(kept).alias("retained_sellers")).select(
        "sellers", "retained_sellers",
        (F.col("sellers") - F.col("retained_sellers")).alias("dropped_sellers"),
        pct("retained_sellers", "sellers", 2).alias("retention_rate"))


def retention_curve(activity: DataFrame, who: str, quiet: int = 6) -> DataFrame:
    """Product-limit estimate of how long ``who`` stays, from (``who``, ``d``).

    Someone who has been quiet for ``quiet`` months at the end of the data dropped
    out in the month of the last activity; anyone else is censored there: the data
    ends before it could be told, so they leave the risk set without counting as
    dropped. One row per month after the first activity in which someone left:
    those at risk, those dropped and censored, and the share that stays longer.

    People are reduced to two months each (combined on the map side) and then to
    one row per month, so the windows see as many rows as the data has months.
    """
    month = F.year("d") * 12 + F.month("d") - 1
    per = (activity.filter(F.col(who).isNotNull() & F.col("d").isNotNull())
           .groupBy(who).agg(F.min(month).alias("first"), F.max(month).alias("last")))
    spans = per.groupBy((F.col("last") - F.col("first")).alias("months"), "last") \
        .agg(F.count(F.lit(1)).alias("n"))
    over_all = Window.partitionBy(F.lit(1))
    gone = F.max("last").over(over_all) - F.col("last") >= quiet
    left = (spans.withColumn("gone", gone).groupBy("months")
            .agg(F.sum(F.when(F.col("gone"), F.col("n")).otherwise(0)).alias("dropped"),
                 F.sum(F.when(~F.col("gone"), F.col("n")).otherwise(0)).alias("censored")))
    later = over_all.orderBy("months").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    so_far = over_all.orderBy("months").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at_risk = left.withColumn("at_risk", F.sum(F.col("dropped") + F.col("censored")).over(later))
    stay = F.lit(1.0) - F.col("dropped") / F.col("at_risk")
    return (at_risk.withColumn("factors", F.collect_list(stay).over(so_far))
            .select(F.col("months").cast("int").alias("months_since_first"), "at_risk",
                    "dropped", "censored",
                    F.round(F.aggregate("factors", F.lit(1.0), lambda a, f: a * f), 6)
                    .alias("retained_share")))


def seller_retention_curve(orders: DataFrame, order_items: DataFrame,
                           quiet: int = 6) -> DataFrame:
    """How long sellers keep selling (``retention_curve``)."""
    day = F.col("order_purchase_timestamp").cast("date")
    return retention_curve(order_sellers(order_items).join(
        orders.select("order_id", day.alias("d")), "order_id"), "seller_id", quiet)


def customer_retention_curve(orders: DataFrame, customers: DataFrame,
                             quiet: int = 6) -> DataFrame:
    """How long persons keep buying (``retention_curve``)."""
    day = F.col("order_purchase_timestamp").cast("date")
    person = "customer_unique_id"
    return retention_curve(orders.select("customer_id", day.alias("d")).join(
        customers.select("customer_id", person), "customer_id"), person, quiet)


def region_performance(orders: DataFrame, order_items: DataFrame,
                       sellers: DataFrame) -> DataFrame:
    """Per seller region: item revenue, orders and mean delivery days."""
    per = (order_items.select("order_id", "seller_id", "price")
           .join(sellers.select("seller_id", "seller_region"), "seller_id")
           .groupBy("order_id", "seller_region").agg(money_sum("price").alias("cents")))
    d = delivered(orders).select(
        "order_id", day_diff("order_purchase_timestamp", "order_delivered_customer_date")
        .alias("days"))
    return (per.join(d, "order_id", "left").groupBy("seller_region")
            .agg(F.sum("cents").alias("cents"), F.count(F.lit(1)).alias("orders"),
                 F.sum("days").alias("days"), F.count("days").alias("n_delivered"))
            .select("seller_region", F.round(from_cents("cents"), 2).alias("revenue"),
                    "orders", _avg("days", "n_delivered", 2).alias("avg_delivery_days")))
