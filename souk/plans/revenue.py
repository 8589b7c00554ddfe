"""Sales and revenue reports.

Money is summed as exact integer cents (``money_sum``) and only turned back
into a 2-decimal amount at the end, so every total is independent of the order
rows arrive in and of how the data is partitioned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import from_cents, money_sum, month_label, pct


def revenue_per_order(order_items: DataFrame) -> DataFrame:
    """(order_id, rev_cents, n_items): items collapsed to one row per order.

    Aggregating before the join to ``orders`` shrinks the join input about
    four-fold and needs no extra shuffle: the aggregate is already hash
    partitioned on ``order_id``. Partial (map-side) aggregation absorbs an
    order with a huge number of items.
    """
    return (order_items.groupBy("order_id")
            .agg(money_sum("price").alias("rev_cents"),
                 F.count(F.lit(1)).alias("n_items")))


def monthly_revenue(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """(order_year, order_month, month_label, rev_cents): exact revenue of each
    calendar month; sums of the months of disjoint orders are those of all."""
    ts = F.col("order_purchase_timestamp")
    return (orders.select("order_id", "order_purchase_timestamp")
            .join(revenue_per_order(order_items), "order_id")
            .groupBy(F.year(ts).alias("order_year"), F.month(ts).alias("order_month"),
                     month_label(ts).alias("month_label"))
            .agg(F.sum("rev_cents").alias("rev_cents")))


def revenue_trend(monthly: DataFrame) -> DataFrame:
    """The report from the revenue of the months."""
    # At most twelve rows a year (orders without a date are a year of their
    # own), so a window by year sees a bounded group.
    so_far = Window.partitionBy("order_year").orderBy("order_month").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    running = F.sum("rev_cents").over(so_far)
    return (monthly.select(
        "order_year", "order_month", "month_label",
        F.round(from_cents("rev_cents"), 2).alias("total_revenue"),
        F.round(from_cents(running), 2).alias("running_total_revenue"))
        .orderBy("order_year", "order_month"))


def monthly_revenue_trend(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Revenue per calendar month with a running total that restarts each year.

    Revenue is the item price of all orders (cancelled ones included), as in
    the reference report. The windows run after the monthly aggregate, so they
    see at most twelve rows per year whatever the data size.
    """
    return revenue_trend(monthly_revenue(orders, order_items))


def category_revenue(order_items: DataFrame, products: DataFrame,
                     category_name: DataFrame, *, misc_label: str = "Misc",
                     keep_unmapped: bool = False) -> DataFrame:
    """Revenue, share of all item revenue and order count per category.

    Faithful to the reference: products without a category are grouped as
    ``misc_label``; the inner join to the translation table drops that group
    and every untranslated category (so shares need not add up to 100); an
    order with items of two categories counts in both. ``keep_unmapped=True``
    keeps those groups under their source name instead.

    The grand total is the plain sum over the items (a one-row aggregate of one
    column), taken before the join: a product listed twice counts its items
    twice in its category, as in the reference, but not in the total.
    """
    per_cat = (order_items.select("order_id", "product_id", "price")
               .join(products.select("product_id", "product_category_name"), "product_id")
               .groupBy("product_category_name")
               .agg(money_sum("price").alias("cents"),
                    F.count_distinct("order_id").alias("order_count")))
    total = order_items.agg(money_sum("price").alias("all_cents"))
    names = category_name.select(
        F.col("product_category_name").alias("category"),
        F.col("product_category_name_english").alias("english"))
    category = F.coalesce("product_category_name", F.lit(misc_label))
    # Misc and untranslated groups have no label unless keep_unmapped
    label = F.coalesce("english", "category") if keep_unmapped else F.col("english")
    labelled = (per_cat.select(category.alias("category"), "cents", "order_count")
                .join(names, "category", "left")
                .groupBy(label.alias("product_category_name"))
                .agg(F.sum("cents").alias("cents"),
                     F.sum("order_count").alias("number_of_orders")))
    return (labelled.crossJoin(F.broadcast(total))
            .filter(F.col("product_category_name").isNotNull())
            .select("product_category_name",
                    F.round(from_cents("cents"), 2).alias("total_revenue"),
                    pct("cents", "all_cents", 2).alias("revenue_percentage"),
                    "number_of_orders")
            .orderBy(F.desc("total_revenue"), "product_category_name"))
