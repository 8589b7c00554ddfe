"""Frames shared by the extension analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..revenue import revenue_per_order

MISC = "Misc"


def order_category_sets(order_items: DataFrame, products: DataFrame,
                        misc_label: str = MISC) -> DataFrame:
    """(order_id, cats): the set of categories of each order.

    Sets merge on the map side, so an order with a third of all items is as
    many rows as there are tasks, each as short as the list of categories.
    """
    return (order_items.select("order_id", "product_id")
            .join(products.select("product_id", "product_category_name"), "product_id")
            .groupBy("order_id")
            .agg(F.collect_set(F.coalesce("product_category_name", F.lit(misc_label)))
                 .alias("cats")))


def order_categories(order_items: DataFrame, products: DataFrame,
                     misc_label: str = MISC) -> DataFrame:
    """Distinct (order_id, category): an order counts once per category.

    Products without a category fall under ``misc_label``; items of a product
    that is not listed have no category and are left out, in every analysis by
    category. The rows stay where their order's set is, so a join on the order
    does not move them again.
    """
    return order_category_sets(order_items, products, misc_label) \
        .select("order_id", F.explode("cats").alias("category"))


def order_sellers(order_items: DataFrame) -> DataFrame:
    """Distinct (order_id, seller_id). Copies go on the map side, before the rows
    are dealt by both columns: a hot order is many tasks. Sellers are no short
    list, so they are not gathered per order."""
    return order_items.select("order_id", "seller_id").distinct()


def delivered(orders: DataFrame) -> DataFrame:
    """Delivered orders that carry both the purchase and delivery dates."""
    return orders.filter((F.col("order_status") == "delivered")
                         & F.col("order_delivered_customer_date").isNotNull()
                         & F.col("order_purchase_timestamp").isNotNull())


__all__ = ["order_categories", "order_category_sets", "order_sellers", "delivered", "revenue_per_order",
           "MISC"]
