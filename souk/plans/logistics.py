"""Delivery reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import day_diff


def delivery_by_city(orders: DataFrame, customers: DataFrame, *,
                     min_orders: int = 10, top: int = 10, exact: bool = False,
                     start: str = "order_delivered_carrier_date",
                     by_state: bool = False) -> DataFrame:
    """Cities with the longest average delivery time.

    Faithful to the reference by default: only delivered orders with both
    dates, days counted from hand-over to the carrier (``start``) to the
    customer, an integer average truncated toward zero (``exact=True`` keeps
    the fraction), cities grouped by name only (``by_state=True`` keeps equal
    names in different states apart), and the top ``top`` cities by that
    average; ties are broken by the group columns.

    Orders are reduced to (customer_id, day sum, count) before the join to the
    customer dimension; the average is then sum/count per group.
    """
    o = orders.filter((F.col("order_status") == "delivered")
                      & F.col(start).isNotNull()
                      & F.col("order_delivered_customer_date").isNotNull())
    per_cust = (o.groupBy("customer_id")
                .agg(F.sum(day_diff(start, "order_delivered_customer_date")).alias("days"),
                     F.count(F.lit(1)).alias("n")))
    group = ["customer_state", "customer_city"] if by_state else ["customer_city"]
    per_city = (per_cust.join(customers.select("customer_id", *group), "customer_id")
                .groupBy(*group)
                .agg(F.sum("days").alias("days"), F.sum("n").alias("order_count")))
    avg = F.col("days") / F.col("order_count")
    if not exact:
        avg = avg.cast("int")
    return (per_city.filter(F.col("order_count") > min_orders)
            .select(*group, avg.alias("delivery_time"), "order_count")
            .orderBy(F.desc("delivery_time"), *group)
            .limit(top))
