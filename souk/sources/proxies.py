"""Retail tables derived from the star-schema test data.

The retail reports read orders, order items, customers, products, category
names, geolocation, sellers, reviews and payments. The test data set has none
of these, so each is a plain projection of a test table (see FIXTURES.md §3).
Every proxy is lazy: a report that uses two columns of ``orders`` scans two
columns of the Parquet file.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import add_days
from ..operators.joins import bounded_broadcast
from .tables import read_table

# Order status codes of the test data and their retail names.
STATUS_NAMES = {"F": "delivered", "O": "shipped", "P": "canceled"}

# Product categories that have an English translation. The
# category MEDIUM is left out on purpose so that the unmapped case occurs.
TRANSLATED_CATEGORIES = ("ECONOMY", "SMALL", "STANDARD", "PROMO", "LARGE")

# Upper bound for driver-built dimension tables that are broadcast.
DIMENSION_ROWS = 10_000


def _status(code):
    expr = F.when(code == "F", F.lit(STATUS_NAMES["F"]))
    for k in ("O", "P"):
        expr = expr.when(code == k, F.lit(STATUS_NAMES[k]))
    return expr


@dataclass
class Retail:
    """The retail schema over one data set folder."""

    spark: SparkSession
    root: str
    _tables: dict = field(default_factory=dict, repr=False)

    def table(self, name: str) -> DataFrame:
        """One lazy scan per table and instance (reused by every proxy)."""
        if name not in self._tables:
            self._tables[name] = read_table(self.spark, self.root, name)
        return self._tables[name]

    # Parquet dimensions get no hint: the planner broadcasts them from their
    # file statistics when under spark.sql.autoBroadcastJoinThreshold and falls
    # back to a shuffle join otherwise (AQE re-checks with runtime sizes).
    @property
    def nation(self) -> DataFrame:
        return self.table("nation")

    @property
    def region(self) -> DataFrame:
        return self.table("region")

    @cached_property
    def customers(self) -> DataFrame:
        c = self.table("customer")
        n = self.nation
        return (c.join(n, c.c_nationkey == n.n_nationkey)
                .select(c.c_custkey.alias("customer_id"),
                        F.expr("c_custkey div 2").alias("customer_unique_id"),
                        F.lpad(c.c_nationkey.cast("string"), 5, "0")
                        .alias("customer_zip_code_prefix"),
                        F.concat(n.n_name, F.lit("_"), c.c_mktsegment)
                        .alias("customer_city"),
                        n.n_name.alias("customer_state")))

    @cached_property
    def geolocation(self) -> DataFrame:
        s = self.table("supplier")
        return s.select(
            F.lpad(s.s_nationkey.cast("string"), 5, "0")
            .alias("geolocation_zip_code_prefix"),
            F.concat(F.lit("CITY_"), s.s_nationkey.cast("string"), F.lit("_"),
                     (s.s_suppkey % 3).cast("string")).alias("geolocation_city"))

    @cached_property
    def orders(self) -> DataFrame:
        o = self.table("orders")
        oid = F.col("o_orderkey")
        status = _status(F.col("o_orderstatus"))
        approved = add_days("o_orderdate", oid % 3)
        carrier = add_days(approved, 1 + oid % 5)
        delivered = add_days(carrier, 2 + (oid * 7) % 29)
        return o.select(
            oid.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            status.alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
            approved.alias("order_approved_at"),
            F.when(F.col("o_orderstatus") != "P", carrier)
            .alias("order_delivered_carrier_date"),
            F.when(F.col("o_orderstatus") == "F", delivered)
            .alias("order_delivered_customer_date"),
            add_days("o_orderdate", 20 + oid % 11)
            .alias("order_estimated_delivery_date"))

    @cached_property
    def order_items(self) -> DataFrame:
        li = self.table("lineitem")
        return li.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_quantity").alias("quantity"),
            (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"))

    @cached_property
    def products(self) -> DataFrame:
        p = self.table("part")
        return p.select(
            F.col("p_partkey").alias("product_id"),
            F.when(F.col("p_partkey") % 37 != 0, F.col("p_type"))
            .alias("product_category_name"))

    @cached_property
    def category_name(self) -> DataFrame:
        rows = [(c, c.lower() + "_en") for c in TRANSLATED_CATEGORIES]
        df = self.spark.createDataFrame(
            rows, "product_category_name string, product_category_name_english string")
        return bounded_broadcast(df, DIMENSION_ROWS, known_rows=len(rows))

    @cached_property
    def sellers(self) -> DataFrame:
        s = self.table("supplier")
        n, r = self.nation, self.region
        return (s.join(n, s.s_nationkey == n.n_nationkey)
                .join(r, n.n_regionkey == r.r_regionkey)
                .select(s.s_suppkey.alias("seller_id"),
                        n.n_name.alias("seller_state"),
                        r.r_name.alias("seller_region")))

    @cached_property
    def order_reviews(self) -> DataFrame:
        o = self.table("orders")
        score = (1 + (F.col("o_orderkey") * 13 + F.col("o_custkey")) % 5).cast("int")
        return o.select(F.col("o_orderkey").alias("order_id"),
                        score.alias("review_score"))

    @cached_property
    def order_payments(self) -> DataFrame:
        o = self.table("orders")
        return o.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_orderpriority").alias("payment_type"),
            (1 + F.col("o_orderkey") % 12).cast("int").alias("payment_installments"),
            F.col("o_totalprice").alias("payment_value"))

    @cached_property
    def raw_products(self) -> DataFrame:
        """Dirty product rows for the quality pipeline (FIXTURES.md §4).

        The source column names keep their typos (``..._lenght``) because the
        pipeline's staging step is what repairs them.
        """
        p = self.table("part")
        base = p.unionByName(p.filter(F.col("p_partkey") % 53 == 8))
        k, size = F.col("p_partkey"), F.col("p_size")
        return base.select(
            F.when(k % 101 != 50, k.cast("string")).alias("product_id"),
            F.when(k % 37 == 0, F.lit(None).cast("string"))
            .when(k % 43 == 1, F.concat(F.lit("  "), F.col("p_type"), F.lit(" ")))
            .otherwise(F.col("p_type")).alias("product_category_name"),
            F.length("p_name").cast("int").alias("product_name_lenght"),
            (F.length("p_name") * size).cast("int")
            .alias("product_description_lenght"),
            F.when(k % 29 != 3, size % 7).alias("product_photos_qty"),
            F.when(k % 41 == 2, F.lit(-5))
            .when(k % 47 == 3, F.lit(None).cast("int"))
            .when(k % 59 == 4, F.lit(0))
            .otherwise(size * 100).alias("product_weight_g"),
            F.when(k % 61 == 5, F.lit(-1)).otherwise(size).alias("product_length_cm"),
            F.when(k % 67 == 6, F.lit(-1)).otherwise(size + 1)
            .alias("product_height_cm"),
            F.when(k % 71 == 7, F.lit(-1)).otherwise(size + 2)
            .alias("product_width_cm"))


class DirtyRetail(Retail):
    """The same tables with the faults of real data, over all their rows:
    orders without a date, customers without a person, products listed twice."""

    @cached_property
    def orders(self) -> DataFrame:
        return Retail.orders.func(self).withColumn(
            "order_purchase_timestamp",
            F.when(F.col("order_id") % 97 != 5, F.col("order_purchase_timestamp")))

    @cached_property
    def customers(self) -> DataFrame:
        return Retail.customers.func(self).withColumn(
            "customer_unique_id",
            F.when(F.col("customer_id") % 11 != 3, F.col("customer_unique_id")))

    @cached_property
    def products(self) -> DataFrame:
        p = Retail.products.func(self)
        return p.unionByName(p.filter(F.col("product_id") % 13 == 4))
