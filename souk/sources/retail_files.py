"""The retail frames read from the raw CSV files of the public data set.

``RetailFiles(spark, folder)`` exposes the same attributes as
``proxies.Retail`` (orders, order_items, customers, products, category_name,
geolocation, sellers, order_reviews, order_payments, raw_products), so every
report and the load pipeline run unchanged on the original files. Each file is
read with a declared schema: ids and zip prefixes stay strings, timestamps are
parsed once, and no inference pass runs over the data.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import bounded_broadcast
from .files import LINE_BREAKS, RAW_SCHEMAS, read_csv

# File names of the public data set, by table.
FILES = {
    "customers": "customers.csv",
    "geolocation": "geolocation.csv",
    "order_items": "order_items.csv",
    "order_payments": "order_payments.csv",
    "order_reviews": "order_reviews.csv",
    "orders": "orders.csv",
    "products": "products.csv",
    "sellers": "sellers.csv",
    "product_category_name_translation": "product_category_name_translation.csv",
}

# The country's five regions and the state codes in each.
REGIONS = {
    "Norte": ("AC", "AP", "AM", "PA", "RO", "RR", "TO"),
    "Nordeste": ("AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"),
    "Centro-Oeste": ("DF", "GO", "MT", "MS"),
    "Sudeste": ("ES", "MG", "RJ", "SP"),
    "Sul": ("PR", "RS", "SC"),
}


@dataclass
class RetailFiles:
    """The retail schema over a folder holding the nine raw CSV files."""

    spark: SparkSession
    folder: str
    _tables: dict = field(default_factory=dict, repr=False)

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            path = f"{self.folder.rstrip('/')}/{FILES[name]}"
            self._tables[name] = read_csv(self.spark, path, RAW_SCHEMAS[name],
                                          line_breaks=name in LINE_BREAKS)
        return self._tables[name]

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders")

    @cached_property
    def order_items(self) -> DataFrame:
        # one row per unit sold: the quantity of a row is 1
        return self.table("order_items").withColumn("quantity", F.lit(1.0))

    @cached_property
    def customers(self) -> DataFrame:
        return self.table("customers")

    @cached_property
    def geolocation(self) -> DataFrame:
        return self.table("geolocation").select("geolocation_zip_code_prefix",
                                                "geolocation_city")

    @cached_property
    def products(self) -> DataFrame:
        return self.table("products").select("product_id", "product_category_name")

    @cached_property
    def raw_products(self) -> DataFrame:
        # rows that do not parse go to the error zone of the load pipeline
        return read_csv(self.spark, f"{self.folder.rstrip('/')}/{FILES['products']}",
                        RAW_SCHEMAS["products"], quarantine=True)

    @cached_property
    def category_name(self) -> DataFrame:
        # one row per category: small by nature, checked before broadcasting
        return bounded_broadcast(self.table("product_category_name_translation"), 100_000)

    @cached_property
    def order_reviews(self) -> DataFrame:
        return self.table("order_reviews").select("order_id", "review_score")

    @cached_property
    def order_payments(self) -> DataFrame:
        return self.table("order_payments").select(
            "order_id", "payment_type", "payment_installments", "payment_value")

    @cached_property
    def sellers(self) -> DataFrame:
        rows = [(s, r) for r, states in REGIONS.items() for s in states]
        region = bounded_broadcast(
            self.spark.createDataFrame(rows, "seller_state string, seller_region string"),
            known_rows=len(rows))
        return (self.table("sellers").select("seller_id", "seller_state")
                .join(region, "seller_state", "left")
                .select("seller_id", "seller_state", "seller_region"))
