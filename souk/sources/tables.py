"""Readers for the Parquet tables of a data set folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem")

# Declared layouts of the source tables: reading with a schema skips footer
# inference on the driver and fails loudly if a column changes type.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, "
              "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, "
                "l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
}


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Lazy Parquet scan of ``<root>/<name>.parquet``.

    Nothing is read here: Catalyst prunes the columns and pushes the filters
    of whatever query uses the frame into this scan.
    """
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{root.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, root: str,
                   names: tuple[str, ...] = BASE_TABLES) -> None:
    """Expose the tables as temp views for ``spark.sql``."""
    for name in names:
        read_table(spark, root, name).createOrReplaceTempView(name)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables and views of the session catalog as a sorted one-column frame
    (the catalog answer to ``INFORMATION_SCHEMA.TABLES``)."""
    rows = [(t.name,) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(sorted(rows), "table_name string")
