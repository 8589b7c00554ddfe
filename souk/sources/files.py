"""Readers for the raw CSV files of the retail data set.

Always with an explicit schema: inferring would turn zip-code prefixes such
as ``01310`` into integers and costs an extra pass over the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Column layouts of the raw files as the reference names them
# (the product file keeps its source typos ``..._lenght``).
RAW_SCHEMAS = {
    "customers": "customer_id string, customer_unique_id string, "
                 "customer_zip_code_prefix string, customer_city string, "
                 "customer_state string",
    "geolocation": "geolocation_zip_code_prefix string, geolocation_lat double, "
                   "geolocation_lng double, geolocation_city string, "
                   "geolocation_state string",
    "order_items": "order_id string, order_item_id int, product_id string, "
                   "seller_id string, shipping_limit_date timestamp_ntz, price double, "
                   "freight_value double",
    "order_payments": "order_id string, payment_sequential int, payment_type string, "
                      "payment_installments int, payment_value double",
    "order_reviews": "review_id string, order_id string, review_score int, "
                     "review_comment_title string, review_comment_message string, "
                     "review_creation_date timestamp_ntz, "
                     "review_answer_timestamp timestamp_ntz",
    "orders": "order_id string, customer_id string, order_status string, "
              "order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
              "order_delivered_carrier_date timestamp_ntz, "
              "order_delivered_customer_date timestamp_ntz, "
              "order_estimated_delivery_date timestamp_ntz",
    "products": "product_id string, product_category_name string, "
                "product_name_lenght int, product_description_lenght int, "
                "product_photos_qty int, product_weight_g int, product_length_cm int, "
                "product_height_cm int, product_width_cm int",
    "sellers": "seller_id string, seller_zip_code_prefix string, seller_city string, "
               "seller_state string",
    "product_category_name_translation":
        "product_category_name string, product_category_name_english string",
}


# Doubled quotes stand for quotes; the header must name the columns of the
# schema, in its order.
_CSV_OPTIONS = {"header": "true", "encoding": "UTF-8", "quote": '"', "escape": '"',
                "enforceSchema": "false"}

# Tables whose texts may hold line breaks. Such a file is read whole, by one task;
# files of the other tables are cut into splits.
LINE_BREAKS = frozenset({"order_reviews"})


def csv_options(line_breaks: bool = False) -> dict[str, str]:
    return {**_CSV_OPTIONS, "multiLine": str(line_breaks).lower()}


# Column that holds the raw text of a row that does not parse, where such rows
# are kept for the error zone instead of failing the job.
CORRUPT = "_malformed_row"
QUARANTINE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def read_csv(spark: SparkSession, path: str, schema: str, quarantine: bool = False,
             line_breaks: bool = False) -> DataFrame:
    """Header CSV (UTF-8, a leading byte-order mark is tolerated).

    A row that does not parse fails the job, or, with ``quarantine``, comes
    with its raw text in the column ``CORRUPT``; the load pipeline sends such
    rows to the error zone. With ``line_breaks`` quoted text may span lines, and
    one file is one task; without, a text that does is a row that does not parse.
    """
    options = csv_options(line_breaks)
    if quarantine:
        return spark.read.schema(f"{schema}, {CORRUPT} string") \
            .options(**options, **QUARANTINE).csv(path)
    return spark.read.schema(schema).options(**options, mode="FAILFAST").csv(path)


def read_raw(spark: SparkSession, path: str, table: str,
             quarantine: bool = False) -> DataFrame:
    """One of the raw retail files by its table name (see ``RAW_SCHEMAS``)."""
    return read_csv(spark, path, RAW_SCHEMAS[table], quarantine, table in LINE_BREAKS)
