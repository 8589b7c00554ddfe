"""Table specs and rule sets of the load pipeline.

Two rule profiles exist for products, as in the reference:

* ``message`` (the SQL procedure): negative dimensions fail, NULL or zero
  pass; result is one ``error_flags`` text;
* ``flags`` (the pandas job): NULL, zero or negative dimensions fail; result
  is one boolean per rule plus ``is_valid``.

``strict`` is the rule list the reference states but never implements.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rules import (Rule, duplicate, is_null, negative, not_positive,
                               validate_message)

# Columns of the product tables.
PRODUCT_COLUMNS = (
    "product_id", "product_category_name", "product_name_length",
    "product_description_length", "product_photos_qty", "product_weight_g",
    "product_length_cm", "product_height_cm", "product_width_cm",
)

# Source column names with their typos, and the repaired names.
PRODUCT_RENAMES = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}

# Messages of the SQL profile, in the order they are joined
# into error_flags (each ends with "; ").
PRODUCT_MESSAGE_RULES = (
    Rule("category_null", "Product category name is null; ",
         is_null("product_category_name")),
    Rule("id_null", "Product id is null; ", is_null("product_id")),
    Rule("weight_negative", "Product weight is negative; ", negative("product_weight_g")),
    Rule("length_negative", "Product length is negative; ", negative("product_length_cm")),
    Rule("height_negative", "Product height is negative; ", negative("product_height_cm")),
    Rule("duplicate", "Duplicate product; ", duplicate(), needs_duplicates=True),
    Rule("width_negative", "Product width is negative; ", negative("product_width_cm")),
)

# Flag columns of the pandas profile, in their order.
PRODUCT_FLAG_RULES = (
    Rule("flag_duplicates", "", duplicate(), needs_duplicates=True),
    Rule("flag_null_product", "", is_null("product_id")),
    Rule("flag_category_not_found", "", is_null("product_category_name")),
    Rule("flag_invalid_weight", "", not_positive("product_weight_g")),
    Rule("flag_invalid_length", "", not_positive("product_length_cm")),
    Rule("flag_invalid_height", "", not_positive("product_height_cm")),
    Rule("flag_invalid_width", "", not_positive("product_width_cm")),
)

# Casts of the pandas profile's clean step: dimensions to float, counts to a
# nullable 64-bit integer.
PRODUCT_CLEAN_CASTS = {
    "product_weight_g": "double", "product_length_cm": "double",
    "product_height_cm": "double", "product_width_cm": "double",
    "product_photos_qty": "long", "product_name_length": "long",
    "product_description_length": "long",
}


@dataclass(frozen=True)
class TableSpec:
    """How one source table is staged, checked and cleaned."""

    table: str
    source_file: str
    key: tuple[str, ...]
    columns: tuple[str, ...]
    message_rules: tuple[Rule, ...]
    flag_rules: tuple[Rule, ...] = ()
    renames: dict = field(default_factory=dict)
    clean_casts: dict = field(default_factory=dict)
    # the input is no plain table scan: pin its rows before telling copies apart
    stable: bool = False


PRODUCTS = TableSpec(
    table="products", source_file="product.csv", key=("product_id",),
    columns=PRODUCT_COLUMNS, message_rules=PRODUCT_MESSAGE_RULES,
    flag_rules=PRODUCT_FLAG_RULES, renames=PRODUCT_RENAMES,
    clean_casts=PRODUCT_CLEAN_CASTS)

# Customers and orders: the reference declares their staging tables with
# NOT NULL keys; the rules below enforce exactly that plus key uniqueness.
CUSTOMERS = TableSpec(
    table="customers", source_file="customers.csv", key=("customer_id",),
    columns=("customer_id", "customer_unique_id", "customer_zip_code_prefix",
             "customer_city", "customer_state"),
    message_rules=(
        Rule("id_null", "Customer id is null; ", is_null("customer_id")),
        Rule("unique_id_null", "Customer unique id is null; ",
             is_null("customer_unique_id")),
        Rule("duplicate", "Duplicate customer; ", duplicate(), needs_duplicates=True),
    ), stable=True)

ORDERS = TableSpec(
    table="orders", source_file="orders.csv", key=("order_id",),
    columns=("order_id", "customer_id", "order_status", "order_purchase_timestamp",
             "order_approved_at", "order_delivered_carrier_date",
             "order_delivered_customer_date", "order_estimated_delivery_date"),
    message_rules=(
        Rule("id_null", "Order id is null; ", is_null("order_id")),
        Rule("customer_null", "Customer id is null; ", is_null("customer_id")),
        Rule("duplicate", "Duplicate order; ", duplicate(), needs_duplicates=True),
    ))


def single_rule_quarantine(staged: DataFrame) -> DataFrame:
    """Staged products whose category is NULL, tagged for the error zone.

    The reference's first hand-written check: every such row with
    ``flag_error`` set and one literal description.
    """
    return (staged.filter(F.col("product_category_name").isNull())
            .select(*PRODUCT_COLUMNS, F.lit(True).alias("flag_error"),
                    F.lit("Product category name is null").alias("error_description")))


# Messages of the stated-only strict rule list (our wording).
STRICT_RULES = (
    Rule("id_null", "Product id is null; ", is_null("product_id")),
    Rule("category_unknown", "Product category not found; ",
         lambda: F.col("product_category_name").isNotNull() & F.col("_english").isNull()),
    Rule("photos_null", "Product photos quantity is null; ", is_null("product_photos_qty")),
    Rule("description_missing", "Product description is missing; ",
         lambda: F.coalesce(F.col("product_description_length"), F.lit(0)) <= 0),
    Rule("weight_null", "Product weight is null; ", is_null("product_weight_g")),
    Rule("length_null", "Product length is null; ", is_null("product_length_cm")),
    Rule("height_null", "Product height is null; ", is_null("product_height_cm")),
    Rule("width_null", "Product width is null; ", is_null("product_width_cm")),
)


def strict_validate(staged: DataFrame, category_name: DataFrame,
                    undefined: str = "undefined") -> DataFrame:
    """The reference's intended (never implemented) product rules.

    The category must exist in the translation table and is replaced by its
    English name; a NULL category becomes ``undefined`` instead of failing;
    missing photos, description or any dimension fail.
    """
    names = category_name.select(
        F.col("product_category_name").alias("_src"),
        F.col("product_category_name_english").alias("_english"))
    joined = staged.join(names,
                         staged.product_category_name == F.col("_src"), "left")
    checked = validate_message(joined, STRICT_RULES)
    english = (F.when(F.col("product_category_name").isNull(), F.lit(undefined))
               .otherwise(F.col("_english")))
    cols = [english.alias(c) if c == "product_category_name" else F.col(c)
            for c in PRODUCT_COLUMNS]
    return checked.select(*cols, "error_flags")
