"""Oracle SQL for the load pipeline keys (products, customers, orders)."""

from __future__ import annotations

from . import with_proxies

LOAD_TS_SQL = "TIMESTAMP '2024-01-01 00:00:00'"

PRODUCT_COLS = ["product_id", "product_category_name", "product_name_length",
                "product_description_length", "product_photos_qty", "product_weight_g",
                "product_length_cm", "product_height_cm", "product_width_cm"]
RAW_COLS = [c.replace("_length", "_lenght") if c in ("product_name_length",
            "product_description_length") else c for c in PRODUCT_COLS]


def _cols(cols, prefix=""):
    return ", ".join(prefix + c for c in cols)


def _order(cols):
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols)


STAGED = f"""
  SELECT product_id, product_category_name,
         product_name_lenght AS product_name_length,
         product_description_lenght AS product_description_length,
         product_photos_qty, product_weight_g, product_length_cm, product_height_cm,
         product_width_cm, {LOAD_TS_SQL} AS load_datetime,
         'product.csv' AS source_file, CAST(1 AS INTEGER) AS batch_id
  FROM r_raw_products"""

# The rules' messages, in the order they are joined.
MESSAGES = (
    ("product_category_name IS NULL", "Product category name is null; "),
    ("product_id IS NULL", "Product id is null; "),
    ("product_weight_g < 0", "Product weight is negative; "),
    ("product_length_cm < 0", "Product length is negative; "),
    ("product_height_cm < 0", "Product height is negative; "),
    ("copy_no > 1", "Duplicate product; "),
    ("product_width_cm < 0", "Product width is negative; "),
)
_SAID = ", ".join(f"if({test}, '{text}', NULL)" for test, text in MESSAGES)

VALIDATED_MESSAGE = f"""
  SELECT {_cols(PRODUCT_COLS)},
         nullif(array_to_string(list_filter([{_SAID}], lambda m: m IS NOT NULL), ''), '')
           AS error_flags,
         load_datetime, source_file, batch_id
  FROM (SELECT *, row_number() OVER (PARTITION BY product_id
                                     ORDER BY {_order(PRODUCT_COLS)}) AS copy_no
        FROM r_staged) v"""

# Flag columns and their order.
FLAG_EXPRS = {
    "flag_duplicates": "rn > 1",
    "flag_null_product": "product_id IS NULL",
    "flag_category_not_found": "product_category_name IS NULL",
    "flag_invalid_weight": "coalesce(product_weight_g, 0) <= 0",
    "flag_invalid_length": "coalesce(product_length_cm, 0) <= 0",
    "flag_invalid_height": "coalesce(product_height_cm, 0) <= 0",
    "flag_invalid_width": "coalesce(product_width_cm, 0) <= 0",
}

VALIDATED_FLAGS = f"""
  SELECT {_cols(RAW_COLS)},
         {", ".join(f"{e} AS {n}" for n, e in FLAG_EXPRS.items())},
         NOT ({" OR ".join(FLAG_EXPRS.values())}) AS is_valid
  FROM (SELECT *, row_number() OVER (PARTITION BY product_id
                                     ORDER BY {_order(RAW_COLS)}) AS rn
        FROM r_raw_products) v"""

MESSAGE_RULE_EXPRS = {
    "category_null": "product_category_name IS NULL",
    "id_null": "product_id IS NULL",
    "weight_negative": "product_weight_g < 0",
    "length_negative": "product_length_cm < 0",
    "height_negative": "product_height_cm < 0",
    "duplicate": "row_num > 1",
    "width_negative": "product_width_cm < 0",
}


def _ctes(*names):
    table = {"r_staged": STAGED, "r_validated": VALIDATED_MESSAGE,
             "r_flagged": VALIDATED_FLAGS}
    return [(n, table[n]) for n in names]


def q(body: str, *ctes: str) -> str:
    return with_proxies(body, *_ctes(*ctes))


ETL_STAGE = q("SELECT * FROM r_staged", "r_staged")
ETL_VALIDATE_MESSAGE = q("SELECT * FROM r_validated", "r_staged", "r_validated")
ETL_VALIDATE_FLAGS = q("SELECT * FROM r_flagged", "r_flagged")
ETL_ERROR_ROWS = q(f"""SELECT {_cols(PRODUCT_COLS)}, error_flags, load_datetime,
  source_file, batch_id FROM r_validated WHERE error_flags IS NOT NULL""",
                   "r_staged", "r_validated")
ETL_CLEAN_ROWS = q(f"""SELECT {_cols(PRODUCT_COLS)}, load_datetime, batch_id
  FROM r_validated WHERE error_flags IS NULL""", "r_staged", "r_validated")
ETL_ERROR_FLAGS_ROWS = q(f"""SELECT {_cols(RAW_COLS)}, {", ".join(FLAG_EXPRS)}
  FROM r_flagged WHERE NOT is_valid""", "r_flagged")
ETL_CLEAN_FLAGS_ROWS = q("""
SELECT regexp_replace(product_id, '^\\s+|\\s+$', '', 'g') AS product_id,
       regexp_replace(product_category_name, '^\\s+|\\s+$', '', 'g') AS product_category_name,
       CAST(product_name_lenght AS BIGINT) AS product_name_length,
       CAST(product_description_lenght AS BIGINT) AS product_description_length,
       CAST(product_photos_qty AS BIGINT) AS product_photos_qty,
       CAST(product_weight_g AS DOUBLE) AS product_weight_g,
       CAST(product_length_cm AS DOUBLE) AS product_length_cm,
       CAST(product_height_cm AS DOUBLE) AS product_height_cm,
       CAST(product_width_cm AS DOUBLE) AS product_width_cm
FROM r_flagged WHERE is_valid""", "r_flagged")

_RULE_COUNTS_FLAGS = " UNION ALL ".join(
    ["SELECT 'flags' AS profile, 'total' AS rule, count(*) AS n_rows FROM r_flagged",
     "SELECT 'flags', 'valid', count(*) FILTER (WHERE is_valid) FROM r_flagged",
     "SELECT 'flags', 'rejected', count(*) FILTER (WHERE NOT is_valid) FROM r_flagged"]
    + [f"SELECT 'flags', '{n}', count(*) FILTER (WHERE {n}) FROM r_flagged"
       for n in FLAG_EXPRS])
_MSG_FLAGS = f"""
  SELECT {", ".join(f"coalesce({e}, false) AS {n}" for n, e in MESSAGE_RULE_EXPRS.items())}
  FROM (SELECT *, row_number() OVER (PARTITION BY product_id
                                     ORDER BY {_order(PRODUCT_COLS)}) AS row_num
        FROM r_staged) v"""
_RULE_COUNTS_MSG = " UNION ALL ".join(
    ["SELECT 'message', 'total', count(*) FROM r_msgflags",
     f"SELECT 'message', 'valid', count(*) FILTER (WHERE NOT ({' OR '.join(MESSAGE_RULE_EXPRS)})) FROM r_msgflags",
     f"SELECT 'message', 'rejected', count(*) FILTER (WHERE {' OR '.join(MESSAGE_RULE_EXPRS)}) FROM r_msgflags"]
    + [f"SELECT 'message', '{n}', count(*) FILTER (WHERE {n}) FROM r_msgflags"
       for n in MESSAGE_RULE_EXPRS])
ETL_RULE_COUNTS = with_proxies(f"""
SELECT * FROM ({_RULE_COUNTS_FLAGS} UNION ALL {_RULE_COUNTS_MSG}) t
WHERE rule IN ('total', 'valid', 'rejected') OR n_rows > 0""",
                               *_ctes("r_staged", "r_flagged"), ("r_msgflags", _MSG_FLAGS))

ETL_AUDIT_ROW = q("""
SELECT 'products' AS table_name,
       count(*) FILTER (WHERE error_flags IS NULL) AS rows_loaded,
       count(*) FILTER (WHERE error_flags IS NOT NULL) AS rows_rejected,
       'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS error_message
FROM r_validated""", "r_staged", "r_validated")

DQ_SINGLE_RULE = q(f"""
SELECT {_cols(PRODUCT_COLS)}, true AS flag_error,
       'Product category name is null' AS error_description
FROM r_staged WHERE product_category_name IS NULL""", "r_staged")

DQ_STRICT_RULES = q(f"""
SELECT product_id,
       CASE WHEN s.product_category_name IS NULL THEN 'undefined'
            ELSE cn.product_category_name_english END AS product_category_name,
       {_cols(PRODUCT_COLS[2:], "s.")},
       nullif(concat(
         CASE WHEN product_id IS NULL THEN 'Product id is null; ' END,
         CASE WHEN s.product_category_name IS NOT NULL
                   AND cn.product_category_name_english IS NULL
              THEN 'Product category not found; ' END,
         CASE WHEN product_photos_qty IS NULL THEN 'Product photos quantity is null; ' END,
         CASE WHEN coalesce(product_description_length, 0) <= 0
              THEN 'Product description is missing; ' END,
         CASE WHEN product_weight_g IS NULL THEN 'Product weight is null; ' END,
         CASE WHEN product_length_cm IS NULL THEN 'Product length is null; ' END,
         CASE WHEN product_height_cm IS NULL THEN 'Product height is null; ' END,
         CASE WHEN product_width_cm IS NULL THEN 'Product width is null; ' END),
         '') AS error_flags
FROM r_staged s LEFT JOIN r_catnames cn
  ON s.product_category_name = cn.product_category_name""", "r_staged")


def _entity(proxy: str, cols: list[str], source: str, key: str, rules: dict) -> str:
    msgs = ",\n           ".join(f"CASE WHEN {e} THEN '{m}' END" for m, e in rules.items())
    return with_proxies(f"""
SELECT {_cols(cols)}, {LOAD_TS_SQL} AS load_datetime, '{source}' AS source_file,
       CAST(1 AS INTEGER) AS batch_id,
       nullif(concat({msgs}), '') AS error_flags
FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {_order(cols)}) AS rn
      FROM {proxy}) v""")


ETL_CUSTOMERS = _entity(
    "r_customers",
    ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
     "customer_state"], "customers.csv", "customer_id",
    {"Customer id is null; ": "customer_id IS NULL",
     "Customer unique id is null; ": "customer_unique_id IS NULL",
     "Duplicate customer; ": "rn > 1"})

ETL_ORDERS = _entity(
    "r_orders",
    ["order_id", "customer_id", "order_status", "order_purchase_timestamp",
     "order_approved_at", "order_delivered_carrier_date",
     "order_delivered_customer_date", "order_estimated_delivery_date"],
    "orders.csv", "order_id",
    {"Order id is null; ": "order_id IS NULL",
     "Customer id is null; ": "customer_id IS NULL",
     "Duplicate order; ": "rn > 1"})

PROFILE_HEAD = with_proxies("""
SELECT * FROM r_orders ORDER BY order_id LIMIT 5""")
