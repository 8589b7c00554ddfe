"""Independent SQL oracle (DuckDB dialect) for every registered query.

Each statement reads the pre-registered views (``orders``, ``lineitem``, ...)
through the same retail proxies as ``souk.sources.proxies`` (FIXTURES.md §3),
written here in SQL. Money is summed as exact decimals on both sides.
"""

from __future__ import annotations

import re

PROXIES = {
    "r_customers": """
  SELECT c.c_custkey AS customer_id, c.c_custkey // 2 AS customer_unique_id,
         lpad(CAST(c.c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
         n.n_name || '_' || c.c_mktsegment AS customer_city,
         n.n_name AS customer_state
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "r_geo": """
  SELECT lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
         'CITY_' || CAST(s_nationkey AS VARCHAR) || '_' || CAST(s_suppkey % 3 AS VARCHAR)
           AS geolocation_city
  FROM supplier""",
    "r_orders": """
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                            WHEN 'P' THEN 'canceled' END AS order_status,
         o_orderdate AS order_purchase_timestamp,
         o_orderdate + to_days(CAST(o_orderkey % 3 AS INTEGER)) AS order_approved_at,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderdate
              + to_days(CAST(o_orderkey % 3 + 1 + o_orderkey % 5 AS INTEGER)) END
           AS order_delivered_carrier_date,
         CASE WHEN o_orderstatus = 'F' THEN o_orderdate
              + to_days(CAST(o_orderkey % 3 + 1 + o_orderkey % 5 + 2 + (o_orderkey * 7) % 29
                             AS INTEGER)) END AS order_delivered_customer_date,
         o_orderdate + to_days(CAST(20 + o_orderkey % 11 AS INTEGER))
           AS order_estimated_delivery_date
  FROM orders""",
    "r_items": """
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
         l_suppkey AS seller_id, l_extendedprice AS price, l_quantity AS quantity,
         l_extendedprice * l_tax AS freight_value,
         CAST(l_extendedprice AS DECIMAL(18, 6)) * 100 AS price_cents
  FROM lineitem""",
    "r_products": """
  SELECT p_partkey AS product_id,
         CASE WHEN p_partkey % 37 <> 0 THEN p_type END AS product_category_name
  FROM part""",
    "r_catnames": """
  SELECT * FROM (VALUES ('ECONOMY', 'economy_en'), ('SMALL', 'small_en'),
                        ('STANDARD', 'standard_en'), ('PROMO', 'promo_en'),
                        ('LARGE', 'large_en'))
    AS t(product_category_name, product_category_name_english)""",
    "r_sellers": """
  SELECT s.s_suppkey AS seller_id, n.n_name AS seller_state, r.r_name AS seller_region
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "r_reviews": """
  SELECT o_orderkey AS order_id,
         CAST(1 + (o_orderkey * 13 + o_custkey) % 5 AS INTEGER) AS review_score
  FROM orders""",
    "r_payments": """
  SELECT o_orderkey AS order_id, o_orderpriority AS payment_type,
         CAST(1 + o_orderkey % 12 AS INTEGER) AS payment_installments,
         o_totalprice AS payment_value
  FROM orders""",
    "r_raw_products": """
  SELECT CASE WHEN p_partkey % 101 <> 50 THEN CAST(p_partkey AS VARCHAR) END AS product_id,
         CASE WHEN p_partkey % 37 = 0 THEN NULL
              WHEN p_partkey % 43 = 1 THEN '  ' || p_type || ' '
              ELSE p_type END AS product_category_name,
         CAST(length(p_name) AS INTEGER) AS product_name_lenght,
         CAST(length(p_name) * p_size AS INTEGER) AS product_description_lenght,
         CASE WHEN p_partkey % 29 <> 3 THEN p_size % 7 END AS product_photos_qty,
         CASE WHEN p_partkey % 41 = 2 THEN -5
              WHEN p_partkey % 47 = 3 THEN NULL
              WHEN p_partkey % 59 = 4 THEN 0
              ELSE p_size * 100 END AS product_weight_g,
         CASE WHEN p_partkey % 61 = 5 THEN -1 ELSE p_size END AS product_length_cm,
         CASE WHEN p_partkey % 67 = 6 THEN -1 ELSE p_size + 1 END AS product_height_cm,
         CASE WHEN p_partkey % 71 = 7 THEN -1 ELSE p_size + 2 END AS product_width_cm
  FROM (SELECT * FROM part UNION ALL SELECT * FROM part WHERE p_partkey % 53 = 8)""",
}


# The same tables with the faults of real data, over all rows: orders without a
# date, customers without a person, products listed twice.
PROXIES |= {
    "d_orders": """
  SELECT * REPLACE (CASE WHEN order_id % 97 <> 5 THEN order_purchase_timestamp END
                    AS order_purchase_timestamp) FROM r_orders""",
    "d_customers": """
  SELECT * REPLACE (CASE WHEN customer_id % 11 <> 3 THEN customer_unique_id END
                    AS customer_unique_id) FROM r_customers""",
    "d_products": """
  SELECT * FROM r_products UNION ALL SELECT * FROM r_products WHERE product_id % 13 = 4""",
}


def dirty_proxies(sql: str) -> str:
    for name in ("orders", "customers", "products"):
        sql = re.sub(rf"\br_{name}\b", f"d_{name}", sql)
    return sql


def with_proxies(body: str, *extra: tuple[str, str]) -> str:
    """Prefix ``body`` with the proxy CTEs it needs plus ``extra`` CTEs."""
    text = "\n".join([body, *(e for _, e in extra)])
    need: set[str] = set()
    todo = [n for n in PROXIES if n in text]
    while todo:
        name = todo.pop()
        if name not in need:
            need.add(name)
            todo += [n for n in PROXIES if n in PROXIES[name]]
    ctes = [(n, PROXIES[n]) for n in PROXIES if n in need] + list(extra)
    head = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in ctes)
    return f"WITH {head}\n{body}" if ctes else body


def ratio_sql(num: str, den: str, scale: int) -> str:
    """round(num*100/den, scale) with decimal half-up rounding, NULL on 0."""
    return (f"CAST(round(CAST(CAST({num} AS DOUBLE) * 100.0 / "
            f"nullif(CAST({den} AS DOUBLE), 0) AS DECIMAL(38, 10)), {scale}) AS DOUBLE)")
