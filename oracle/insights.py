"""Oracle SQL for the extension analyses and the churn-over-time form."""

from __future__ import annotations

from souk.catalog import QUIET_MONTHS, SET_SUPPORT

from . import ratio_sql, with_proxies
from .etl import PRODUCT_COLS, STAGED, VALIDATED_MESSAGE, _cols

# the two loads of x_incremental_load: together all rows, keys in both too
FIRST_LOAD = "coalesce(CAST(product_id AS BIGINT), 0) % 3 <> 0"
SECOND_LOAD = ("coalesce(CAST(product_id AS BIGINT), 0) % 3 = 0 "
               "OR CAST(product_id AS BIGINT) % 2 = 0")


def rnd(expr: str, n: int) -> str:
    """Decimal half-up rounding of a double, like Spark's round."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38, 10)), {n}) AS DOUBLE)"


def avg_(total: str, n: str, scale: int) -> str:
    return rnd(f"CAST({total} AS DOUBLE) / nullif(CAST({n} AS DOUBLE), 0)", scale)


DELIVERED = """order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL
  AND order_purchase_timestamp IS NOT NULL"""


def dd(a: str, b: str) -> str:
    return f"date_diff('day', CAST({a} AS DATE), CAST({b} AS DATE))"


OC = ("oc", """
  SELECT DISTINCT i.order_id, coalesce(p.product_category_name, 'Misc') AS category
  FROM r_items i JOIN r_products p ON i.product_id = p.product_id""")
OS = ("os", "SELECT DISTINCT order_id, seller_id FROM r_items")
DELAY = ("dl", f"""
  SELECT o.order_id, {dd('order_estimated_delivery_date', 'order_delivered_customer_date')}
         AS delay, r.review_score
  FROM r_orders o JOIN r_reviews r ON o.order_id = r.order_id
  WHERE {DELIVERED} AND order_estimated_delivery_date IS NOT NULL""")


def money(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE) / 100.0, 2)"


Q = {}

Q["q_churn_over_time"] = with_proxies(f"""
SELECT cutoff,
       count(*) FILTER (WHERE l < cutoff) AS Churned_Customers,
       count(*) FILTER (WHERE f < cutoff) AS Eligible_Customers,
       {ratio_sql('count(*) FILTER (WHERE l < cutoff)', 'count(*) FILTER (WHERE f < cutoff)', 2)}
         AS Churn_Rate
FROM tl, cut GROUP BY cutoff""", ("tl", """
  SELECT c.customer_unique_id, min(CAST(o.order_purchase_timestamp AS DATE)) AS f,
         max(CAST(o.order_purchase_timestamp AS DATE)) AS l
  FROM r_orders o JOIN r_customers c ON o.customer_id = c.customer_id GROUP BY 1"""),
                                  ("cut", """
  SELECT CAST(x AS DATE) AS cutoff
  FROM (VALUES ('1997-01-01'), ('1999-01-01'), ('2001-01-01')) t(x)"""))

Q["x_revenue_per_seller"] = with_proxies(f"""
SELECT count(*) AS sellers, {money('sum(cents)')} AS total_revenue,
       {rnd('CAST(sum(cents) AS DOUBLE) / count(*) / 100.0', 2)} AS avg_revenue_per_seller
FROM (SELECT seller_id, sum(price_cents) AS cents FROM r_items GROUP BY seller_id) s""")

Q["x_cancellation_impact"] = with_proxies(f"""
SELECT count(*) AS orders, count(*) FILTER (WHERE c) AS canceled_orders,
       {ratio_sql('count(*) FILTER (WHERE c)', 'count(*)', 2)} AS cancellation_rate,
       {money('sum(CASE WHEN c THEN coalesce(rev_cents, 0) ELSE 0 END)')} AS canceled_revenue,
       {ratio_sql('sum(CASE WHEN c THEN coalesce(rev_cents, 0) ELSE 0 END)',
                  'sum(coalesce(rev_cents, 0))', 2)} AS canceled_revenue_share
FROM (SELECT o.order_id, o.order_status = 'canceled' AS c, po.rev_cents
      FROM r_orders o LEFT JOIN po ON o.order_id = po.order_id) t""",
                                          ("po", """
  SELECT order_id, sum(price_cents) AS rev_cents FROM r_items GROUP BY order_id"""))

Q["x_state_revenue_corr"] = with_proxies(f"""
SELECT count(*) AS states,
       {rnd('corr(cents / 100.0, CAST(persons AS DOUBLE))', 6)} AS revenue_customers_corr
FROM (SELECT c.customer_state, sum(i.price_cents) AS cents,
             count(DISTINCT c.customer_unique_id) AS persons
      FROM r_orders o JOIN r_items i ON o.order_id = i.order_id
      JOIN r_customers c ON o.customer_id = c.customer_id
      GROUP BY c.customer_state) s""")

Q["x_delivery_actual_vs_est"] = with_proxies(f"""
SELECT count(*) AS orders, {avg_('sum(a)', 'count(*)', 2)} AS avg_actual_days,
       {avg_('sum(e)', 'count(*)', 2)} AS avg_estimated_days,
       {avg_('sum(g)', 'count(*)', 2)} AS avg_gap_days,
       {ratio_sql('count(*) FILTER (WHERE g > 0)', 'count(*)', 2)} AS late_share
FROM (SELECT {dd('order_purchase_timestamp', 'order_delivered_customer_date')} AS a,
             {dd('order_purchase_timestamp', 'order_estimated_delivery_date')} AS e,
             {dd('order_estimated_delivery_date', 'order_delivered_customer_date')} AS g
      FROM r_orders WHERE {DELIVERED} AND order_estimated_delivery_date IS NOT NULL) t""")

_SHIP = ("sd", f"""
  SELECT os.seller_id, count(*) AS orders, CAST(sum(days) AS DOUBLE) / count(*) AS avg_ship_days
  FROM os JOIN (SELECT order_id,
                       {dd('order_purchase_timestamp', 'order_delivered_customer_date')} AS days
                FROM r_orders WHERE {DELIVERED}) d ON os.order_id = d.order_id
  GROUP BY os.seller_id""")

Q["x_slowest_sellers"] = with_proxies(f"""
SELECT sd.seller_id, s.seller_state, sd.orders, {rnd('sd.avg_ship_days', 2)} AS avg_ship_days
FROM (SELECT * FROM sd ORDER BY avg_ship_days DESC, seller_id LIMIT 10) sd
LEFT JOIN r_sellers s ON sd.seller_id = s.seller_id""", OS, _SHIP)

Q["x_seller_ship_time"] = with_proxies(f"""
SELECT seller_id, orders, {rnd('avg_ship_days', 2)} AS avg_ship_days FROM sd""", OS, _SHIP)

Q["x_ship_lag"] = with_proxies(f"""
SELECT os.seller_id, count(*) AS orders, {avg_('sum(lag)', 'count(*)', 2)} AS avg_ship_lag_days
FROM os JOIN (SELECT order_id, {dd('order_approved_at', 'order_delivered_carrier_date')} AS lag
              FROM r_orders WHERE order_approved_at IS NOT NULL
                AND order_delivered_carrier_date IS NOT NULL) o ON os.order_id = o.order_id
GROUP BY os.seller_id""", OS)

Q["x_category_cancel_rate"] = with_proxies(f"""
SELECT oc.category AS product_category_name, count(*) AS orders,
       count(*) FILTER (WHERE o.order_status = 'canceled') AS canceled_orders,
       {ratio_sql("count(*) FILTER (WHERE o.order_status = 'canceled')", 'count(*)', 2)}
         AS cancel_rate
FROM oc JOIN r_orders o ON oc.order_id = o.order_id GROUP BY oc.category""", OC)

Q["x_holiday_products"] = with_proxies(f"""
SELECT order_year, rank, product_id, {money('cents')} AS revenue, units
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY order_year
                                        ORDER BY cents DESC, product_id) AS INTEGER) AS rank
      FROM (SELECT CAST(year(o.order_purchase_timestamp) AS INTEGER) AS order_year,
                   i.product_id, sum(i.price_cents) AS cents, sum(i.quantity) AS units
            FROM r_items i JOIN r_orders o ON i.order_id = o.order_id
            WHERE month(o.order_purchase_timestamp) IN (11, 12)
            GROUP BY 1, 2) per) t
WHERE rank <= 10""")

Q["x_top_sellers"] = with_proxies(f"""
SELECT metric, rank, seller_id, {rnd('value', 2)} AS value
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY metric
                                        ORDER BY value DESC, seller_id) AS INTEGER) AS rank
      FROM (SELECT seller_id, 'revenue' AS metric, CAST(cents AS BIGINT) / 100.0 AS value
            FROM per
            UNION ALL
            SELECT seller_id, 'volume', CAST(items AS DOUBLE) FROM per) l) t
WHERE rank <= 10""", ("per", """
  SELECT seller_id, sum(price_cents) AS cents, count(*) AS items FROM r_items
  GROUP BY seller_id"""))

Q["x_seller_retention"] = with_proxies(f"""
SELECT count(*) AS sellers, count(*) FILTER (WHERE l >= CAST(f + INTERVAL 6 MONTH AS DATE))
         AS retained_sellers,
       count(*) - count(*) FILTER (WHERE l >= CAST(f + INTERVAL 6 MONTH AS DATE))
         AS dropped_sellers,
       {ratio_sql('count(*) FILTER (WHERE l >= CAST(f + INTERVAL 6 MONTH AS DATE))', 'count(*)', 2)}
         AS retention_rate
FROM (SELECT os.seller_id, min(CAST(o.order_purchase_timestamp AS DATE)) AS f,
             max(CAST(o.order_purchase_timestamp AS DATE)) AS l
      FROM os JOIN r_orders o ON os.order_id = o.order_id GROUP BY os.seller_id) per""", OS)



def retention_curve(who: str, source: str, quiet: int, *extra: tuple[str, str]) -> str:
    """The product-limit estimate: who was at risk in each month, by counting."""
    return with_proxies(f"""
SELECT CAST(t AS INTEGER) AS months_since_first, CAST(n AS BIGINT) AS at_risk,
       CAST(d AS BIGINT) AS dropped, CAST(c AS BIGINT) AS censored,
       {rnd('(SELECT product(1.0 - e.d / e.n) FROM sets e WHERE e.t <= sets.t)', 6)}
         AS retained_share
FROM sets""", *extra, ("active", f"""
  SELECT {who} AS who, year(o.order_purchase_timestamp) * 12
         + month(o.order_purchase_timestamp) - 1 AS m
  FROM {source} WHERE {who} IS NOT NULL AND o.order_purchase_timestamp IS NOT NULL"""),
        ("spans", f"""
  SELECT who, max(m) - min(m) AS t, (SELECT max(m) FROM active) - max(m) >= {quiet} AS gone
  FROM active GROUP BY who"""),
        ("sets", """
  SELECT x.t, any_value(x.d) AS d, any_value(x.c) AS c, count(*) AS n
  FROM (SELECT t, count(*) FILTER (gone) AS d, count(*) FILTER (NOT gone) AS c
        FROM spans GROUP BY t) x JOIN spans s ON s.t >= x.t GROUP BY x.t"""))


Q["x_seller_retention_curve"] = retention_curve(
    "os.seller_id", "os JOIN r_orders o ON os.order_id = o.order_id", QUIET_MONTHS, OS)
Q["x_customer_retention_curve"] = retention_curve(
    "c.customer_unique_id", "r_orders o JOIN r_customers c ON o.customer_id = c.customer_id", 6)

Q["x_region_performance"] = with_proxies(f"""
SELECT per.seller_region, {money('sum(per.cents)')} AS revenue, count(*) AS orders,
       {avg_('sum(d.days)', 'count(d.days)', 2)} AS avg_delivery_days
FROM (SELECT i.order_id, s.seller_region, sum(i.price_cents) AS cents
      FROM r_items i JOIN r_sellers s ON i.seller_id = s.seller_id GROUP BY 1, 2) per
LEFT JOIN (SELECT order_id, {dd('order_purchase_timestamp', 'order_delivered_customer_date')}
                  AS days FROM r_orders WHERE {DELIVERED}) d ON per.order_id = d.order_id
GROUP BY per.seller_region""")

Q["x_delay_vs_review"] = with_proxies(f"""
SELECT delay > 0 AS is_delayed, count(*) AS orders,
       {avg_('sum(review_score)', 'count(*)', 4)} AS avg_review_score,
       (SELECT {rnd('corr(CAST(delay AS DOUBLE), CAST(review_score AS DOUBLE))', 6)} FROM dl)
         AS delay_score_corr
FROM dl GROUP BY delay > 0""", DELAY)

# Easter Sundays of the years that the test data covers.
EASTER = ("easter", """
  SELECT CAST(x AS DATE) AS sunday FROM (VALUES ('1992-04-19'), ('1993-04-11'),
    ('1994-04-03'), ('1995-04-16'), ('1996-04-07'), ('1997-03-30'), ('1998-04-12'),
    ('1999-04-04'), ('2000-04-23'), ('2001-04-15'), ('2002-03-31')) t(x)""")

Q["x_weekend_holiday_delay"] = with_proxies(f"""
SELECT CASE WHEN (month(d.ts), day(d.ts)) IN ((1, 1), (4, 21), (5, 1), (9, 7), (10, 12),
                                              (11, 2), (11, 15), (12, 25)) THEN 'holiday'
            WHEN EXISTS (SELECT 1 FROM easter e
                         WHERE date_diff('day', e.sunday, CAST(d.ts AS DATE))
                               IN (-48, -47, -2, 60)) THEN 'holiday'
            WHEN isodow(d.ts) IN (6, 7) THEN 'weekend' ELSE 'weekday' END AS day_type,
       count(*) AS orders, {avg_('sum(days)', 'count(*)', 2)} AS avg_delivery_days,
       {avg_('sum(delay)', 'count(*)', 2)} AS avg_delay_days,
       {ratio_sql('count(*) FILTER (WHERE delay > 0)', 'count(*)', 2)} AS late_share
FROM (SELECT order_purchase_timestamp AS ts,
             {dd('order_purchase_timestamp', 'order_delivered_customer_date')} AS days,
             {dd('order_estimated_delivery_date', 'order_delivered_customer_date')} AS delay
      FROM r_orders WHERE {DELIVERED} AND order_estimated_delivery_date IS NOT NULL) d
GROUP BY 1""", EASTER)

Q["x_category_5v1"] = with_proxies(f"""
SELECT oc.category AS product_category_name,
       count(*) FILTER (WHERE r.review_score = 5) AS five_star_orders,
       count(*) FILTER (WHERE r.review_score = 1) AS one_star_orders,
       {avg_('count(*) FILTER (WHERE r.review_score = 5)',
             'count(*) FILTER (WHERE r.review_score = 1)', 4)} AS five_to_one_ratio
FROM oc JOIN r_reviews r ON oc.order_id = r.order_id GROUP BY oc.category""", OC)

Q["x_category_avg_score"] = with_proxies(f"""
SELECT oc.category AS product_category_name, count(*) AS reviews,
       {avg_('sum(r.review_score)', 'count(*)', 4)} AS avg_review_score
FROM oc JOIN r_reviews r ON oc.order_id = r.order_id GROUP BY oc.category""", OC)

Q["x_seller_rating"] = with_proxies(f"""
SELECT seller_id, reviews, {rnd('a', 4)} AS avg_review_score
FROM (SELECT os.seller_id, count(*) AS reviews,
             CAST(sum(r.review_score) AS DOUBLE) / count(*) AS a
      FROM os JOIN r_reviews r ON os.order_id = r.order_id
      GROUP BY os.seller_id HAVING count(*) >= 5) per
ORDER BY a DESC, seller_id LIMIT 10""", OS)

Q["x_seller_rating_all"] = with_proxies(f"""
SELECT os.seller_id, count(*) AS reviews,
       {avg_('sum(r.review_score)', 'count(*)', 4)} AS avg_review_score
FROM os JOIN r_reviews r ON os.order_id = r.order_id GROUP BY os.seller_id""", OS)


def _slowest(place: str) -> str:
    return with_proxies(f"""
SELECT s.{place}, CAST(sum(n) AS BIGINT) AS orders,
       {avg_('sum(days)', 'sum(n)', 2)} AS avg_ship_days
FROM (SELECT os.seller_id, count(*) AS n, sum(
             {dd('order_purchase_timestamp', 'order_delivered_customer_date')}) AS days
      FROM os JOIN r_orders o ON o.order_id = os.order_id WHERE {DELIVERED}
      GROUP BY os.seller_id) t
LEFT JOIN r_sellers s USING (seller_id) GROUP BY s.{place}""", OS)


Q["x_slowest_regions"] = _slowest("seller_region")
Q["x_slowest_states"] = _slowest("seller_state")

Q["x_poor_sellers"] = with_proxies("""
SELECT seller_id, count(*) FILTER (WHERE a < 3.0) AS poor_months, count(*) AS active_months
FROM (SELECT os.seller_id, strftime(o.order_purchase_timestamp, '%Y-%m') AS month,
             CAST(sum(r.review_score) AS DOUBLE) / count(*) AS a
      FROM os JOIN r_reviews r ON os.order_id = r.order_id
      JOIN r_orders o ON os.order_id = o.order_id GROUP BY 1, 2) m
GROUP BY seller_id HAVING count(*) FILTER (WHERE a < 3.0) >= 3""", OS)

Q["x_score_by_delay"] = with_proxies(
    "SELECT CASE WHEN delay <= 0 THEN 'on_time' WHEN delay <= 3 THEN 'late_1_3' "
    "WHEN delay <= 7 THEN 'late_4_7' ELSE 'late_8_plus' END AS delay_bucket, "
    + ", ".join(f"count(*) FILTER (WHERE review_score = {s}) AS score_{s}" for s in range(1, 6))
    + " FROM dl GROUP BY 1", DELAY)

Q["x_price_vs_score"] = with_proxies(f"""
SELECT count(*) AS items,
       {rnd('corr(i.price, CAST(r.review_score AS DOUBLE))', 6)} AS price_score_corr,
       {rnd('regr_slope(CAST(r.review_score AS DOUBLE), i.price / 1000.0)', 6)}
         AS score_per_1000
FROM r_items i JOIN r_reviews r ON i.order_id = r.order_id""")

_PAY = ("pay", """
  SELECT payment_type, payment_value, payment_installments,
         CAST(payment_value AS DECIMAL(18, 6)) * 100 AS cents FROM r_payments""")

Q["x_payment_mix"] = with_proxies(f"""
SELECT payment_type, payments,
       {ratio_sql('payments', '(SELECT sum(payments) FROM per)', 2)} AS share,
       {money('cents')} AS total_value
FROM per""", _PAY, ("per", """
  SELECT payment_type, count(*) AS payments, sum(cents) AS cents FROM pay GROUP BY 1"""))

Q["x_payment_vs_value"] = with_proxies(f"""
SELECT payment_type, count(*) AS payments,
       {rnd('CAST(sum(cents) AS DOUBLE) / count(*) / 100.0', 2)} AS avg_value,
       quantile_disc(payment_value, 0.5) AS median_value,
       max(payment_value) AS max_value,
       {avg_('sum(payment_installments)', 'count(*)', 4)} AS avg_installments
FROM pay GROUP BY payment_type""", _PAY)

Q["x_installments_by_category"] = with_proxies(f"""
SELECT oc.category AS product_category_name, count(*) AS payments,
       {avg_('sum(p.payment_installments)', 'count(*)', 4)} AS avg_installments
FROM oc JOIN r_payments p ON oc.order_id = p.order_id GROUP BY oc.category""", OC)

Q["x_installments_by_value"] = with_proxies(f"""
SELECT value_band, count(*) AS payments, min(payment_value) AS min_value,
       max(payment_value) AS max_value,
       {avg_('sum(payment_installments)', 'count(*)', 4)} AS avg_installments,
       {ratio_sql('count(*) FILTER (WHERE payment_installments > 1)', 'count(*)', 2)}
         AS multi_installment_share
FROM (SELECT CAST(ntile(4) OVER (ORDER BY payment_value, order_id, payment_installments,
                                          payment_type) AS INTEGER) AS value_band,
             payment_value, payment_installments
      FROM r_payments WHERE payment_value IS NOT NULL) t
GROUP BY value_band""")

Q["x_cohort"] = with_proxies("""
SELECT printf('%04d-%02d', first_m // 12, first_m % 12 + 1) AS cohort_month,
       CAST(m - first_m AS INTEGER) AS months_since, count(*) AS active_customers
FROM act JOIN (SELECT customer_unique_id, min(m) AS first_m FROM act GROUP BY 1) f
  ON act.customer_unique_id = f.customer_unique_id
GROUP BY first_m, m - first_m""", ("act", """
  SELECT DISTINCT c.customer_unique_id,
         year(o.order_purchase_timestamp) * 12 + month(o.order_purchase_timestamp) - 1 AS m
  FROM r_orders o JOIN r_customers c ON o.customer_id = c.customer_id"""))

_CATSETS = ("pairs", """
  SELECT a.category AS category_a, b.category AS category_b, count(*) AS orders
  FROM oc a JOIN oc b ON a.order_id = b.order_id AND a.category < b.category
  GROUP BY 1, 2""")
_SINGLE = ("single", "SELECT category, count(*) AS n FROM oc GROUP BY 1")

Q["x_basket_pairs"] = with_proxies(f"""
SELECT category_a, category_b, orders,
       {rnd('orders / tot.n', 6)} AS support,
       {rnd('(orders * tot.n) / (sa.n * sb.n)', 6)} AS lift
FROM pairs JOIN single sa ON sa.category = category_a
JOIN single sb ON sb.category = category_b,
     (SELECT count(DISTINCT order_id) AS n FROM oc) tot""", OC, _CATSETS, _SINGLE)

Q["x_recommend"] = with_proxies("""
SELECT r.category, r.rank, r.partner_category, r.orders AS co_orders, b.top_product_id
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY category
                                        ORDER BY orders DESC, partner_category) AS INTEGER)
                AS rank
      FROM (SELECT category_a AS category, category_b AS partner_category, orders FROM pairs
            UNION ALL
            SELECT category_b, category_a, orders FROM pairs) u) r
LEFT JOIN (SELECT partner_category, product_id AS top_product_id
           FROM (SELECT coalesce(p.product_category_name, 'Misc') AS partner_category,
                        i.product_id,
                        row_number() OVER (PARTITION BY coalesce(p.product_category_name, 'Misc')
                                           ORDER BY sum(i.price_cents) DESC, i.product_id) AS rn
                 FROM r_items i JOIN r_products p ON i.product_id = p.product_id
                 GROUP BY p.product_category_name, i.product_id) x
           WHERE rn = 1) b ON r.partner_category = b.partner_category
WHERE r.rank <= 3""", OC, _CATSETS)

# item to item: every pair of every order, counted
Q["x_recommend_items"] = with_proxies(f"""
SELECT product_id, CAST(rank AS INTEGER) AS rank, similar_id, orders,
       {rnd('cosine', 6)} AS similarity
FROM (SELECT *, row_number() OVER (PARTITION BY product_id
                                   ORDER BY cosine DESC, orders DESC, similar_id) AS rank
      FROM (SELECT a.product_id, b.product_id AS similar_id, count(*) AS orders,
                   count(*) / sqrt(any_value(na.n) * any_value(nb.n)) AS cosine
            FROM bought a JOIN bought b
              ON a.order_id = b.order_id AND a.product_id <> b.product_id
            JOIN per na ON na.product_id = a.product_id
            JOIN per nb ON nb.product_id = b.product_id
            GROUP BY 1, 2 HAVING count(*) >= 2) p) r
WHERE rank <= 3""", ("bought", "SELECT DISTINCT order_id, product_id FROM r_items"),
                                ("per", "SELECT product_id, count(*) AS n FROM bought GROUP BY 1"))

# sets grown by one larger category at a time, order by order
Q["x_basket_sets"] = with_proxies(f"""
SELECT array_to_string(items, ' + ') AS categories, CAST(len(items) AS INTEGER) AS n_items,
       orders, {rnd('orders / n', 6)} AS support
FROM (WITH RECURSIVE grown AS (
        SELECT order_id, [category] AS items FROM oc
        UNION ALL
        SELECT g.order_id, list_append(g.items, o.category)
        FROM grown g JOIN oc o ON o.order_id = g.order_id AND o.category > g.items[-1]
        WHERE len(g.items) < 8)
      SELECT items, count(*) AS orders FROM grown WHERE len(items) > 1 GROUP BY items) s,
     (SELECT count(DISTINCT order_id) AS n FROM oc) t
WHERE orders >= {SET_SUPPORT} * n""", OC)

Q["x_forecast"] = with_proxies(f"""
SELECT CAST(m1 + h - m0 AS INTEGER) AS month_index,
       printf('%04d-%02d', (m1 + h) // 12, (m1 + h) % 12 + 1) AS month_label,
       {rnd('(a + b * (m1 + h - m0)) / 100.0', 2)} AS forecast_revenue
FROM (SELECT *, (sy - b * sx) / n AS a
      FROM (SELECT *, (n * sxy - sx * sy) / nullif(n * sxx - sx * sx, 0) AS b
            FROM (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(m - m0) AS DOUBLE) AS sx,
                         CAST(sum(y) AS DOUBLE) AS sy,
                         CAST(sum((m - m0) * y) AS DOUBLE) AS sxy,
                         CAST(sum((m - m0) * (m - m0)) AS DOUBLE) AS sxx,
                         any_value(m0) AS m0, any_value(m1) AS m1
                  FROM monthly, (SELECT min(m) AS m0, max(m) AS m1 FROM monthly) f) s) fit) fit2,
     range(1, 4) t(h)""", ("monthly", """
  SELECT year(o.order_purchase_timestamp) * 12 + month(o.order_purchase_timestamp) - 1 AS m,
         sum(i.price_cents) AS y
  FROM r_orders o JOIN r_items i ON o.order_id = i.order_id GROUP BY 1"""))

_SAT_STATE = ("ps", f"""
  SELECT customer_state, score, days, rep
  FROM (SELECT c.customer_state, CAST(sum(r.review_score) AS DOUBLE) / count(*) AS score
        FROM r_orders o JOIN r_reviews r ON o.order_id = r.order_id
        JOIN r_customers c ON o.customer_id = c.customer_id GROUP BY 1) rv
  FULL JOIN (SELECT c.customer_state,
                    CAST(sum({dd('order_purchase_timestamp', 'order_delivered_customer_date')})
                         AS DOUBLE) / count(*) AS days
             FROM r_orders o JOIN r_customers c ON o.customer_id = c.customer_id
             WHERE {DELIVERED} GROUP BY 1) dv USING (customer_state)
  FULL JOIN (SELECT customer_state,
                    CAST(count(*) FILTER (WHERE k > 1) AS DOUBLE) / count(*) AS rep
             FROM (SELECT c.customer_state, c.customer_unique_id, count(o.order_id) AS k
                   FROM r_orders o JOIN r_customers c ON o.customer_id = c.customer_id
                   GROUP BY 1, 2) pp GROUP BY 1) rp USING (customer_state)""")


def _scaled(c: str, invert: bool = False) -> str:
    num = f"(hi_{c} - {c})" if invert else f"({c} - lo_{c})"
    return f"coalesce({num} / nullif(hi_{c} - lo_{c}, 0), 0.0)"


Q["x_satisfaction_index"] = with_proxies(f"""
SELECT customer_state, {rnd('score', 4)} AS avg_review_score,
       {rnd('days', 2)} AS avg_delivery_days, {rnd('rep * 100.0', 2)} AS repeat_share,
       {rnd(f"100.0 * (0.4 * {_scaled('score')} + 0.3 * {_scaled('days', True)} + 0.3 * {_scaled('rep')})", 2)}
         AS satisfaction_index
FROM ps, (SELECT min(score) AS lo_score, max(score) AS hi_score, min(days) AS lo_days,
                 max(days) AS hi_days, min(rep) AS lo_rep, max(rep) AS hi_rep FROM ps) mm""",
                                         _SAT_STATE)

Q["x_price_elasticity"] = with_proxies(f"""
SELECT category AS product_category_name, CAST(sum(rows) AS BIGINT) AS items,
       {rnd('regr_slope(ln(units), ln(price))', 6)} AS elasticity
FROM (SELECT coalesce(p.product_category_name, 'Misc') AS category, count(*) AS rows,
             sum(i.quantity) AS units,
             CAST(sum(i.price_cents) AS DOUBLE) / 100.0 / sum(i.quantity) AS price
      FROM r_items i JOIN r_products p USING (product_id) JOIN r_orders o USING (order_id)
      WHERE i.quantity > 0 AND i.price > 0 AND o.order_purchase_timestamp IS NOT NULL
      GROUP BY i.product_id, p.product_category_name,
               strftime(o.order_purchase_timestamp, '%Y-%m')) g
GROUP BY category""")

Q["x_incremental_load"] = with_proxies(f"""
SELECT {{cols}}, load_datetime, CAST(1 AS INTEGER) AS batch_id FROM first_checked
WHERE error_flags IS NULL
UNION ALL
SELECT {{cols}}, load_datetime, CAST(2 AS INTEGER) AS batch_id FROM second_checked s
WHERE error_flags IS NULL
  AND NOT EXISTS (SELECT 1 FROM first_checked f
                  WHERE f.error_flags IS NULL AND f.product_id = s.product_id)
""".format(cols=_cols(PRODUCT_COLS)),
    ("r_staged", STAGED),
    ("first_rows", f"SELECT * FROM r_staged WHERE {FIRST_LOAD}"),
    ("second_rows", f"SELECT * FROM r_staged WHERE {SECOND_LOAD}"),
    ("first_checked", VALIDATED_MESSAGE.replace("r_staged", "first_rows")),
    ("second_checked", VALIDATED_MESSAGE.replace("r_staged", "second_rows")))

# the batch of each even id among four loads that are validated on their own
Q["x_key_index"] = with_proxies(" UNION ALL ".join(
    f"""SELECT product_id, CAST({n + 1} AS INTEGER) AS batch FROM checked_{n}
WHERE error_flags IS NULL AND CAST(product_id AS BIGINT) % 2 = 0""" for n in range(4)),
    ("r_staged", STAGED),
    *[(f"load_{n}", "SELECT * FROM r_staged "
       f"WHERE (coalesce(CAST(product_id AS BIGINT), 0) // 7) % 4 = {n}") for n in range(4)],
    *[(f"checked_{n}", VALIDATED_MESSAGE.replace("r_staged", f"load_{n}")) for n in range(4)])

INSIGHTS = Q


Q["x_rfm"] = with_proxies(f"""
SELECT CASE WHEN r >= 4 AND f >= 4 AND m >= 4 THEN 'champions'
            WHEN f >= 4 THEN 'loyal'
            WHEN r <= 2 AND f >= 3 THEN 'at_risk'
            WHEN r <= 2 THEN 'lost'
            WHEN r >= 4 AND f <= 2 THEN 'new'
            ELSE 'regular' END AS segment,
       count(*) AS customers, {rnd('avg(recency)', 2)} AS avg_recency_days,
       {rnd('avg(frequency)', 4)} AS avg_frequency, {rnd('avg(monetary)', 2)} AS avg_monetary
FROM (SELECT base.*,
             ntile(5) OVER (ORDER BY recency DESC NULLS FIRST, customer_unique_id NULLS FIRST) AS r,
             ntile(5) OVER (ORDER BY frequency, customer_unique_id NULLS FIRST) AS f,
             ntile(5) OVER (ORDER BY monetary, customer_unique_id NULLS FIRST) AS m
      FROM base) s
GROUP BY 1""", ("po", """
  SELECT order_id, sum(price_cents) AS rev_cents FROM r_items GROUP BY order_id"""),
                          ("pp", """
  SELECT c.customer_unique_id, max(CAST(o.order_purchase_timestamp AS DATE)) AS last_d,
         count(*) AS frequency, sum(coalesce(po.rev_cents, 0)) AS cents
  FROM r_orders o LEFT JOIN po ON o.order_id = po.order_id
  JOIN r_customers c ON o.customer_id = c.customer_id GROUP BY 1"""),
                          ("base", """
  SELECT customer_unique_id,
         date_diff('day', last_d, (SELECT max(last_d) + 1 FROM pp)) AS recency,
         frequency, CAST(cents AS DOUBLE) / 100.0 AS monetary
  FROM pp"""))
