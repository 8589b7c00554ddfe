"""Registry of the named queries: key -> callable(spark, data_dir) -> DataFrame.

Each callable reads the whole tables of the data set folder through the
retail proxies (``souk.sources.proxies``) and returns a lazy DataFrame.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .plans import customers, logistics, pipeline, quality, revenue
from .plans.insights import baskets as BK
from .plans.insights import experience as X
from .plans.insights import operations as OP
from .plans.insights import segments as SG
from .plans.refresh import ReportStates
from .session import ensure_checkpoint_dir
from .sources.files import read_raw
from .sources.proxies import DirtyRetail, Retail

# Parameter values of the registered queries. The reference's own thresholds
# are the library defaults; where the test data's date range makes a default
# meaningless, the registered value is stated here.
CHURN_CUTOFF = "2001-01-01"      # test data spans 1995-2001 (reference: 2017-07-01)
CHURN_CUTOFFS = ("1997-01-01", "1999-01-01", "2001-01-01")
# near the mean orders of a person, and of a person and city (an order counts
# once per geolocation row of its zip prefix there): the repeat test separates
REPEAT_ORDERS = 20
REPEAT_ORDERS_CITY = 40
QUIET_MONTHS = 1                 # sellers of the test data sell nearly every month
SET_SUPPORT = 0.05               # of the orders: sets of two to four categories reach it
LOAD_TS = dt.datetime(2024, 1, 1)  # fixed load time so results are repeatable

Query = Callable[[SparkSession, str], DataFrame]

# One Retail per (application, data folder): its proxies are analysed logical
# plans (no data is cached), so later queries skip re-reading footers and
# re-analysing the same projections. clear_cache() after files change on disk.
_RETAIL: dict[tuple, Retail] = {}


def retail(spark: SparkSession, root: str, kind: type[Retail] = Retail) -> Retail:
    key = (spark.sparkContext.applicationId, id(spark), root, kind)
    if key not in _RETAIL:
        _RETAIL[key] = kind(spark, root)
    return _RETAIL[key]


def clear_cache() -> None:
    _RETAIL.clear()


def _on(build: Callable[[Retail], DataFrame], kind: type[Retail] = Retail) -> Query:
    """Turn ``build(retail) -> DataFrame`` into ``query(spark, data_dir)``."""
    def run(spark: SparkSession, root: str) -> DataFrame:
        return build(retail(spark, root, kind))
    return run


# ------------------------------------------------------- pipeline inputs ----
def _staged(r: Retail) -> DataFrame:
    return pipeline.stage(r.raw_products, quality.PRODUCTS, 1, LOAD_TS)


def _validated(r: Retail) -> DataFrame:
    return pipeline.validate_staged(_staged(r), quality.PRODUCTS)


def _flagged(r: Retail) -> DataFrame:
    return pipeline.validate_raw(r.raw_products, quality.PRODUCTS)


def _rule_counts(r: Retail) -> DataFrame:
    spec = quality.PRODUCTS
    flags = pipeline.flag_counts(_flagged(r), spec)
    msgs = pipeline.message_rule_counts(_staged(r), spec)
    return (flags.select(F.lit("flags").alias("profile"), "rule", "n_rows")
            .unionByName(msgs.select(F.lit("message").alias("profile"), "rule", "n_rows")
                         .filter(F.col("rule").isin("total", "valid", "rejected")
                                 | (F.col("n_rows") > 0))))


def _entity(spec: quality.TableSpec, frame: str) -> Callable[[Retail], DataFrame]:
    def build(r: Retail) -> DataFrame:
        staged = pipeline.stage(getattr(r, frame), spec, 1, LOAD_TS)
        return pipeline.validate_staged(staged, spec)
    return build


def _zones(spark: SparkSession) -> str:
    """A fresh zone folder under the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/souk-zones/{uuid.uuid4().hex}"


def _end_to_end(spark: SparkSession, root: str) -> DataFrame:
    """Run the whole pipeline and read the published clean batch back."""
    zones = _zones(spark)
    pipeline.run_pipeline(spark, retail(spark, root).raw_products, quality.PRODUCTS,
                          zones, load_ts=LOAD_TS)
    return pipeline.read_published(spark, zones, "clean", "products")


def _published(spark: SparkSession, root: str) -> DataFrame:
    """Two runs into one zone folder (SQL profile, then pandas profile); the
    reader must see only the newest SUCCESS batch."""
    zones, r = _zones(spark), retail(spark, root)
    for profile in ("message", "flags"):
        pipeline.run_pipeline(spark, r.raw_products, quality.PRODUCTS, zones,
                              profile=profile, load_ts=LOAD_TS)
    return pipeline.read_published(spark, zones, "clean", "products")


def _csv_translation(spark: SparkSession, root: str) -> DataFrame:
    """The category translation written as a header CSV (derived from the
    part table) and read back through the declared-schema CSV reader."""
    folder = f"{_zones(spark)}/raw/product_category_name_translation"
    name = F.col("p_type")
    (retail(spark, root).table("part").select(name.alias("product_category_name"))
     .distinct()
     .select("product_category_name",
             F.concat(F.lower("product_category_name"), F.lit("_en"))
             .alias("product_category_name_english"))
     .write.option("header", True).mode("overwrite").csv(folder))
    return read_raw(spark, folder, "product_category_name_translation")


def _incremental(spark: SparkSession, root: str) -> DataFrame:
    """Two appends of the product file into one zone folder, read as one table.

    The first load lacks every third product id; the second brings those, the
    rows without an id, and the even ids of the first load again. Together they
    hold every row, and both hold rows that the rules reject.
    """
    zones, raw = _zones(spark), retail(spark, root).raw_products
    key = F.coalesce(F.col("product_id").cast("long"), F.lit(0))
    for part in (key % 3 != 0, (key % 3 == 0) | (key % 2 == 0)):
        pipeline.run_pipeline(spark, raw.filter(part), quality.PRODUCTS, zones,
                              load_ts=LOAD_TS, incremental=True)
    return pipeline.read_published(spark, zones, "clean", "products", all_batches=True)


def _key_index(spark: SparkSession, root: str) -> DataFrame:
    """Four appends of a quarter of the product ids each; then, for the even ids and
    as many that no batch has, the batch that holds them."""
    zones, raw = _zones(spark), retail(spark, root).raw_products
    key = F.coalesce(F.col("product_id").cast("long"), F.lit(0))
    for part in range(4):
        pipeline.run_pipeline(spark, raw.filter(F.floor(key / 7) % 4 == part), quality.PRODUCTS,
                              zones, load_ts=LOAD_TS, incremental=True)
    even = raw.filter(key % 2 == 0).select("product_id")
    asked = even.unionByName(even.select(F.concat("product_id", F.lit("x")).alias("product_id")))
    return pipeline.keys_published(spark, zones, "products", asked, quality.PRODUCTS.key) \
        .select("product_id", "batch")


def _refreshed(report: Callable[[ReportStates, Retail], DataFrame]) -> Query:
    """A report refreshed after three appends of a third of the orders each, the
    first two compacted."""
    def run(spark: SparkSession, root: str) -> DataFrame:
        r, states = retail(spark, root), ReportStates(spark, _zones(spark))
        for part in range(3):
            mine = F.col("order_id") % 3 == part
            states.add(part + 1, r.orders.filter(mine), r.order_items.filter(mine))
            if part == 1:
                states.compact()
        return report(states, r)
    return run


def _clean_zone_revenue(spark: SparkSession, root: str) -> DataFrame:
    """Category revenue over the published clean products."""
    zones, r = _zones(spark), retail(spark, root)
    pipeline.run_pipeline(spark, r.raw_products, quality.PRODUCTS, zones, load_ts=LOAD_TS)
    clean = pipeline.read_published(spark, zones, "clean", "products").select(
        F.col("product_id").cast("long").alias("product_id"),
        F.trim("product_category_name").alias("product_category_name"))
    return revenue.category_revenue(r.order_items, clean, r.category_name)


P = quality.PRODUCTS

# Keys that write files while being built (zone folders under the session's
# checkpoint folder); plan-only tools skip them.
WRITING_KEYS = frozenset({"etl_end_to_end", "etl_published", "src_csv_translation",
                          "x_incremental_load", "x_key_index",
                          "q_monthly_revenue_trend_refreshed", "q_repeat_rate_refreshed",
                          "q_churn_refreshed", "q_category_revenue_clean_zone"})

QUERIES: dict[str, Query] = {
    # ---- the nine reference reports (faithful) ----
    "q_monthly_revenue_trend": _on(lambda r: revenue.monthly_revenue_trend(
        r.orders, r.order_items)),
    "q_category_revenue": _on(lambda r: revenue.category_revenue(
        r.order_items, r.products, r.category_name)),
    "q_repeat_by_city": _on(lambda r: customers.repeat_by_city(
        r.orders, r.customers, r.geolocation)),
    "q_repeat_by_city_all": _on(lambda r: customers.repeat_by_city(
        r.orders, r.customers, r.geolocation, min_customers=0)),
    "q_repeat_by_state": _on(lambda r: customers.repeat_by_state(r.orders, r.customers)),
    "q_aov_overall": _on(lambda r: customers.aov_overall(
        r.orders, r.order_items, r.customers)),
    "q_aov_by_state": _on(lambda r: customers.aov_by_state(
        r.orders, r.order_items, r.customers)),
    "q_repeat_rate": _on(lambda r: customers.repeat_rate(r.orders, r.customers)),
    "q_churn": _on(lambda r: customers.churn(r.orders, r.customers, cutoff=CHURN_CUTOFF)),
    "q_delivery_by_city": _on(lambda r: logistics.delivery_by_city(r.orders, r.customers)),
    # ---- corrected forms ----
    "q_repeat_by_city_corrected": _on(lambda r: customers.repeat_by_city(
        r.orders, r.customers, r.geolocation, min_customers=0, faithful=False)),
    "q_repeat_by_state_corrected": _on(lambda r: customers.repeat_by_state(
        r.orders, r.customers, faithful=False)),
    "q_aov_overall_corrected": _on(lambda r: customers.aov_overall(
        r.orders, r.order_items, r.customers, faithful=False)),
    "q_repeat_rate_corrected": _on(lambda r: customers.repeat_rate(
        r.orders, r.customers, faithful=False)),
    "q_category_revenue_unmapped": _on(lambda r: revenue.category_revenue(
        r.order_items, r.products, r.category_name, keep_unmapped=True)),
    "q_delivery_by_city_exact": _on(lambda r: logistics.delivery_by_city(
        r.orders, r.customers, exact=True)),
    "q_delivery_by_city_corrected": _on(lambda r: logistics.delivery_by_city(
        r.orders, r.customers, exact=True, start="order_purchase_timestamp",
        by_state=True)),
    "q_churn_over_time": _on(lambda r: customers.churn_over_time(
        r.orders, r.customers, list(CHURN_CUTOFFS))),
    # ---- thresholds that decide something on the test data ----
    "q_repeat_by_city_large": _on(lambda r: customers.repeat_by_city(
        r.orders, r.customers, r.geolocation, min_customers=250)),
    "q_repeat_by_city_often": _on(lambda r: customers.repeat_by_city(
        r.orders, r.customers, r.geolocation, min_orders=REPEAT_ORDERS_CITY,
        min_customers=60)),
    "q_repeat_by_state_often": _on(lambda r: customers.repeat_by_state(
        r.orders, r.customers, min_orders=REPEAT_ORDERS)),
    "q_repeat_rate_often": _on(lambda r: customers.repeat_rate(
        r.orders, r.customers, min_orders=REPEAT_ORDERS)),
    # ---- reports on tables with missing dates and persons, repeated products ----
    "q_monthly_revenue_trend_dirty": _on(lambda r: revenue.monthly_revenue_trend(
        r.orders, r.order_items), DirtyRetail),
    "q_category_revenue_dirty": _on(lambda r: revenue.category_revenue(
        r.order_items, r.products, r.category_name), DirtyRetail),
    "q_repeat_by_state_dirty": _on(lambda r: customers.repeat_by_state(
        r.orders, r.customers, min_orders=REPEAT_ORDERS), DirtyRetail),
    "q_repeat_by_city_dirty": _on(lambda r: customers.repeat_by_city(
        r.orders, r.customers, r.geolocation, min_orders=REPEAT_ORDERS_CITY,
        min_customers=0), DirtyRetail),
    "q_repeat_rate_dirty": _on(lambda r: customers.repeat_rate(
        r.orders, r.customers, min_orders=REPEAT_ORDERS), DirtyRetail),
    "q_churn_dirty": _on(lambda r: customers.churn(
        r.orders, r.customers, cutoff=CHURN_CUTOFF), DirtyRetail),
    # ---- load pipeline ----
    "etl_stage": _on(_staged),
    "etl_validate_message": _on(_validated),
    "etl_validate_flags": _on(_flagged),
    "etl_error_rows": _on(lambda r: pipeline.error_rows(_validated(r), P)),
    "etl_clean_rows": _on(lambda r: pipeline.clean_rows(_validated(r), P)),
    "etl_error_flags_rows": _on(lambda r: pipeline.error_flag_rows(_flagged(r), P)),
    "etl_clean_flags_rows": _on(lambda r: pipeline.transform(_flagged(r), P)),
    "etl_rule_counts": _on(_rule_counts),
    "etl_audit_row": _on(lambda r: pipeline.audit_summary(_validated(r), "products")),
    "dq_single_rule": _on(lambda r: quality.single_rule_quarantine(_staged(r))),
    "dq_strict_rules": _on(lambda r: quality.strict_validate(_staged(r), r.category_name)),
    "etl_customers": _on(_entity(quality.CUSTOMERS, "customers")),
    "etl_orders": _on(_entity(quality.ORDERS, "orders")),
    "etl_end_to_end": _end_to_end,
    "etl_published": _published,
    "profile_head": _on(lambda r: r.orders.orderBy("order_id").limit(5)),
    "src_csv_translation": _csv_translation,
    # ---- questions the reference states without code ----
    "x_revenue_per_seller": _on(lambda r: OP.revenue_per_seller(r.order_items)),
    "x_cancellation_impact": _on(lambda r: OP.cancellation_impact(r.orders, r.order_items)),
    "x_state_revenue_corr": _on(lambda r: OP.state_revenue_corr(
        r.orders, r.order_items, r.customers)),
    "x_delivery_actual_vs_est": _on(lambda r: OP.delivery_actual_vs_estimate(r.orders)),
    "x_slowest_sellers": _on(lambda r: OP.slowest_sellers(r.orders, r.order_items, r.sellers)),
    "x_delay_vs_review": _on(lambda r: X.delay_vs_review(r.orders, r.order_reviews)),
    "x_weekend_holiday_delay": _on(lambda r: X.weekend_holiday_delay(r.orders)),
    "x_ship_lag": _on(lambda r: OP.ship_lag(r.orders, r.order_items)),
    "x_category_cancel_rate": _on(lambda r: OP.category_cancel_rate(
        r.orders, r.order_items, r.products)),
    "x_category_5v1": _on(lambda r: X.category_5v1(r.order_items, r.products,
                                                   r.order_reviews)),
    "x_category_avg_score": _on(lambda r: X.category_avg_score(
        r.order_items, r.products, r.order_reviews)),
    "x_basket_pairs": _on(lambda r: SG.basket_pairs(r.order_items, r.products)),
    "x_holiday_products": _on(lambda r: OP.holiday_products(r.orders, r.order_items)),
    "x_seller_rating": _on(lambda r: X.seller_rating(r.order_items, r.order_reviews)),
    "x_seller_rating_all": _on(lambda r: X.seller_rating(
        r.order_items, r.order_reviews, min_reviews=1, top=None)),
    "x_slowest_regions": _on(lambda r: OP.slowest_places(
        r.orders, r.order_items, r.sellers)),
    "x_slowest_states": _on(lambda r: OP.slowest_places(
        r.orders, r.order_items, r.sellers, "seller_state")),
    "q_churn_by_inactivity": _on(lambda r: customers.churn_by_inactivity(
        r.orders, r.customers)),
    "x_poor_sellers": _on(lambda r: X.poor_sellers(r.orders, r.order_items,
                                                   r.order_reviews)),
    "x_score_by_delay": _on(lambda r: X.score_by_delay(r.orders, r.order_reviews)),
    "x_price_vs_score": _on(lambda r: X.price_vs_score(r.order_items, r.order_reviews)),
    "x_top_sellers": _on(lambda r: OP.top_sellers(r.order_items)),
    "x_seller_retention": _on(lambda r: OP.seller_retention(r.orders, r.order_items)),
    "x_seller_retention_curve": _on(lambda r: OP.seller_retention_curve(
        r.orders, r.order_items, quiet=QUIET_MONTHS)),
    "x_customer_retention_curve": _on(lambda r: OP.customer_retention_curve(
        r.orders, r.customers)),
    "x_seller_ship_time": _on(lambda r: OP.seller_ship_time(r.orders, r.order_items)),
    "x_region_performance": _on(lambda r: OP.region_performance(
        r.orders, r.order_items, r.sellers)),
    "x_payment_mix": _on(lambda r: X.payment_mix(r.order_payments)),
    "x_payment_vs_value": _on(lambda r: X.payment_vs_value(r.order_payments)),
    "x_installments_by_category": _on(lambda r: X.installments_by_category(
        r.order_items, r.products, r.order_payments)),
    "x_installments_by_value": _on(lambda r: X.installments_by_value(r.order_payments)),
    "x_cohort": _on(lambda r: SG.cohorts(r.orders, r.customers)),
    "x_rfm": _on(lambda r: SG.rfm_segments(SG.rfm_scores(r.orders, r.order_items,
                                                          r.customers))),
    "x_forecast": _on(lambda r: SG.revenue_forecast(r.orders, r.order_items)),
    "x_satisfaction_index": _on(lambda r: SG.satisfaction_index(
        r.orders, r.customers, r.order_reviews)),
    "x_recommend": _on(lambda r: SG.recommend(r.order_items, r.products)),
    "x_recommend_items": _on(lambda r: BK.similar_products(r.order_items)),
    "x_basket_sets": _on(lambda r: BK.category_sets_above(
        r.order_items, r.products, min_support=SET_SUPPORT)),
    "x_price_elasticity": _on(lambda r: SG.price_elasticity(
        r.order_items, r.products, r.orders)),
    "x_incremental_load": _incremental,
    "x_key_index": _key_index,
    "q_monthly_revenue_trend_refreshed": _refreshed(
        lambda s, r: s.monthly_revenue_trend()),
    "q_repeat_rate_refreshed": _refreshed(
        lambda s, r: s.repeat_rate(r.customers, min_orders=REPEAT_ORDERS)),
    "q_churn_refreshed": _refreshed(lambda s, r: s.churn(r.customers, cutoff=CHURN_CUTOFF)),
    "q_category_revenue_clean_zone": _clean_zone_revenue,
}
