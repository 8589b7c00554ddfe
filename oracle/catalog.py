"""Key -> DuckDB SQL, matching ``souk.catalog.QUERIES``."""

from __future__ import annotations

from souk.catalog import CHURN_CUTOFF, REPEAT_ORDERS, REPEAT_ORDERS_CITY

from . import etl, reports

ORACLE: dict[str, str] = {
    "q_monthly_revenue_trend": reports.monthly_revenue_trend(),
    "q_category_revenue": reports.category_revenue(),
    "q_repeat_by_city": reports.repeat_by("customer_city", min_customers=500),
    "q_repeat_by_city_all": reports.repeat_by("customer_city", min_customers=0),
    "q_repeat_by_state": reports.repeat_by("customer_state"),
    "q_aov_overall": reports.aov_overall(),
    "q_aov_by_state": reports.aov_by_state(),
    "q_repeat_rate": reports.repeat_rate(),
    "q_churn": reports.churn(CHURN_CUTOFF),
    "q_delivery_by_city": reports.delivery_by_city(),
    "etl_stage": etl.ETL_STAGE,
    "etl_validate_message": etl.ETL_VALIDATE_MESSAGE,
    "etl_validate_flags": etl.ETL_VALIDATE_FLAGS,
    "etl_error_rows": etl.ETL_ERROR_ROWS,
    "etl_clean_rows": etl.ETL_CLEAN_ROWS,
    "etl_error_flags_rows": etl.ETL_ERROR_FLAGS_ROWS,
    "etl_clean_flags_rows": etl.ETL_CLEAN_FLAGS_ROWS,
    "etl_rule_counts": etl.ETL_RULE_COUNTS,
    "etl_audit_row": etl.ETL_AUDIT_ROW,
    "dq_single_rule": etl.DQ_SINGLE_RULE,
    "dq_strict_rules": etl.DQ_STRICT_RULES,
    "etl_customers": etl.ETL_CUSTOMERS,
    "etl_orders": etl.ETL_ORDERS,
    "etl_end_to_end": etl.ETL_CLEAN_ROWS,
    "etl_published": etl.ETL_CLEAN_FLAGS_ROWS,
    "profile_head": etl.PROFILE_HEAD,
    "src_csv_translation": """
SELECT DISTINCT p_type AS product_category_name,
       lower(p_type) || '_en' AS product_category_name_english
FROM part""",
}

from .insights import INSIGHTS  # noqa: E402

ORACLE.update(INSIGHTS)

ORACLE.update({
    "q_repeat_by_city_corrected": reports.repeat_by_corrected("customer_city"),
    "q_repeat_by_state_corrected": reports.repeat_by_corrected("customer_state"),
    "q_aov_overall_corrected": reports.aov_overall(corrected=True),
    "q_repeat_rate_corrected": reports.repeat_rate(corrected=True),
    "q_category_revenue_unmapped": reports.category_revenue(unmapped=True),
    # thresholds near the means of the data, so that they decide something
    "q_repeat_by_city_large": reports.repeat_by("customer_city", min_customers=250),
    "q_repeat_by_city_often": reports.repeat_by("customer_city", REPEAT_ORDERS_CITY, 60),
    "q_churn_by_inactivity": reports.churn_by_inactivity(6),
    "q_repeat_by_state_often": reports.repeat_by("customer_state", REPEAT_ORDERS),
    "q_repeat_rate_often": reports.repeat_rate(REPEAT_ORDERS),
    # refreshed reports equal the full ones
    "q_monthly_revenue_trend_refreshed": reports.monthly_revenue_trend(),
    "q_repeat_rate_refreshed": reports.repeat_rate(REPEAT_ORDERS),
    "q_churn_refreshed": reports.churn(CHURN_CUTOFF),
    # tables with missing dates and persons and repeated products
    "q_monthly_revenue_trend_dirty": reports.monthly_revenue_trend(dirty=True),
    "q_category_revenue_dirty": reports.category_revenue(dirty=True),
    "q_repeat_by_state_dirty": reports.repeat_by("customer_state", REPEAT_ORDERS, dirty=True),
    "q_repeat_by_city_dirty": reports.repeat_by("customer_city", REPEAT_ORDERS_CITY, 0,
                                                dirty=True),
    "q_repeat_rate_dirty": reports.repeat_rate(REPEAT_ORDERS, dirty=True),
    "q_churn_dirty": reports.churn(CHURN_CUTOFF, dirty=True),
    "q_category_revenue_clean_zone": reports.category_revenue_clean_zone(),
    "q_delivery_by_city_exact": reports.delivery_by_city(exact=True),
    "q_delivery_by_city_corrected": reports.delivery_by_city(
        "order_purchase_timestamp", True, "customer_state, customer_city"),
})
