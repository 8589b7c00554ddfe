"""Review and payment analyses (stated questions; our definitions)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions import correlation, day_diff, from_cents, money_sum, pct
from ...operators.joins import bounded_broadcast
from ...operators.quantiles import exact_quantiles
from ...operators.ranks import ntile, ranked
from .common import delivered, order_categories, order_sellers

# National public holidays with a fixed calendar date
# (month, day) in the reference's market.
FIXED_HOLIDAYS = ((1, 1), (4, 21), (5, 1), (9, 7), (10, 12), (11, 2), (11, 15), (12, 25))

# Days from Easter Sunday of the movable ones (Carnival Monday and
# Tuesday, Good Friday, Corpus Christi).
MOVABLE_HOLIDAYS = (-48, -47, -2, 60)

SCORES = (1, 2, 3, 4, 5)


def _ratio(num: str, den: str, scale: int):
    return F.round(F.try_divide(F.col(num).cast("double"), F.col(den).cast("double")),
                   scale)


def _delay(orders: DataFrame) -> DataFrame:
    """(order_id, delay): days delivered after the estimate (negative: early)."""
    return (delivered(orders).filter(F.col("order_estimated_delivery_date").isNotNull())
            .select("order_id", day_diff("order_estimated_delivery_date",
                                         "order_delivered_customer_date").alias("delay")))


def delay_vs_review(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Mean review score of late vs on-time orders, and delay/score correlation."""
    d = _delay(orders).join(reviews.select("order_id", "review_score"), "order_id")
    corr = d.agg(F.round(correlation(F.col("delay").cast("double"),
                                       F.col("review_score").cast("double")), 6)
                 .alias("delay_score_corr"))
    return (d.groupBy((F.col("delay") > 0).alias("is_delayed"))
            .agg(F.count(F.lit(1)).alias("orders"), F.sum("review_score").alias("s"))
            .select("is_delayed", "orders", _ratio("s", "orders", 4).alias("avg_review_score"))
            .crossJoin(F.broadcast(corr)))


def easter(year: int) -> dt.date:
    """Easter Sunday of the Gregorian calendar (the usual computus)."""
    century, gold = year // 100, year % 19
    epact = (century - century // 4 - (8 * century + 13) // 25 + 19 * gold + 15) % 30
    epact -= epact // 28 * (1 - epact // 28 * (29 // (epact + 1)) * ((21 - gold) // 11))
    weekday = (year + year // 4 + epact + 2 - century + century // 4) % 7
    day = epact - weekday
    month = 3 + (day + 40) // 44
    return dt.date(year, month, day + 28 - 31 * (month // 4))


def holidays(spark, years: range = range(1900, 2101)) -> DataFrame:
    """(holiday): dates of the fixed and the movable holidays of ``years``."""
    days = {dt.date(y, m, d) for y in years for m, d in FIXED_HOLIDAYS}
    days |= {easter(y) + dt.timedelta(n) for y in years for n in MOVABLE_HOLIDAYS}
    rows = [(d,) for d in sorted(days)]
    return bounded_broadcast(spark.createDataFrame(rows, "holiday date"), known_rows=len(rows))


def weekend_holiday_delay(orders: DataFrame) -> DataFrame:
    """Delivery of orders placed on a holiday, a weekend or a weekday."""
    ts = F.col("order_purchase_timestamp")
    d = (delivered(orders).filter(F.col("order_estimated_delivery_date").isNotNull())
         .select(ts, F.to_date(ts).alias("day"),
                 day_diff("order_purchase_timestamp", "order_delivered_customer_date")
                 .alias("days"),
                 day_diff("order_estimated_delivery_date", "order_delivered_customer_date")
                 .alias("delay")))
    h = holidays(orders.sparkSession)
    tagged = d.join(h, d.day == h.holiday, "left").select(
        F.when(F.col("holiday").isNotNull(), F.lit("holiday"))
        .when(F.dayofweek(ts).isin(1, 7), F.lit("weekend"))
        .otherwise(F.lit("weekday")).alias("day_type"), "days", "delay")
    return (tagged.groupBy("day_type")
            .agg(F.count(F.lit(1)).alias("orders"), F.sum("days").alias("days"),
                 F.sum("delay").alias("delay"), F.count_if(F.col("delay") > 0).alias("late"))
            .select("day_type", "orders", _ratio("days", "orders", 2).alias("avg_delivery_days"),
                    _ratio("delay", "orders", 2).alias("avg_delay_days"),
                    pct("late", "orders", 2).alias("late_share")))


def _category_reviews(order_items, products, reviews):
    return order_categories(order_items, products).join(
        reviews.select("order_id", "review_score"), "order_id")


def category_5v1(order_items: DataFrame, products: DataFrame,
                 reviews: DataFrame) -> DataFrame:
    """Per category: 5-star and 1-star reviewed orders and their ratio."""
    return (_category_reviews(order_items, products, reviews).groupBy("category")
            .agg(F.count_if(F.col("review_score") == 5).alias("five_star_orders"),
                 F.count_if(F.col("review_score") == 1).alias("one_star_orders"))
            .select(F.col("category").alias("product_category_name"), "five_star_orders",
                    "one_star_orders",
                    _ratio("five_star_orders", "one_star_orders", 4).alias("five_to_one_ratio")))


def category_avg_score(order_items: DataFrame, products: DataFrame,
                       reviews: DataFrame) -> DataFrame:
    """Per category: reviewed orders and mean score."""
    return (_category_reviews(order_items, products, reviews).groupBy("category")
            .agg(F.count(F.lit(1)).alias("reviews"), F.sum("review_score").alias("s"))
            .select(F.col("category").alias("product_category_name"), "reviews",
                    _ratio("s", "reviews", 4).alias("avg_review_score")))


def _seller_reviews(order_items, reviews):
    return order_sellers(order_items).join(
        reviews.select("order_id", "review_score"), "order_id")


def seller_rating(order_items: DataFrame, reviews: DataFrame, *,
                  min_reviews: int = 5, top: int | None = 10) -> DataFrame:
    """Highest-rated sellers with at least ``min_reviews`` reviewed orders;
    ``top=None`` rates each of them."""
    per = (_seller_reviews(order_items, reviews).groupBy("seller_id")
           .agg(F.count(F.lit(1)).alias("reviews"), F.sum("review_score").alias("s"))
           .filter(F.col("reviews") >= min_reviews)
           .withColumn("avg", F.col("s") / F.col("reviews")))
    best = per if top is None else per.orderBy(F.desc("avg"), "seller_id").limit(top)
    return best.select("seller_id", "reviews", F.round("avg", 4).alias("avg_review_score"))


def poor_sellers(orders: DataFrame, order_items: DataFrame, reviews: DataFrame, *,
                 threshold: float = 3.0, min_months: int = 3) -> DataFrame:
    """Sellers whose monthly mean score is below ``threshold`` in at least
    ``min_months`` months."""
    ts = F.col("order_purchase_timestamp")
    o = orders.select("order_id", F.date_format(ts, "yyyy-MM").alias("month"))
    monthly = (_seller_reviews(order_items, reviews).join(o, "order_id")
               .groupBy("seller_id", "month")
               .agg((F.sum("review_score") / F.count(F.lit(1))).alias("avg")))
    return (monthly.groupBy("seller_id")
            .agg(F.count_if(F.col("avg") < threshold).alias("poor_months"),
                 F.count(F.lit(1)).alias("active_months"))
            .filter(F.col("poor_months") >= min_months))


def score_by_delay(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Review-score distribution per delay bucket (a pivot on the score)."""
    delay = F.col("delay")
    bucket = (F.when(delay <= 0, F.lit("on_time"))
              .when(delay <= 3, F.lit("late_1_3"))
              .when(delay <= 7, F.lit("late_4_7"))
              .otherwise(F.lit("late_8_plus")))
    d = _delay(orders).join(reviews.select("order_id", "review_score"), "order_id")
    piv = (d.groupBy(bucket.alias("delay_bucket"))
           .pivot("review_score", list(SCORES)).count())
    return piv.select("delay_bucket", *[F.coalesce(F.col(str(s)), F.lit(0)).alias(f"score_{s}")
                                        for s in SCORES])


def price_vs_score(order_items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Correlation of item price and the order's score; score change per
    1,000 of price (least-squares slope)."""
    d = order_items.select("order_id", "price").join(
        reviews.select("order_id", F.col("review_score").cast("double").alias("s")),
        "order_id")
    return d.agg(F.count(F.lit(1)).alias("items"),
                 F.round(correlation(F.col("price"), F.col("s")), 6).alias("price_score_corr"),
                 F.round(F.regr_slope("s", F.col("price") / 1000.0), 6)
                 .alias("score_per_1000"))


def payment_mix(payments: DataFrame) -> DataFrame:
    """Payment types: number of payments, share and value."""
    per = payments.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("payments"), money_sum("payment_value").alias("cents"))
    total = per.agg(F.sum("payments").alias("all_payments"))
    return per.crossJoin(F.broadcast(total)).select(
        "payment_type", "payments", pct("payments", "all_payments", 2).alias("share"),
        F.round(from_cents("cents"), 2).alias("total_value"))


def payment_vs_value(payments: DataFrame) -> DataFrame:
    """Per payment type: mean, median and largest value, mean instalments.

    The median is exact at any size (``operators/quantiles``), and a payment
    type holding a third of all rows never gathers its values in one task.
    """
    median = exact_quantiles(payments, "payment_type", "payment_value", [0.5]) \
        .select(F.col("payment_type").alias("_type"), F.get("quantiles", F.lit(0))
                .alias("median_value"))
    per = payments.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("payments"), money_sum("payment_value").alias("c"),
        F.max("payment_value").alias("max_value"),
        F.sum("payment_installments").alias("inst"))
    return per.join(median, per.payment_type.eqNullSafe(F.col("_type")), "left").select(
        "payment_type", "payments",
        F.round(F.col("c") / F.col("payments") / 100.0, 2).alias("avg_value"),
        "median_value", "max_value",
        _ratio("inst", "payments", 4).alias("avg_installments"))


def installments_by_category(order_items: DataFrame, products: DataFrame,
                             payments: DataFrame) -> DataFrame:
    """Per category: paid orders and mean number of instalments."""
    p = payments.select("order_id", "payment_installments")
    return (order_categories(order_items, products).join(p, "order_id")
            .groupBy("category")
            .agg(F.count(F.lit(1)).alias("payments"),
                 F.sum("payment_installments").alias("inst"))
            .select(F.col("category").alias("product_category_name"), "payments",
                    _ratio("inst", "payments", 4).alias("avg_installments")))


def installments_by_value(payments: DataFrame, bands: int = 4) -> DataFrame:
    """Instalment use per payment-value band: equal shares of the payments by
    value (quartiles by default; sizes differ by one payment at most). Equal
    values are told apart by order, instalments and type; a payment without a
    value has no band."""
    rows = payments.select("payment_value", "order_id", "payment_installments", "payment_type") \
        .filter(F.col("payment_value").isNotNull() & ~F.isnan(F.col("payment_value")
                                                              .cast("double")))
    order = ["payment_value", "order_id", "payment_installments", "payment_type"]
    tagged = ranked(rows.withColumn("_all", F.lit(0)), "_all", order) \
        .withColumn("value_band", ntile("rank", "group_rows", bands))
    return (tagged.groupBy("value_band")
            .agg(F.count(F.lit(1)).alias("payments"),
                 F.min("payment_value").alias("min_value"),
                 F.max("payment_value").alias("max_value"),
                 F.sum("payment_installments").alias("inst"),
                 F.count_if(F.col("payment_installments") > 1).alias("multi"))
            .select("value_band", "payments", "min_value", "max_value",
                    _ratio("inst", "payments", 4).alias("avg_installments"),
                    pct("multi", "payments", 2).alias("multi_installment_share")))
