"""Customer segments, baskets, trend forecast and recommendations
(stated questions; our definitions)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ...functions import day_diff, from_cents, money_sum
from ...operators.ranks import ntile, ranked
from ...operators.topk import top_k_per_group
from .common import MISC, order_category_sets, revenue_per_order

PERSON = "customer_unique_id"
SCORES = 5


def _month_index(ts):
    return F.year(ts) * 12 + F.month(ts) - 1


# ------------------------------------------------------------- cohorts ----
def cohorts(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Active persons per first-purchase month and months since it."""
    ts = F.col("order_purchase_timestamp")
    active = (orders.select("customer_id", _month_index(ts).alias("m"))
              .join(customers.select("customer_id", PERSON), "customer_id")
              .select(PERSON, "m").distinct())
    # first month per person as a window over the person's own active months
    # (bounded by the months in the data), instead of an aggregate joined back
    first = F.min("m").over(Window.partitionBy(PERSON))
    return (active.withColumn("first_m", first)
            .groupBy("first_m", (F.col("m") - F.col("first_m")).alias("months_since"))
            .agg(F.count(F.lit(1)).alias("active_customers"))
            .select(F.format_string("%04d-%02d", (F.col("first_m") / 12).cast("int"),
                                    (F.col("first_m") % 12 + 1).cast("int"))
                    .alias("cohort_month"),
                    F.col("months_since").cast("int").alias("months_since"),
                    "active_customers"))


# ----------------------------------------------------------------- RFM ----
def rfm_scores(orders: DataFrame, order_items: DataFrame,
               customers: DataFrame) -> DataFrame:
    """Per person: recency (days before the day after the last purchase in
    the data), frequency (orders), monetary (item revenue), each scored 1-5:
    equal fifths of all persons, ties by person, the best fifth 5.

    The three values of a person become three rows and are ranked in one pass
    (``operators/ranks``: no window holds all persons). A person without a
    dated order comes first in recency, with the worst score.
    """
    day = F.col("order_purchase_timestamp").cast("date")
    per_order = (orders.select("order_id", "customer_id", day.alias("d"))
                 .join(revenue_per_order(order_items), "order_id", "left"))
    per_cust = per_order.groupBy("customer_id").agg(
        F.max("d").alias("last_d"), F.count(F.lit(1)).alias("orders"),
        F.sum(F.coalesce("rev_cents", F.lit(0))).alias("cents"))
    per_person = (per_cust.join(customers.select("customer_id", PERSON), "customer_id")
                  .groupBy(PERSON).agg(F.max("last_d").alias("last_d"),
                                       F.sum("orders").alias("frequency"),
                                       F.sum("cents").alias("cents")))
    # the latest day is the best one, so the last day itself stands for recency
    values = {"r": F.unix_date("last_d"), "f": F.col("frequency"), "m": from_cents("cents")}
    long = per_person.select(PERSON, "last_d", F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), v.cast("double").alias("v"))
        for k, v in values.items()])).alias("x")).select(PERSON, "last_d", "x.kind", "x.v")
    scored = ranked(long, "kind", ["v", PERSON]) \
        .withColumn("score", ntile("rank", "group_rows", SCORES))

    def of(kind: str, column: str):
        return F.max(F.when(F.col("kind") == kind, F.col(column)))

    wide = scored.groupBy(PERSON).agg(
        F.max("last_d").alias("last_d"), of("f", "v").cast("long").alias("frequency"),
        of("m", "v").alias("monetary"), *[of(k, "score").alias(f"{k}_score") for k in values])
    ref = scored.agg(F.date_add(F.max("last_d"), 1).alias("ref"))  # one row
    return wide.crossJoin(F.broadcast(ref)).select(
        PERSON, F.datediff("ref", "last_d").alias("recency"), "frequency", "monetary",
        "r_score", "f_score", "m_score")


def rfm_segments(scores: DataFrame) -> DataFrame:
    """Rule-based segment per person, then persons and means per segment."""
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    seg = (F.when((r >= 4) & (f >= 4) & (m >= 4), F.lit("champions"))
           .when(f >= 4, F.lit("loyal"))
           .when((r <= 2) & (f >= 3), F.lit("at_risk"))
           .when(r <= 2, F.lit("lost"))
           .when((r >= 4) & (f <= 2), F.lit("new"))
           .otherwise(F.lit("regular")))
    return (scores.groupBy(seg.alias("segment"))
            .agg(F.count(F.lit(1)).alias("customers"),
                 F.round(F.avg("recency"), 2).alias("avg_recency_days"),
                 F.round(F.avg("frequency"), 4).alias("avg_frequency"),
                 F.round(F.avg("monetary"), 2).alias("avg_monetary")))


# -------------------------------------------------------------- basket ----
def category_sets(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """(cats, n): each distinct set of categories bought together and the
    number of orders that bought exactly that set.

    A set is as short as the list of categories. There can be many sets (at most
    one per order); equal ones are counted on the map side.
    """
    return (order_category_sets(order_items, products)
            .groupBy(F.sort_array("cats").alias("cats")).agg(F.count(F.lit(1)).alias("n")))


_PAIRS = ("flatten(transform(cats, (a, i) -> transform(slice(cats, i + 2, size(cats)), "
          "b -> named_struct('a', a, 'b', b))))")


_SINGLES = "transform(cats, a -> named_struct('a', a, 'b', CAST(NULL AS STRING)))"
_TOTAL = "array(named_struct('a', CAST(NULL AS STRING), 'b', CAST(NULL AS STRING)))"


def basket_pairs(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Category pairs bought in one order: orders, support and lift.

    Pairs are expanded from the distinct category sets (weighted by their
    order count), never per order. One explode over the sets yields the pair
    counts (a, b), the single-category counts (a, NULL) and the order total
    (NULL, NULL) together, so the sets are built once.
    """
    sets = category_sets(order_items, products)
    counts = (sets.select(F.explode(F.concat(F.expr(_PAIRS), F.expr(_SINGLES),
                                             F.expr(_TOTAL))).alias("p"), "n")
              .groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b"))
              .agg(F.sum("n").alias("n")))
    # Single-category counts and the order total in one 1-row aggregate: a map
    # with one entry per category (a bounded domain), looked up per pair
    # instead of joining the counts back twice.
    single = F.when(F.col("a").isNotNull(), F.struct("a", "n"))
    stats = (counts.filter(F.col("b").isNull())
             .agg(F.map_from_entries(F.collect_list(single)).alias("n_cat"),
                  F.max(F.when(F.col("a").isNull(), F.col("n"))).alias("all_orders")))
    n_a = F.element_at("n_cat", F.col("a"))
    n_b = F.element_at("n_cat", F.col("b"))
    return (counts.filter(F.col("b").isNotNull())
            .crossJoin(F.broadcast(stats))
            .select(F.col("a").alias("category_a"), F.col("b").alias("category_b"),
                    F.col("n").alias("orders"),
                    F.round(F.col("n") / F.col("all_orders"), 6).alias("support"),
                    F.round(F.col("n") * F.col("all_orders") / (n_a * n_b), 6)
                    .alias("lift")))


def recommend(order_items: DataFrame, products: DataFrame, top: int = 3) -> DataFrame:
    """For each category: the ``top`` categories most often bought with it,
    each with its best-selling product (by item revenue, ties: lowest id)."""
    # Directed pairs (a, b), a != b, straight from the distinct category sets:
    # one pass, both directions, still never per order.
    directed = ("flatten(transform(cats, a -> transform(filter(cats, b -> b != a), "
                "b -> named_struct('a', a, 'b', b))))")
    both = (category_sets(order_items, products)
            .select(F.explode(F.expr(directed)).alias("p"), "n")
            .groupBy(F.col("p.a").alias("category"), F.col("p.b").alias("partner_category"))
            .agg(F.sum("n").alias("orders")))
    ranked = top_k_per_group(both, ["category"],
                             [F.desc("orders"), F.col("partner_category")], top)
    per_product = (order_items.select("product_id", "price")
                   .join(products.select("product_id", "product_category_name"), "product_id")
                   .groupBy("product_category_name", "product_id")
                   .agg(money_sum("price").alias("cents")))
    best = (per_product.groupBy(F.coalesce("product_category_name", F.lit(MISC))
                                .alias("partner_category"))
            .agg(F.min_by("product_id", F.struct(-F.col("cents"), F.col("product_id")))
                 .alias("top_product_id")))
    return (ranked.join(best, "partner_category", "left")
            .select("category", "rank", "partner_category",
                    F.col("orders").alias("co_orders"), "top_product_id"))


# ------------------------------------------------------------ forecast ----
def revenue_forecast(orders: DataFrame, order_items: DataFrame,
                     horizon: int = 3) -> DataFrame:
    """Linear trend of monthly item revenue, projected ``horizon`` months on.

    The least-squares fit uses exact integer sums (month index, cents), so the
    slope does not depend on summation order; only the final division is in
    floating point.
    """
    ts = F.col("order_purchase_timestamp")
    # an order without a date belongs to no month
    monthly = (orders.filter(ts.isNotNull()).select("order_id", _month_index(ts).alias("m"))
               .join(revenue_per_order(order_items), "order_id")
               .groupBy("m").agg(F.sum("rev_cents").alias("y")))
    first = monthly.agg(F.min("m").alias("m0"), F.max("m").alias("m1"))
    x = (F.col("m") - F.col("m0"))
    sums = (monthly.crossJoin(F.broadcast(first))
            .agg(F.count(F.lit(1)).cast("double").alias("n"),
                 F.sum(x).cast("double").alias("sx"),
                 F.sum("y").cast("double").alias("sy"),
                 F.sum(x * F.col("y")).cast("double").alias("sxy"),
                 F.sum(x * x).cast("double").alias("sxx"),
                 F.first("m0").alias("m0"), F.first("m1").alias("m1")))
    slope = F.try_divide(F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy"),
                         F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx"))
    fit = sums.select("m0", "m1", "n", "sx", "sy", slope.alias("b"))
    fit = fit.withColumn("a", (F.col("sy") - F.col("b") * F.col("sx")) / F.col("n"))
    steps = fit.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
    mi = F.col("m1") + F.col("h")
    return steps.select(
        (mi - F.col("m0")).cast("int").alias("month_index"),
        F.format_string("%04d-%02d", (mi / 12).cast("int"), (mi % 12 + 1).cast("int"))
        .alias("month_label"),
        F.round((F.col("a") + F.col("b") * (mi - F.col("m0"))) / 100.0, 2)
        .alias("forecast_revenue"))


# -------------------------------------------------- satisfaction index ----
# Weights of the index: review score, delivery speed, repeat buying.
INDEX_WEIGHTS = (0.4, 0.3, 0.3)


def satisfaction_index(orders: DataFrame, customers: DataFrame,
                       reviews: DataFrame) -> DataFrame:
    """Per customer state: mean score, mean delivery days, share of repeat
    persons, and an index of the three scaled 0-1 across states."""
    # One pass: reviews reduced to one row per order, orders to one row per
    # customer, then persons, then states; every measure rides along.
    rv = reviews.groupBy("order_id").agg(F.sum("review_score").alias("s"),
                                         F.count("review_score").alias("n"))
    done = ((F.col("order_status") == "delivered")
            & F.col("order_delivered_customer_date").isNotNull()
            & F.col("order_purchase_timestamp").isNotNull())
    days = F.when(done, day_diff("order_purchase_timestamp",
                                 "order_delivered_customer_date"))
    per_cust = (orders.select("order_id", "customer_id", days.alias("days"))
                .join(rv, "order_id", "left")
                .groupBy("customer_id")
                .agg(F.sum("s").alias("s"), F.sum("n").alias("n"),
                     F.sum("days").alias("days"), F.count("days").alias("nd"),
                     F.count("order_id").alias("k")))
    per_person = (per_cust.join(customers.select("customer_id", "customer_state", PERSON),
                                "customer_id")
                  .groupBy("customer_state", PERSON)
                  .agg(*[F.sum(c_).alias(c_) for c_ in ("s", "n", "days", "nd", "k")]))
    per_state = (per_person.groupBy("customer_state")
                 .agg(F.sum("s").alias("s"), F.sum("n").alias("n"),
                      F.sum("days").alias("days"), F.sum("nd").alias("nd"),
                      F.count(F.lit(1)).alias("persons"),
                      F.count_if(F.col("k") > 1).alias("repeat"))
                 .select("customer_state",
                         F.try_divide(F.col("s").cast("double"), F.col("n")).alias("score"),
                         F.try_divide(F.col("days").cast("double"), F.col("nd"))
                         .alias("days"),
                         F.try_divide(F.col("repeat").cast("double"), F.col("persons"))
                         .alias("rep")))
    mm = per_state.agg(*[f(c_).alias(f"{n}_{c_}") for c_ in ("score", "days", "rep")
                         for n, f in (("lo", F.min), ("hi", F.max))])

    def scaled(c_, invert=False):
        num = (F.col(f"hi_{c_}") - F.col(c_)) if invert else (F.col(c_) - F.col(f"lo_{c_}"))
        return F.coalesce(F.try_divide(num, F.col(f"hi_{c_}") - F.col(f"lo_{c_}")), F.lit(0.0))
    w1, w2, w3 = INDEX_WEIGHTS
    idx = 100.0 * (w1 * scaled("score") + w2 * scaled("days", True) + w3 * scaled("rep"))
    return per_state.crossJoin(F.broadcast(mm)).select(
        "customer_state", F.round("score", 4).alias("avg_review_score"),
        F.round("days", 2).alias("avg_delivery_days"),
        F.round(F.col("rep") * 100.0, 2).alias("repeat_share"),
        F.round(idx, 2).alias("satisfaction_index"))


# ----------------------------------------------------------- elasticity ----
def price_elasticity(order_items: DataFrame, products: DataFrame,
                     orders: DataFrame) -> DataFrame:
    """Per category: slope of log units on log mean price, one point for each
    product and month (items with a positive quantity and price, dated orders).
    ``items`` counts the item rows behind the points."""
    ts = F.col("order_purchase_timestamp")
    sold = (order_items.filter((F.col("quantity") > 0) & (F.col("price") > 0))
            .join(orders.filter(ts.isNotNull()).select("order_id", _month_index(ts).alias("m")),
                  "order_id")
            .groupBy("product_id", "m")
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("quantity").alias("units"),
                 money_sum("price").alias("cents")))
    lp = F.ln(from_cents("cents") / F.col("units"))
    return (sold.join(products.select("product_id", "product_category_name"), "product_id")
            .groupBy(F.coalesce("product_category_name", F.lit(MISC))
                     .alias("product_category_name"))
            .agg(F.sum("rows").alias("items"),
                 F.round(F.regr_slope(F.ln("units"), lp), 6).alias("elasticity")))
