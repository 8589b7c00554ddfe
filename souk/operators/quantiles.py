"""Exact discrete quantiles of groups of any size.

Equal values are counted first (a combinable aggregate), so a value that a third
of all rows hold is one row. The counts are dealt by ranges of (group, value)
and pinned; prefix sums over the ranges tell which range holds a wanted rank, and
only the rows of those ranges are added up value by value. Nothing is repeated
until it fits, so infinite values and denormals are values like others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranks import by_ranges


def exact_quantiles(df: DataFrame, by: str, value: str | Column,
                    qs: Sequence[float]) -> DataFrame:
    """(by, quantiles): for each group the values at the ranks ceil(q * n), in
    the order of ``qs``. Missing values and NaN do not count; a group with no
    other has no row. A null group is a group."""
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    counts = (df.select(F.col(by).alias("g"), v.alias("v"))
              .filter(F.col("v").isNotNull() & ~F.isnan("v"))
              .groupBy("g", "v").agg(F.count(F.lit(1)).alias("n")))
    rows = by_ranges(counts, "g", "v").drop("__place__")
    whole = Window.partitionBy("pg")
    before = whole.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy(F.col("__part__").alias("p"), F.col("g").alias("pg")) \
        .agg(F.sum("n").alias("m")) \
        .select("p", "pg", "m", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("before"),
                F.sum("m").over(whole).alias("all"))
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(q)).alias("q"))
                                 for i, q in enumerate(qs)]))
    rank = F.greatest(F.ceil(F.col("all") * F.col("w.q")), F.lit(1)) - F.col("before")
    asked = parts.select("*", wanted.alias("w")).select("p", "pg", "m", "w.i", rank.alias("rank")) \
        .filter((F.col("rank") > 0) & (F.col("rank") <= F.col("m"))) \
        .groupBy("p", "pg").agg(F.collect_list(F.struct("i", "rank")).alias("asks"))
    # asks: one entry per quantile at most
    inside = Window.partitionBy("__part__", "g").orderBy("v")
    hit = rows.join(asked, (F.col("__part__") == F.col("p")) & F.col("g").eqNullSafe(F.col("pg"))) \
        .withColumn("upto", F.sum("n").over(inside))
    here = F.filter("asks", lambda a: (a["rank"] <= F.col("upto"))
                    & (a["rank"] > F.col("upto") - F.col("n")))
    return (hit.select("g", "v", F.explode(here).alias("a"))
            .groupBy(F.col("g").alias(by))
            .agg(F.transform(F.sort_array(F.collect_list(F.struct("a.i", "v"))),
                             lambda x: x["v"]).alias("quantiles")))
