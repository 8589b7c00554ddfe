"""Exact ranks and equal bands within groups of any size.

A window over a group puts the whole group into one task. Here the rows are
dealt by ranges of (group, order), sorted within a range and pinned; a row's
rank is its place in its range plus the rows of its group in the ranges before.
A group that holds all rows is spread over all tasks, and ties are split by
whatever the order ends with, so end it with an id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_ROW = 33  # monotonically_increasing_id: partition above this bit, row below


def by_ranges(df: DataFrame, *order: str) -> DataFrame:
    """``df`` sorted over all partitions and pinned, with ``__part__``, the number
    of a row's range, and ``__place__``, its place in it."""
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()
    place = F.monotonically_increasing_id()
    return rows.withColumns({"__part__": F.shiftright(place, _ROW),
                             "__place__": place.bitwiseAND(F.lit((1 << _ROW) - 1))})


def ranked(df: DataFrame, by: str, order: Sequence[str], rank_col: str = "rank",
           rows_col: str = "group_rows") -> DataFrame:
    """``df`` with the 0-based rank of each row in its group by ``order`` (nulls
    first, NaN last) and the group's number of rows. Null groups form one group.

    The counts per range and group, one row for each group that a range meets,
    are all that the prefix sums see.
    """
    rows = by_ranges(df, by, *order)
    counts = rows.groupBy("__part__", F.col(by).alias("__by__")).agg(
        F.min("__place__").alias("__first__"), F.count(F.lit(1)).alias("__m__"))
    whole = Window.partitionBy("__by__")
    before = whole.orderBy("__part__").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        F.col("__part__").alias("__at__"), "__by__",
        (F.coalesce(F.sum("__m__").over(before), F.lit(0)) - F.col("__first__")).alias("__shift__"),
        F.sum("__m__").over(whole).alias(rows_col))
    return (rows.join(shifts, (F.col("__part__") == F.col("__at__"))
                      & F.col(by).eqNullSafe(F.col("__by__")))
            .withColumn(rank_col, F.col("__place__") + F.col("__shift__"))
            .drop("__part__", "__place__", "__at__", "__by__", "__shift__"))


def ntile(rank: str | Column, rows: str | Column, bands: int) -> Column:
    """Band 1 to ``bands`` of a 0-based rank among ``rows``: sizes differ by one
    row at most, and larger bands come first."""
    rank, rows = (F.col(c) if isinstance(c, str) else c for c in (rank, rows))
    larger = F.pmod(rows, F.lit(bands))                   # bands with one row more
    size = ((rows - larger) / bands).cast("long")
    inside = larger * (size + 1)                          # rows in those
    return (F.when(rank < inside, F.floor(rank / (size + 1)))
            .otherwise(larger + F.floor(F.try_divide(rank - inside, size))) + 1).cast("int")
