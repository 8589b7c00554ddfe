"""Top-k rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column],
                    k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group by ``order`` (add a unique column
    last for a deterministic tie-break), numbered 1..k in ``rank``.

    Written as ``row_number() <= k`` so Spark inserts a partial
    WindowGroupLimit before the shuffle: each map task forwards at most k rows
    per group, so a group with millions of rows never reaches one task whole.
    """
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)
