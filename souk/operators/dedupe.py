"""Duplicate detection without a per-key sort.

``ROW_NUMBER() OVER (PARTITION BY key ORDER BY ...) > 1`` sorts each key group
inside one task. A hot key (e.g. every row with a NULL id, or one id copied a
million times) then lands in a single task. Here a hash aggregate on the key
alone finds the repeated keys, the first row of each is found with an ordinary
aggregate (``min`` of a struct, combined on the map side, so a hot key is
pre-reduced on every executor), and only those rows are joined back; the join is
many-to-one, so AQE can broadcast the small side or split a hot key's rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

ROW_ID = "_souk_rid"


def flag_duplicates(df: DataFrame, keys: Sequence[str], flag: str = "is_duplicate",
                    order_by: Sequence[str] | None = None,
                    stable: bool = False) -> DataFrame:
    """Add boolean ``flag``: True for every row but the first of its key.

    Keys compare NULL-safe, so all rows with a NULL key form one group (as in
    SQL's PARTITION BY and pandas' ``duplicated``). The first row is the
    smallest by ``order_by`` (default: all columns, ascending, NULLs first);
    identical copies are told apart by a row id, and which copy of identical
    rows wins does not change the result.

    The row id comes from the input's partition layout, so ``df`` must be a
    deterministic scan (a Parquet table or a union of them); the pipeline
    stages its input as a table before validating. For any other input (e.g.
    the output of a shuffle) pass ``stable=True``: the tagged rows are then
    written once with a reliable ``checkpoint()`` to the session's
    ``spark.checkpoint.dir``, which fixes the ids and cuts the lineage.
    """
    order_by = list(order_by or df.columns)
    tagged = df.withColumn(ROW_ID, F.monotonically_increasing_id())
    if stable:
        ensure_checkpoint_dir(df.sparkSession)
        tagged = tagged.checkpoint(eager=True)
    names = [f"_k_{i}" for i in range(len(keys))]
    keyed = [F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]

    def match(left: DataFrame, right: DataFrame):
        return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[n])
                                           for k, n in zip(keys, names, strict=True)])

    # a hash aggregate on the key alone finds the repeated keys; only their
    # rows are compared, and only their first rows are joined back
    repeated = (tagged.groupBy(*keyed).agg(F.count(F.lit(1)).alias("_n"))
                .filter("_n > 1").select(*names))
    first = (tagged.join(repeated, match(tagged, repeated), "left_semi").groupBy(*keyed)
             .agg(F.min(F.struct(*order_by, ROW_ID))[ROW_ID].alias("_first")))
    return (tagged.join(first, match(tagged, first), "left")
            .withColumn(flag, F.coalesce(F.col(ROW_ID) != F.col("_first"), F.lit(False)))
            .drop(ROW_ID, "_first", *names))
