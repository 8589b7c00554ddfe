"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A broadcast side is shipped to every executor and built into a hash table
# there; keep it well below executor memory even on a 1000-executor cluster.
DEFAULT_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 ** 2


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      known_rows: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast only if it is small in rows and in bytes.

    ``known_rows`` skips the check for driver-built tables whose size is known.
    Otherwise one job measures at most ``max_rows + 1`` rows (the limit stops
    the scan early): 16 bytes a column, and the length of each text. Beyond
    either bound the plain DataFrame is returned, so the join falls back to a
    shuffle join that AQE can still split when skewed.
    """
    if known_rows is not None:
        return F.broadcast(df) if known_rows <= max_rows else df
    width = F.lit(16 * len(df.columns)).cast("long")
    for f in df.schema.fields:
        if f.dataType.typeName() in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(df[f.name]), F.lit(0))
    n, size = df.select(width.alias("w")).limit(max_rows + 1) \
        .agg(F.count(F.lit(1)), F.coalesce(F.sum("w"), F.lit(0))).first()
    return F.broadcast(df) if n <= max_rows and size <= MAX_BROADCAST_BYTES else df
