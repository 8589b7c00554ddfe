"""Uniform shuffle into exact shards by a hypergeometric communication matrix.

The rows are pinned in their partitions first, so that counting and dealing see
the same ones. Shard sizes are fixed to within one row. How many rows each
partition sends to each shard is then drawn row by row of the matrix from the
multivariate hypergeometric law, over the places still open in each shard:
exactly the counts a uniform permutation of all rows would give. Within a
partition the shard labels are dealt the same way, CHUNK rows at a time, so a
partition streams through in bounded memory. After the exchange the rows of a
shard are permuted again: each drew a random 62-bit key, and its slot is its
rank by key. Ranks come from counts per key range (one row per shard and range)
plus the rank within the range, so no task holds a whole shard. A range holds
about ``range_rows`` rows or ``range_bytes`` bytes, whichever is less; only one
row is never split.

Everything drawn depends on the seed and the number of rows in each pinned
partition alone, not on how they are batched: a task that is run again deals
the same labels, and the counts per range are drawn without reading a row.

Results for odd input: rows with null or equal values are rows like any other
(every row gets a place of its own); an empty table gives an empty table. The
operator adds ``shard`` (int) and ``slot`` (long, gapless from 0 in each
shard); columns of those names are replaced. All other columns travel, whole
texts too: each is stored once (the pinned rows) and exchanged once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pinned, short_batches

CHUNK = 10_000            # rows of a partition that are dealt at a time
KEYS = 1 << 62
RANGE_BYTES = 32 << 20


def shard_sizes(n: int, shards: int) -> np.ndarray:
    return np.array([n // shards + (s < n % shards) for s in range(shards)], np.int64)


def split_draw(rng: np.random.Generator, left: np.ndarray, take: int) -> np.ndarray:
    """How many of ``take`` places, drawn without replacement from ``left``,
    fall on each shard."""
    n = int(left.sum())
    if n < 1_000_000_000:  # as far as numpy's exact draw goes
        return rng.multivariate_hypergeometric(left, take, method="marginals")
    # beyond: draw distinct places and count them by shard
    places = np.unique(rng.integers(0, n, take))
    while len(places) < take:
        more = rng.integers(0, n, take - len(places))
        places = np.unique(np.concatenate([places, more]))
    shard = np.searchsorted(np.cumsum(left), places, side="right")
    return np.bincount(shard, minlength=len(left))


def communication_matrix(counts: dict[int, int], shards: int, seed: int) -> dict[int, np.ndarray]:
    """Rows of each partition for each shard; columns add up to exact sizes."""
    left = shard_sizes(sum(counts.values()), shards)
    out = {}
    for p in sorted(counts):
        rng = np.random.default_rng([seed, 1, p])
        out[p] = split_draw(rng, left, counts[p])
        left = left - out[p]
    return out


class Deal:
    """Labels and keys of the rows of one partition, in their order."""

    def __init__(self, places: np.ndarray, seed: int, part: int):
        self.left = places.copy()
        self.rng = np.random.default_rng([seed, 2, part])
        self.labels, self.keys = np.empty(0, np.int32), np.empty(0, np.int64)

    def take(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        labels, keys = [self.labels], [self.keys]
        have = len(self.labels)
        while have < n:
            k = min(CHUNK, int(self.left.sum()))
            if not k:
                raise ValueError("a pinned partition holds more rows than were counted")
            take = split_draw(self.rng, self.left, k)
            self.left -= take
            labels.append(self.rng.permutation(
                np.repeat(np.arange(len(take), dtype=np.int32), take)))
            keys.append(self.rng.integers(0, KEYS, k))
            have += k
        got, key = np.concatenate(labels), np.concatenate(keys)
        self.labels, self.keys = got[n:], key[n:]
        return got[:n], key[:n]


def ranges_for(n: int, n_bytes: int, shards: int, range_rows: int, range_bytes: int) -> int:
    """Key ranges of a shard."""
    return max(1, math.ceil(n / shards / range_rows), math.ceil(n_bytes / shards / range_bytes))


def shuffle(df: DataFrame, shards: int = 16, seed: int = 20, range_rows: int = 1 << 20,
            range_bytes: int = RANGE_BYTES) -> DataFrame:
    spark = df.sparkSession
    short_batches(spark)
    names = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    rows = pinned(df.select(*names, F.spark_partition_id().alias("__from__")))
    found = rows.groupBy("__from__").agg(F.count("*"), F.sum(_row_bytes(rows, names))).collect()
    counts = {r[0]: r[1] for r in found}
    n, n_bytes = sum(counts.values()), sum(r[2] for r in found)
    matrix = spark.sparkContext.broadcast(communication_matrix(counts, shards, seed))
    ranges = ranges_for(n, n_bytes, shards, range_rows, range_bytes)
    width = -(-KEYS // ranges)

    def deal(batches):
        deals = {}
        for b in batches:
            start = b.column(len(names)).to_numpy()
            labels = np.empty(len(start), np.int32)
            keys = np.empty(len(start), np.int64)
            for p in np.unique(start).tolist():
                if p not in deals:
                    deals[p] = Deal(matrix.value[p], seed, p)
                at = np.nonzero(start == p)[0]
                labels[at], keys[at] = deals[p].take(len(at))
            yield pa.RecordBatch.from_arrays(
                b.columns[:len(names)] + [pa.array(labels), pa.array(keys),
                                          pa.array((keys // width).astype(np.int32))],
                names=[*names, "shard", "__key__", "__range__"])

    def count_ranges(batches):
        for b in batches:
            for p in b.column(0).to_pylist():
                places = matrix.value[p]
                deals, todo = Deal(places, seed, p), int(places.sum())
                sums = np.zeros(shards * ranges, np.int64)
                while todo:
                    labels, keys = deals.take(min(CHUNK, todo))
                    todo -= len(labels)
                    sums += np.bincount(labels * ranges + keys // width, minlength=len(sums))
                at = np.nonzero(sums)[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((at // ranges).astype(np.int32)),
                     pa.array((at % ranges).astype(np.int32)), pa.array(sums[at])],
                    names=["shard", "__range__", "count"])

    schema = T.StructType([rows.schema[c] for c in names]
                          + [T.StructField("shard", T.IntegerType()),
                             T.StructField("__key__", T.LongType()),
                             T.StructField("__range__", T.IntegerType())])
    dealt = rows.mapInArrow(deal, schema)
    if shards * ranges > int(spark.conf.get("spark.sql.shuffle.partitions")):
        dealt = dealt.repartition(shards * ranges, "shard", "__range__")
    sizes = spark.createDataFrame([(p,) for p in sorted(counts)], "part int") \
        .mapInArrow(count_ranges, "shard int, __range__ int, count long") \
        .groupBy("shard", "__range__").agg(F.sum("count").alias("count"))
    before = Window.partitionBy("shard").orderBy("__range__") \
        .rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("shard", "__range__",
                        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__base__"))
    within = Window.partitionBy("shard", "__range__").orderBy("__key__", *_orderable(dealt, names))
    return dealt.withColumn("__rank__", F.row_number().over(within)) \
        .join(base, ["shard", "__range__"]) \
        .select(*names, "shard", (F.col("__base__") + F.col("__rank__") - 1).cast("long")
                .alias("slot"))


def _row_bytes(df: DataFrame, names: list[str]) -> Column:
    """About the bytes of a row: eight a fixed-width value."""
    size = F.lit(8 * len(names)).cast("long")
    for c in names:
        kind, col = df.schema[c].dataType, F.col(f"`{c}`")
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            col = col.cast("string")
        elif not isinstance(kind, (T.StringType, T.BinaryType)):
            continue
        size = size + F.coalesce(F.octet_length(col), F.lit(0))
    return size


def _orderable(df: DataFrame, names: list[str]) -> list[str]:
    """Columns that break the (practically absent) ties of keys."""
    return [c for c in names if isinstance(df.schema[c].dataType, (T.NumericType, T.StringType))]
