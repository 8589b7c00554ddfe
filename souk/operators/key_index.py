"""Key index of appended batches: which of them may hold a key.

Next to each appended batch stands a Bloom filter of its keys, cut into slots of
``SLOT_BITS`` bits by the key's hash, so that a batch of any size is many small
rows, each with the smallest and largest key in it. The number of slots is a
power of two, so the batches differ in few slot counts, and a probe is one
equi-join on (slots, slot) with the rows whose key range the new keys touch
(the range filter reaches the Parquet statistics). A filter never misses a key;
where it errs, the batch it names is read, and the join with its rows decides.

Bitmaps are built and tested by built-in functions and combine on the map side.
Keys with a null part are in no filter: they equal no other key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOT_BITS = 32_768     # of one bitmap (Spark's bitmap functions)
KEYS_PER_SLOT = 3_000  # about 11 bits a key
HASHES = 7             # less than one wrong answer in 100

SCHEMA = "slots long, slot long, bits binary, lo string, hi string"


def _hash(key: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in key])


def _positions(h: Column) -> list[Column]:
    """Bit positions of a key within its slot."""
    return [F.pmod(F.xxhash64(h, F.lit(i)), F.lit(SLOT_BITS)) for i in range(HASHES)]


def _complete(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key]))


def _first(key: Sequence[str]) -> Column:
    return F.col(key[0]).cast("string")


def slots_for(rows: int) -> int:
    """Power of two with at most ``KEYS_PER_SLOT`` keys a slot on average."""
    return 1 << max(0, (-(-rows // KEYS_PER_SLOT) - 1).bit_length())


def build(batch: DataFrame, key: Sequence[str], rows: int) -> DataFrame:
    """The filter of a batch of about ``rows`` rows: one row per slot."""
    slots = slots_for(rows)
    keys = _complete(batch, key).select(_hash(key).alias("h"), _first(key).alias("k"))
    bits = keys.select(F.pmod("h", F.lit(slots)).alias("slot"), "k",
                       F.explode(F.array(*_positions(F.col("h")))).alias("pos"))
    return (bits.groupBy("slot")
            .agg(F.bitmap_construct_agg("pos").alias("bits"), F.min("k").alias("lo"),
                 F.max("k").alias("hi"))
            .select(F.lit(slots).cast("long").alias("slots"), F.col("slot").cast("long").alias("slot"),
                    "bits", "lo", "hi"))


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substr(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.bit_get(byte.cast("int"), (position % 8).cast("int")) == 1


def may_hold(new: DataFrame, key: Sequence[str], index: DataFrame) -> DataFrame:
    """(batch, key columns) of the pairs that an ``index`` (``SCHEMA`` and a column
    ``batch``) does not rule out."""
    keys = _complete(new.select(*key), key).distinct() \
        .withColumns({"__h__": _hash(key), "__k__": _first(key)})
    ends = keys.agg(F.min("__k__").alias("lo"), F.max("__k__").alias("hi")).first()
    if ends["lo"] is None:
        return keys.select(F.lit(None).cast("int").alias("batch"), *key).limit(0)
    near = index.filter((F.col("lo") <= ends["hi"]) & (F.col("hi") >= ends["lo"]))
    # powers of two: few
    counts = [r["slots"] for r in near.select("slots").distinct().collect()]
    probes = keys.withColumn("slots", F.explode(F.array(*[F.lit(c) for c in counts])
                                                .cast("array<bigint>"))) \
        .withColumn("slot", F.pmod("__h__", F.col("slots")))
    hit = reduce(lambda a, b: a & b, [_is_set(F.col("bits"), p)
                                      for p in _positions(F.col("__h__"))])
    return (probes.join(near, ["slots", "slot"])
            .filter(F.col("__k__").between(F.col("lo"), F.col("hi")) & hit)
            .select("batch", *key))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The filters of all batches below ``path`` (folders ``batch=<n>``)."""
    return spark.read.schema(f"{SCHEMA}, batch int").parquet(path)
