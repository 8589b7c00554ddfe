"""Helpers shared by the operators: reading tables, Arrow mapping, samples."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows per Arrow batch. Texts are unbounded, so batches are kept short in rows:
# a worker holds one batch and its results at a time.
BATCH_ROWS = 512

# Words are runs of anything but these six ASCII blanks.
WORD = "[^\\x20\\x09-\\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text column; null counts as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once: an expression used inside a lambda
    would be evaluated again for every element."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def id_remainder(divisor: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id written as text, modulo ``divisor``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % divisor


def short_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows of an Arrow batch for this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def map_columns(df: DataFrame, inputs: Sequence[Column],
                start: Callable[[], Callable[..., list]],
                fields: Sequence[T.StructField]) -> DataFrame:
    """Append ``fields`` computed from ``inputs``, one Arrow batch at a time.

    ``start()`` runs once per task and returns ``fn(*arrays) -> list of Arrow
    arrays``, one per field. All columns of ``df`` stay; one that carries the
    name of a new field is replaced by it.
    """
    short_batches(df.sparkSession)
    names = {f.name.lower() for f in fields}
    keep = [c for c in df.columns if c.lower() not in names]
    tmp = [f"__in{i}__" for i in range(len(inputs))]
    src = df.select(*[df[f"`{c}`"] for c in keep],
                    *[c.alias(n) for c, n in zip(inputs, tmp, strict=True)])
    kinds = [arrow_type(f.dataType) for f in fields]
    new = [f.name for f in fields]
    schema = T.StructType([src.schema[c] for c in keep] + list(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = start()
        for b in batches:
            got = fn(*[b.column(b.schema.get_field_index(n)) for n in tmp])
            old = [b.column(i) for i in range(len(keep))]
            cols = [g if isinstance(g, (pa.Array, pa.ChunkedArray)) else pa.array(g, k)
                    for g, k in zip(got, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(old + cols, names=keep + new)

    return src.mapInArrow(run, schema)


def sample_fraction(keep: Column, *on: str) -> Column:
    """True for rows whose hash over ``on`` falls below the fraction ``keep``."""
    steps = 1 << 30
    return F.pmod(F.xxhash64(*[F.col(c) for c in on]), F.lit(steps)) < keep * steps


def pinned(df: DataFrame) -> DataFrame:
    """``df`` stored in the shared checkpoint folder: lineage is cut, and every
    later pass sees the same rows in the same partitions."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def blocks_for(n_bytes: int, per_block: int) -> int:
    return max(1, math.ceil(n_bytes / per_block))
