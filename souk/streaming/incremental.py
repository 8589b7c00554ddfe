"""Incremental (append) loads with Structured Streaming.

New raw files dropped into a folder are picked up as micro-batches; each
micro-batch runs the same stage -> validate -> publish pipeline as a batch load,
in append mode (keys already published are not loaded again). The streaming
checkpoint records which files were consumed; the audit table records which
micro-batches were published, so a micro-batch replayed after a failure is
skipped instead of published twice.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans import pipeline
from ..plans.quality import PRODUCTS, TableSpec
from ..sources.files import CORRUPT, LINE_BREAKS, QUARANTINE, RAW_SCHEMAS, csv_options


def _epoch_tag(spec: TableSpec, epoch_id: int, stream_id: str) -> str:
    """Names one micro-batch of one stream: epochs count from 0 in each."""
    return f"{spec.source_file}#stream={stream_id}#epoch={epoch_id}"


def stream_id_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream of this checkpoint folder: it stays
    through restarts, and a new checkpoint gets another."""
    line = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()
    return json.loads(line["value"])["id"]


def _already_published(spark: SparkSession, root: str, spec: TableSpec,
                       tag: str) -> bool:
    """Whether the audit table holds a SUCCESS row for this micro-batch (a
    lookup in the small audit table, not in the loaded data)."""
    audit = pipeline.read_audit(spark, root)
    return audit.filter((F.col("table_name") == spec.table)
                        & (F.col("status") == "SUCCESS")
                        & (F.col("source_file") == tag)).limit(1).count() > 0


def load_micro_batch(spark: SparkSession, batch: DataFrame, epoch_id: int, *,
                     spec: TableSpec, root: str, stream_id: str, profile: str = "message",
                     load_ts: dt.datetime | None = None) -> dict | None:
    """Publish one micro-batch (idempotent per stream and epoch); a repeated
    one leaves a SKIPPED row in the audit table."""
    tag = _epoch_tag(spec, epoch_id, stream_id)
    if _already_published(spark, root, spec, tag):
        pipeline.record_skip(spark, root, spec, tag, profile, load_ts)
        return None
    return pipeline.run_pipeline(spark, batch, spec, root, profile=profile,
                                 load_ts=load_ts, source_file=tag, incremental=True)


def start_incremental_load(spark: SparkSession, source_dir: str, root: str,
                           checkpoint: str, *, spec: TableSpec = PRODUCTS,
                           raw_table: str = "products", fmt: str = "csv",
                           profile: str = "message", available_now: bool = True,
                           max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start a stream that loads every new file of ``source_dir``.

    ``available_now=True`` processes what is there and stops (a scheduled
    incremental run); otherwise the query keeps watching the folder.
    ``checkpoint`` must be a shared, durable folder (e.g. under the session's
    ``spark.checkpoint.dir``) so a restarted driver resumes where it stopped.
    """
    schema = RAW_SCHEMAS[raw_table]
    if fmt == "csv":
        schema = f"{schema}, {CORRUPT} string"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        stream = reader.options(**csv_options(raw_table in LINE_BREAKS), **QUARANTINE) \
            .csv(source_dir)
    else:
        stream = reader.format(fmt).load(source_dir)

    def each(batch: DataFrame, epoch_id: int) -> None:
        load_micro_batch(spark, batch, epoch_id, spec=spec, root=root, profile=profile,
                         stream_id=stream_id_of(spark, checkpoint))

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
