"""Load pipeline: stage -> validate -> split -> publish, with an audit trail.

Zones are folders under one root: ``<root>/<zone>/<table>/batch=<n>`` for
``stg``, ``error`` and ``clean``, and ``<root>/audit/etl_runs`` (append only).
A batch is published by appending its SUCCESS audit row after the error and
clean data are fully written; readers take the newest SUCCESS batch, so a run
that fails half way leaves the previous batch as the visible one (the
reference gets the same from a database transaction). One writer per table at
a time is assumed, as with the reference's identity-based batch ids.
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import strip_ws
from ..operators import key_index
from ..operators.rules import rule_counts, validate_flags, validate_message
from ..sources.files import CORRUPT
from .quality import TableSpec

log = logging.getLogger("souk.pipeline")

# The reference's audit columns plus ``source_file`` (which input a run
# loaded; lets a replayed streaming micro-batch be recognised cheaply) and
# ``profile`` (which rule profile produced the batch).
AUDIT_SCHEMA = ("run_id int, table_name string, rows_loaded long, rows_rejected long, "
                "load_datetime timestamp_ntz, status string, error_message string, "
                "source_file string, profile string, rows_skipped long")
LINEAGE = ("load_datetime", "source_file", "batch_id")
MAX_ERROR_TEXT = 500


# ---------------------------------------------------------------- stage ----
def stage(raw: DataFrame, spec: TableSpec, batch_id: int,
          load_ts: dt.datetime | None = None,
          source_file: str | None = None) -> DataFrame:
    """Raw rows -> staging layout: repaired names, spec columns, lineage."""
    renamed = raw.withColumnsRenamed(spec.renames) if spec.renames else raw
    # from the ISO text, so no time-zone conversion can shift a naive time
    ts = (F.lit(load_ts.isoformat(sep=" ")).cast("timestamp_ntz") if load_ts is not None
          else F.localtimestamp())
    return renamed.select(*spec.columns,
                          ts.alias("load_datetime"),
                          F.lit(source_file or spec.source_file).alias("source_file"),
                          F.lit(batch_id).cast("int").alias("batch_id"))


# ------------------------------------------------------------- validate ----
def dup_order(spec: TableSpec, columns: list[str]) -> list[str]:
    """Tie-break for "which copy is first": the business columns in order."""
    return [c for c in columns if c not in LINEAGE]


def validate_staged(staged: DataFrame, spec: TableSpec) -> DataFrame:
    """SQL profile: staged rows + ``error_flags`` (NULL when valid)."""
    return validate_message(staged, spec.message_rules, spec.key,
                            order_by=dup_order(spec, staged.columns), stable=spec.stable)


def validate_raw(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """pandas profile: raw rows + one flag per rule + ``is_valid``."""
    return validate_flags(raw, spec.flag_rules, spec.key,
                          order_by=dup_order(spec, raw.columns), stable=spec.stable)


def error_rows(validated: DataFrame, spec: TableSpec) -> DataFrame:
    """SQL profile error table: spec columns, message, lineage."""
    return (validated.filter(F.col("error_flags").isNotNull())
            .select(*spec.columns, "error_flags", *LINEAGE))


def clean_rows(validated: DataFrame, spec: TableSpec) -> DataFrame:
    """SQL profile clean table: spec columns, load time and batch."""
    return (validated.filter(F.col("error_flags").isNull())
            .select(*spec.columns, "load_datetime", "batch_id"))


def error_flag_rows(flagged: DataFrame, spec: TableSpec) -> DataFrame:
    """pandas profile error table: source columns as they came + flags."""
    flags = [r.name for r in spec.flag_rules]
    raw_cols = [c for c in flagged.columns if c not in flags and c != "is_valid"]
    return flagged.filter(~F.col("is_valid")).select(*raw_cols, *flags)


def transform(flagged: DataFrame, spec: TableSpec) -> DataFrame:
    """pandas profile clean table: valid rows, repaired names, every string
    column stripped of surrounding whitespace, explicit casts, spec columns."""
    valid = flagged.filter(F.col("is_valid"))
    renamed = valid.withColumnsRenamed(spec.renames) if spec.renames else valid
    strings = [f.name for f in renamed.schema.fields
               if f.dataType.simpleString() == "string" and f.name in spec.columns]
    stripped = renamed.withColumns({c: strip_ws(c) for c in strings})
    cast = stripped.withColumns({c: F.col(c).cast(t) for c, t in spec.clean_casts.items()})
    return cast.select(*spec.columns)


def flag_counts(flagged: DataFrame, spec: TableSpec) -> DataFrame:
    """(rule, n_rows) of the pandas profile: totals and non-zero rules."""
    return rule_counts(flagged, spec.flag_rules)


def message_rule_counts(staged: DataFrame, spec: TableSpec) -> DataFrame:
    """(rule, n_rows) of the SQL profile: the message rules as flags over the
    staged rows (one duplicate pass), totals and non-zero rules."""
    flagged = validate_flags(staged, spec.message_rules, spec.key,
                             order_by=dup_order(spec, staged.columns))
    return rule_counts(flagged, spec.message_rules)


# ---------------------------------------------------------------- audit ----
def audit_path(root: str) -> str:
    return f"{root.rstrip('/')}/audit/etl_runs"


def zone_path(root: str, zone: str, table: str, batch_id: int | None = None) -> str:
    base = f"{root.rstrip('/')}/{zone}/{table}"
    return base if batch_id is None else f"{base}/batch={batch_id}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, asked of the Hadoop file system behind it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _drop_folder(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def read_audit(spark: SparkSession, root: str) -> DataFrame:
    """The audit table (empty, with its schema, before the first run)."""
    if not path_exists(spark, audit_path(root)):
        return spark.createDataFrame([], AUDIT_SCHEMA)
    return spark.read.schema(AUDIT_SCHEMA).parquet(audit_path(root))


def next_batch_id(audit: DataFrame) -> int:
    """max(run_id) + 1, or 1 for an empty audit table (one-row aggregate)."""
    return audit.agg((F.coalesce(F.max("run_id"), F.lit(0)) + 1).alias("n")).first()["n"]


def audit_row(spark: SparkSession, run_id: int, table: str, loaded: int,
              rejected: int, status: str, message: str | None,
              load_ts: dt.datetime, source_file: str | None = None,
              profile: str | None = None, skipped: int = 0) -> DataFrame:
    return spark.createDataFrame(
        [(run_id, table, loaded, rejected, load_ts, status, message, source_file,
          profile, skipped)], AUDIT_SCHEMA)


def record_skip(spark: SparkSession, root: str, spec: TableSpec, source_file: str,
                profile: str, load_ts: dt.datetime | None = None) -> None:
    """Note that an input came again after it was published."""
    now = load_ts or dt.datetime.now().replace(microsecond=0)
    audit_row(spark, next_batch_id(read_audit(spark, root)), spec.table, 0, 0, "SKIPPED",
              "already published", now, source_file, profile) \
        .write.mode("append").parquet(audit_path(root))


def audit_summary(validated: DataFrame, table: str) -> DataFrame:
    """The audit row a run would write, as one aggregate over the validated
    rows: (table_name, rows_loaded, rows_rejected, status, error_message)."""
    return validated.agg(
        F.count_if(F.col("error_flags").isNull()).alias("rows_loaded"),
        F.count_if(F.col("error_flags").isNotNull()).alias("rows_rejected")
    ).select(F.lit(table).alias("table_name"), "rows_loaded", "rows_rejected",
             F.lit("SUCCESS").alias("status"),
             F.lit(None).cast("string").alias("error_message"))


def _published(spark: SparkSession, root: str, table: str, least_rows: int = 0) -> DataFrame:
    """(run_id) of the batches with a SUCCESS audit row and enough rows loaded."""
    return (read_audit(spark, root)
            .filter((F.col("table_name") == table) & (F.col("status") == "SUCCESS")
                    & (F.col("rows_loaded") >= least_rows))
            .select("run_id"))


def newest_batch(spark: SparkSession, root: str, table: str) -> int | None:
    return _published(spark, root, table).agg(F.max("run_id").alias("n")).first()["n"]


def has_published(spark: SparkSession, root: str, table: str) -> bool:
    return newest_batch(spark, root, table) is not None


def read_published(spark: SparkSession, root: str, zone: str, table: str,
                   all_batches: bool = False) -> DataFrame:
    """Rows of the newest batch whose audit row says SUCCESS (or of every
    such batch, for incrementally loaded tables: one scan of the table's folder,
    joined with the audit rows, so no list of batches passes the driver)."""
    newest = newest_batch(spark, root, table)
    if newest is None:
        raise FileNotFoundError(f"no published batch of {table} under {root}")
    one = spark.read.parquet(zone_path(root, zone, table, newest))
    if not all_batches:
        return one
    every = spark.read.schema(T.StructType([*one.schema.fields, T.StructField("batch", T.IntegerType())])).parquet(zone_path(root, zone, table))
    done = _published(spark, root, table)
    return every.join(done, every.batch == done.run_id, "left_semi").select(*one.columns)


def batches_holding(spark: SparkSession, root: str, table: str, new: DataFrame,
                    key: tuple[str, ...]) -> list[int]:
    """The published batches that may hold a key of ``new``: those whose key index
    does not rule all of them out, and those without an index. One number a batch
    comes to the driver; no row of a batch is read."""
    done = _published(spark, root, table, least_rows=1)
    path = zone_path(root, "index", table)
    if not path_exists(spark, path):
        return sorted(r["run_id"] for r in done.collect())
    index = key_index.read(spark, path)
    bare = done.join(index.select("batch").distinct(), F.col("run_id") == F.col("batch"),
                     "left_anti")
    named = key_index.may_hold(new, key, index).select(F.col("batch").alias("run_id")) \
        .distinct().join(done, "run_id", "left_semi")
    return sorted(r["run_id"] for r in bare.unionByName(named).distinct().collect())


def keys_published(spark: SparkSession, root: str, table: str, new: DataFrame,
                   key: tuple[str, ...]) -> DataFrame:
    """(batch, key columns) of the keys of ``new`` that a published batch holds:
    the index names the batches, their key columns decide."""
    found = batches_holding(spark, root, table, new, key)
    held = _read_batches(spark, root, "clean", table, found)
    if held is None:
        return new.select(F.lit(None).cast("int").alias("batch"), *key).limit(0)
    return held.join(new.select(*key).distinct(), list(key), "left_semi") \
        .select("batch", *key).distinct()


def _read_batches(spark: SparkSession, root: str, zone: str, table: str,
                  batches: list[int]) -> DataFrame | None:
    """Rows of some batches, with ``batch``; other folders are not opened."""
    if not batches:
        return None
    whole = zone_path(root, zone, table)
    return spark.read.option("basePath", whole) \
        .parquet(*[zone_path(root, zone, table, b) for b in batches])


def keep_newest(spark: SparkSession, root: str, table: str, keep: int = 1,
                zones: tuple[str, ...] = ("stg", "error", "clean", "malformed", "index")) -> int:
    """Retention for fully refreshed tables: delete the folders of all batches
    but the ``keep`` newest published ones (and of failed runs before them).
    Appended tables need every batch: do not call this for them. Returns the
    number of folders deleted; the audit table keeps all its rows."""
    kept = _published(spark, root, table).orderBy(F.desc("run_id")).limit(keep) \
        .agg(F.min("run_id").alias("n")).first()["n"]
    if kept is None:
        return 0
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    deleted = 0
    for zone in zones:
        folder = jvm.org.apache.hadoop.fs.Path(zone_path(root, zone, table))
        fs = folder.getFileSystem(conf)
        for status in fs.listStatus(folder) if fs.exists(folder) else []:
            name = status.getPath().getName()
            if name.startswith("batch=") and int(name[len("batch="):]) < kept:
                deleted += bool(fs.delete(status.getPath(), True))
    return deleted


# -------------------------------------------------------------- publish ----
def _write_counted(df: DataFrame, path: str) -> int:
    """Write ``df`` and return its row count, observed during the write."""
    obs = Observation()
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return int(obs.get["rows"])


def _write_new(clean: DataFrame, old: DataFrame | None, key: tuple[str, ...],
               path: str) -> tuple[int, int]:
    """Write the rows of ``clean`` whose key ``old`` (None: no rows) does not have;
    returns the numbers of rows written and left out."""
    if old is None:
        return _write_counted(clean, path), 0
    obs, seen = Observation(), "_published_before"
    marked = clean.join(old.select(*key).distinct().withColumn(seen, F.lit(True)),
                        list(key), "left")
    known = F.coalesce(F.col(seen), F.lit(False))
    (marked.observe(obs, F.count_if(~known).alias("new"), F.count_if(known).alias("known"))
     .filter(~known).select(*clean.columns).write.mode("overwrite").parquet(path))
    return int(obs.get["new"]), int(obs.get["known"])


def _tidy(spark: SparkSession, root: str, table: str, batch_id: int) -> None:
    """Drop the working folders of a run. What the run published or recorded
    stands already, so a failure here is noted and no more."""
    for zone in ("arrived", "checked"):
        try:
            _drop_folder(spark, zone_path(root, zone, table, batch_id))
        except Exception as exc:
            log.warning("could not drop %s of %s batch %d: %s", zone, table, batch_id, exc)


def run_pipeline(spark: SparkSession, raw: DataFrame, spec: TableSpec, root: str,
                 profile: str = "message",
                 load_ts: dt.datetime | None = None,
                 source_file: str | None = None,
                 incremental: bool = False, keep: int | None = None) -> dict:
    """Stage, validate, split and publish one batch of ``raw``.

    ``profile`` is ``"message"`` (SQL rules, error_flags text) or ``"flags"``
    (pandas rules, flag columns, cleaned values). On any failure a FAILED
    audit row is appended (counts 0 and the message for the SQL profile,
    counts -1 and its first 500 characters for the pandas profile) and the
    error is raised again; the previous batch stays the published one.

    ``incremental=True`` appends instead of replacing: clean rows whose key is
    already published in an earlier SUCCESS batch are left out and counted as
    skipped, and readers use ``read_published(..., all_batches=True)``. Each such
    batch gets a key index (``operators/key_index``), and a load reads only the
    batches that may hold one of its keys, and those from before the index.

    ``keep=k`` deletes all but the ``k`` newest published batches after a full
    refresh, as the reference empties its tables on each run.

    If ``raw`` has the reader's column of malformed rows, those go to the zone
    ``malformed`` with their raw text and count as rejected. So loaded,
    rejected and skipped rows add up to the rows staged, in every run.
    """
    if keep is not None and incremental:
        raise ValueError("appended tables need every batch: keep is for full refreshes")
    load_ts = load_ts or dt.datetime.now().replace(microsecond=0)
    batch_id = next_batch_id(read_audit(spark, root))
    try:
        # Staging is written once and read back: later steps then re-read a
        # stable table instead of recomputing the raw lineage.
        def written(df: DataFrame, zone: str) -> DataFrame:
            path = zone_path(root, zone, spec.table, batch_id)
            df.write.mode("overwrite").parquet(path)
            return spark.read.parquet(path)

        broken = 0
        if CORRUPT in raw.columns:
            # as read, in one pass over the files; split by the raw text below
            arrived = written(raw, "arrived")
            bad = arrived.filter(F.col(CORRUPT).isNotNull()) \
                .select(CORRUPT, F.lit(source_file or spec.source_file).alias("source_file"))
            broken = _write_counted(bad, zone_path(root, "malformed", spec.table, batch_id))
            raw = arrived.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
        staged = written(stage(raw, spec, batch_id, load_ts, source_file), "stg")
        if profile == "message":
            validated = written(validate_staged(staged, spec), "checked")
            err, clean = error_rows(validated, spec), clean_rows(validated, spec)
        elif profile == "flags":
            # the pandas profile checks the rows as they came (source column
            # names, no lineage); its transform step repairs the names
            source = staged.drop(*LINEAGE).withColumnsRenamed(
                {v: k for k, v in spec.renames.items()})
            validated = written(validate_raw(source, spec), "checked")
            err, clean = error_flag_rows(validated, spec), transform(validated, spec)
        else:
            raise ValueError(f"unknown profile {profile!r}")
        clean_path, skipped = zone_path(root, "clean", spec.table, batch_id), 0
        rejected = broken + _write_counted(err, zone_path(root, "error", spec.table, batch_id))
        if incremental and has_published(spark, root, spec.table):
            _check_profile(spark, root, spec.table, profile)
            old = _read_batches(spark, root, "clean", spec.table, batches_holding(
                spark, root, spec.table, clean, spec.key))
            loaded, skipped = _write_new(clean, old, spec.key, clean_path)
        else:
            loaded = _write_counted(clean, clean_path)
        if incremental:
            key_index.build(spark.read.parquet(clean_path), spec.key, loaded) \
                .write.mode("overwrite").parquet(zone_path(root, "index", spec.table, batch_id))
        audit_row(spark, batch_id, spec.table, loaded, rejected, "SUCCESS", None,
                  load_ts, source_file or spec.source_file, profile, skipped) \
            .write.mode("append").parquet(audit_path(root))
    except Exception as exc:
        log.error("%s batch %d failed: %s", spec.table, batch_id, exc)
        # The SQL procedure records 0/0 and the whole message (4000 chars);
        # the pandas job records -1/-1 and the first 500 characters.
        count, limit = (0, 4000) if profile == "message" else (-1, MAX_ERROR_TEXT)
        try:
            audit_row(spark, batch_id, spec.table, count, count, "FAILED",
                      str(exc)[:limit], load_ts, source_file or spec.source_file,
                      profile) \
                .write.mode("append").parquet(audit_path(root))
        except Exception as audit_exc:  # keep the original error
            log.error("could not write the failure audit row: %s", audit_exc)
        raise
    finally:
        _tidy(spark, root, spec.table, batch_id)
    if keep is not None and not incremental:
        keep_newest(spark, root, spec.table, keep)
    log.info("%s batch %d: %d loaded, %d rejected", spec.table, batch_id, loaded, rejected)
    return {"batch_id": batch_id, "rows_loaded": loaded, "rows_rejected": rejected,
            "rows_skipped": skipped}


def _check_profile(spark: SparkSession, root: str, table: str, profile: str) -> None:
    """Appended batches must share one clean layout, i.e. one rule profile."""
    others = (read_audit(spark, root)
              .filter((F.col("table_name") == table) & (F.col("status") == "SUCCESS")
                      & F.col("profile").isNotNull() & (F.col("profile") != profile))
              .limit(1).count())
    if others:
        raise ValueError(f"{table} was loaded with another rule profile; appending "
                         f"{profile!r} batches would mix two clean layouts")


def empty_clone(df: DataFrame) -> DataFrame:
    """Same columns and types as ``df``, no rows (``SELECT * INTO .. WHERE 1=0``);
    the empty relation is folded away by the optimizer, so nothing is read."""
    return df.limit(0)


def incremental_rows(new: DataFrame, published: DataFrame,
                     key: tuple[str, ...]) -> DataFrame:
    """Rows of ``new`` whose key is not yet published (append-only loads)."""
    return new.join(published.select(*key).distinct(), list(key), "left_anti")
