"""SparkSession defaults and the shared checkpoint folder.

The library never creates its own session on a cluster: callers pass one in.
``local_session`` is for tests, the bench and the smoke entry point.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from real shuffle sizes
# (runtime broadcast with sort-merge fallback, skew-join splitting, partition
# coalescing); UTC keeps timestamp maths identical to the SQL oracle.
CORE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce to the advisory partition size, not to one task per core: fewer,
    # fuller tasks on a busy cluster (the setting Spark recommends there)
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int = 8, shuffle_partitions: int | None = None,
                  app: str = "souk") -> SparkSession:
    """A local[N] session configured like the cluster jobs expect."""
    parts = shuffle_partitions or cpus
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(parts))
               .config("spark.driver.memory", "16g"))
    for key, value in CORE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared folder named by ``spark.checkpoint.dir`` (or already set on
    the SparkContext); None if neither is set."""
    value = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return (value or spark.conf.get("spark.checkpoint.dir", None)
            or spark.sparkContext.getCheckpointDir())


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, registering it with the SparkContext.

    A session without ``spark.checkpoint.dir`` gets a private folder only in
    local mode; on a cluster a machine-local folder would be lost with the
    executor, so the setting is required there.
    """
    root = checkpoint_root(spark)
    sc = spark.sparkContext
    if root is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder "
                               "on a cluster")
        root = tempfile.mkdtemp(prefix="souk-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def cluster_conf(input_bytes: int, cores: int,
                 input_per_partition: int = 1024 ** 3) -> dict[str, str]:
    """Settings sized for a job reading ``input_bytes`` on ``cores`` cores.

    Shuffle partitions: one per ``input_per_partition`` of input (a shuffle
    carries only the columns a query uses, so this lands at a few hundred MB
    of shuffle data per partition) and at least two waves of tasks; no cap, so
    partitions keep their size however large the input is. AQE coalesces the
    smaller shuffles to the advisory size and splits skewed partitions. Scan
    splits of 256 MB keep task counts manageable.
    """
    wanted = -(-input_bytes // input_per_partition)
    parts = max(2 * cores, wanted)
    return {
        **CORE_CONF,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 ** 2),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 ** 2),
    }
