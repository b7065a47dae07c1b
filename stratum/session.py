"""Spark session settings the engine relies on.

Everything here is a plain ``SparkSession`` configuration.  On a cluster the
submitter owns master, memory and ``spark.checkpoint.dir``; this module only
fills in what is unset so that local runs and tests behave like the cluster.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every run needs for correct, repeatable results.
REQUIRED_CONF = {
    # Timestamps are rendered and compared in UTC, never in the host zone.
    "spark.sql.session.timeZone": "UTC",
    # Bad casts raise instead of silently producing NULL; parsing that must be
    # lenient uses try_* functions explicitly.
    "spark.sql.ansi.enabled": "true",
    # ``row_number() ... = 1`` must plan a partial (map-side) group limit: it
    # is what keeps a hot key from reaching one task (see operators/dedup.py).
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
}

# Settings for throughput at scale: adaptive re-planning coalesces small
# shuffle partitions and splits skewed join partitions at run time.  Sizes are
# of compressed bytes: sorted keys take some fifteen times as much of a task's
# memory, and a parquet split holds many rows of the few columns that are read.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Bounds of a task's memory: a smaller value of the submitter stays, a larger one is lowered.
TASK_BOUNDS = (
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    "spark.sql.files.maxPartitionBytes",
)

# Initial shuffle partition count on a cluster when none is configured: AQE
# starts from this many and coalesces them to ~128 MB each, so one shuffle of
# up to ~4 TB keeps tasks near the advisory size (larger ones spill, never
# fail), while small shuffles collapse to a few tasks.
CLUSTER_INITIAL_SHUFFLE_PARTITIONS = 32768


def build_session(
    master: str | None = None,
    app_name: str = "stratum",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine's settings.

    ``master`` and ``shuffle_partitions`` are only applied when given, so a
    cluster submit keeps its own values.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {**REQUIRED_CONF, **SCALE_CONF, **(extra or {})}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the settings to an existing session (e.g. the driver's).

    Settings that results depend on always hold; those for throughput leave
    alone what the submitter has set, except that ``TASK_BOUNDS`` are bounds.
    """
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    given = spark.sparkContext.getConf()
    scale = dict(SCALE_CONF)
    if not spark.sparkContext.master.startswith("local"):
        # On a cluster, coalesce shuffle partitions to the advisory size
        # (~16 MB per task) rather than to the core count; in local mode
        # the data is small and the cores are the limit.
        scale["spark.sql.adaptive.coalescePartitions.parallelismFirst"] = "false"
        if spark.conf.get("spark.sql.shuffle.partitions") == "200":
            scale["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(CLUSTER_INITIAL_SHUFFLE_PARTITIONS)
    for key, value in scale.items():
        if not given.contains(key) or (key in TASK_BOUNDS and _size(given.get(key)) > _size(value)):
            spark.conf.set(key, value)


def _size(value: str) -> int:
    """Bytes of a size as Spark writes it: ``64m``, ``128MB``, ``1000``."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)i?b?", value.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that value
    always wins.  Only a session without one (a test, a laptop) gets a fresh
    local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="stratum-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
