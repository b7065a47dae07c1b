"""Versioned layer tables on any Spark file system (K-1, S-9, S-10, D-4).

Under a root folder each table has ``<table>/data/v=<n>-<run>/`` - the rows
of version ``n``, written by one Spark job into a folder that no other writer
uses - and the root has one commit log, ``log/``, with a row ``(table_name,
version, rows, written_at, folder, schema)`` per committed version, appended
only after the data jobs have committed.  The schema is kept with the version,
so an empty layer reads back as an empty table.

A version exists once its log row exists, so a crashed or retried write is
never visible; readers take the highest logged version.  Several tables can
be committed by one log append, so a run's layers appear together.  History is kept,
which gives time travel (``read_layer(..., version=n)``) and version diffs.
``fmt`` selects the writer format, so a table format with its own log can
be dropped in.  One writer per table at a time.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.operators.contracts import schema_faults

LOG_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("version", T.LongType(), False),
        T.StructField("rows", T.LongType(), False),
        T.StructField("written_at", T.TimestampNTZType(), False),
        T.StructField("folder", T.StringType(), False),
        T.StructField("schema", T.StringType(), False),
    ]
)


class ContractError(ValueError):
    """Rows that break the table's contract; nothing was committed."""


@dataclass(frozen=True)
class Written:
    """A version whose data job has finished, not yet committed."""

    table: str
    version: int
    rows: int
    folder: str
    schema: T.StructType


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def missing_path(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _log_path(root: str) -> str:
    return os.path.join(root, "log")


def commit_log(spark: SparkSession, root: str) -> DataFrame:
    """Every committed version of every table under ``root``."""
    if not path_exists(spark, _log_path(root)):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(_log_path(root))


def table_versions(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The committed versions of ``table`` (empty when there are none)."""
    return commit_log(spark, root).filter(F.col("table_name") == table)


def latest_versions(spark: SparkSession, root: str) -> dict[str, int]:
    """Highest committed version per table, from one small aggregate."""
    rows = commit_log(spark, root).groupBy("table_name").agg(F.max("version").alias("v")).collect()
    return {r["table_name"]: int(r["v"]) for r in rows}


def latest_version(spark: SparkSession, root: str, table: str) -> int | None:
    """Highest committed version, or None (S-10)."""
    return latest_versions(spark, root).get(table)


def latest_delta_version(spark: SparkSession, table_path: str) -> int | None:
    """Highest committed version of a Delta table's folder, by the names in its
    ``_delta_log`` alone (S-10); None without a log or a commit in it."""
    try:
        entries = spark.read.format("binaryFile").load(os.path.join(table_path, "_delta_log", "*.json"))
        version = F.regexp_extract("path", r"/(\d+)\.json$", 1)
        row = entries.select(version.alias("v")).filter("v != ''").agg(F.max(F.col("v").cast("bigint"))).first()
    except AnalysisException as e:
        if not missing_path(e):
            raise
        return None
    return row[0]


def _refuse(table: str, faults: Sequence[str]) -> None:
    if faults:
        raise ContractError(f"{table} breaks its contract: {'; '.join(faults)}")


def write_version(
    df: DataFrame,
    root: str,
    table: str,
    version: int,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    contract: Sequence[tuple[str, str, bool]] | None = None,
) -> Written:
    """Write ``df`` as (uncommitted) version ``version`` of ``table``.

    Rows, and NULLs in columns that the contract says have none, are observed
    during the write (no second job).  Missing, extra or mistyped columns are
    refused before it, NULLs after it; either way nothing is committed.  The
    output committer makes the job all-or-nothing and safe under task retries.
    """
    if table == "log":
        raise ValueError("'log' is the commit log's folder, not a table name")
    if contract is not None:
        _refuse(table, schema_faults(df, contract))
    never_null = [name for name, _, nullable in contract or () if not nullable]
    run = uuid.uuid4().hex
    observed = Observation(f"rows_{table}_{version}_{run[:8]}")
    counts = [F.count(F.lit(1)).alias("rows")] + [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in never_null]
    folder = os.path.join(table, "data", f"v={version}-{run}")
    writer = df.observe(observed, *counts).write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(os.path.join(root, folder))
    got = observed.get
    _refuse(table, [f"{got[f'nulls_{c}']} NULLs in {c}" for c in never_null if got[f"nulls_{c}"]])
    return Written(table, version, int(got["rows"]), folder, df.schema)


def commit(
    spark: SparkSession,
    root: str,
    entries: Sequence[Written],
    written_at: _dt.datetime | None = None,
) -> None:
    """Make written versions visible: one append to the commit log."""
    stamp = written_at or _dt.datetime.now(_dt.timezone.utc).replace(microsecond=0, tzinfo=None)
    rows = [(w.table, w.version, w.rows, stamp, w.folder, w.schema.json()) for w in entries]
    spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(_log_path(root))


def write_snapshot(
    df: DataFrame,
    root: str,
    table: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    written_at: _dt.datetime | None = None,
    contract: Sequence[tuple[str, str, bool]] | None = None,
) -> int:
    """Write ``df`` as the next version of ``table`` and commit it; return
    the version.  The data job finishes before the log row is appended."""
    spark = df.sparkSession
    previous = latest_version(spark, root, table)
    version = 0 if previous is None else previous + 1
    commit(spark, root, [write_version(df, root, table, version, fmt, partition_by, contract)], written_at)
    return version


def read_written(spark: SparkSession, root: str, written: Written, fmt: str = "parquet") -> DataFrame:
    """The rows of a version by its own folder and schema."""
    return spark.read.format(fmt).schema(written.schema).load(os.path.join(root, written.folder))


def read_layer(
    spark: SparkSession,
    root: str,
    layer: str,
    version: int | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Read a layer table by name, case-insensitive, at ``version`` or the
    latest one (S-9).  Unknown or never-written layers raise.  If two writers
    raced for a version, the one that committed last is read."""
    log = table_versions(spark, root, layer.lower())
    if version is not None:
        log = log.filter(F.col("version") == version)
    found = log.orderBy(F.col("version").desc(), F.col("written_at").desc(), "folder").limit(1).collect()
    if not found:
        wanted = "no committed version" if version is None else f"no committed version {version}"
        raise FileNotFoundError(f"layer {layer!r} has {wanted} under {root}")
    schema = T.StructType.fromJson(json.loads(found[0]["schema"]))
    return spark.read.format(fmt).schema(schema).load(os.path.join(root, found[0]["folder"]))


def snapshot_diff(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str] | None = None,
) -> DataFrame:
    """Keys added, removed or changed between two versions (D-4).

    A full outer join on the keys (NULL-safe), then a per-row comparison of
    the ``compare`` columns (default: all non-key columns of ``new``).
    Unchanged keys are not returned.
    """
    keys = list(keys)
    compare = list(compare) if compare is not None else [c for c in new.columns if c not in keys]
    # Both sides get their own key names: the versions often share lineage,
    # and distinct names keep the self join unambiguous.
    o = old.select(*[F.col(k).alias(f"_o_{k}") for k in keys], F.struct(*compare).alias("_old"))
    n = new.select(*[F.col(k).alias(f"_n_{k}") for k in keys], F.struct(*compare).alias("_new"))
    cond = None
    for k in keys:
        c = F.col(f"_o_{k}").eqNullSafe(F.col(f"_n_{k}"))
        cond = c if cond is None else cond & c
    joined = o.join(n, cond, "full_outer")
    change = (
        F.when(F.col("_old").isNull(), F.lit("added"))
        .when(F.col("_new").isNull(), F.lit("removed"))
        .when(~F.col("_old").eqNullSafe(F.col("_new")), F.lit("changed"))
    )
    return joined.select(
        *[F.coalesce(F.col(f"_n_{k}"), F.col(f"_o_{k}")).alias(k) for k in keys], change.alias("change")
    ).filter(F.col("change").isNotNull())
