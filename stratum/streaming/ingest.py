"""Structured Streaming forms of the medallion (not in the batch contract).

* ``start_newest_versions``: new source files arrive as a stream; each
  micro-batch (``foreachBatch``) appends its bronze rows and its own newest
  row per key to a change log - work proportional to the batch, never to
  the table.  Newest-version is an associative choice (the newest of the
  newest), so the newest row per key over the change log equals one batch
  run over all rows, masking included; silver is those rows that pass every
  rule.  Reads reduce the log with the map-side-limited window, and
  ``compact`` folds it into a versioned base snapshot so reads stay small.
  A retried batch overwrites its own batch folders, so every batch lands
  exactly once.
* ``daily_event_counts_stream``: the daily allow-listed event counters as a
  windowed aggregate with a watermark, emitted once a day is complete.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratum.functions.rules import first_match
from stratum.operators import medallion
from stratum.operators.dedup import latest_per_key
from stratum.operators.medallion import ORDER_SPEC, StageSpec
from stratum.sinks import snapshots
from stratum.sources.tables import TABLE_SCHEMAS

NEWEST = "newest"
MARK = "newest_mark"


def file_stream(spark: SparkSession, folder: str, table: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the parquet files of one source table as they land in
    ``folder`` (files named ``<table>*.parquet``), with its declared schema."""
    reader = spark.readStream.schema(TABLE_SCHEMAS[table]).option("pathGlobFilter", f"{table}*.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(folder)


def _changes_path(root: str) -> str:
    return os.path.join(root, "changes")


def append_changes(bronze_batch: DataFrame, root: str, batch_id: int, spec: StageSpec = ORDER_SPEC) -> None:
    """Append one batch's newest row per key (with its rule label) to the
    change log, in the batch's own folder (a retry overwrites it)."""
    labelled = bronze_batch.withColumn("quality_issue", first_match(spec.rules))
    newest = latest_per_key(labelled, spec.keys, spec.version)
    newest.write.mode("overwrite").parquet(os.path.join(_changes_path(root), f"batch_id={batch_id}"))


def _changes(spark: SparkSession, root: str) -> DataFrame | None:
    """The change log, or None before the first batch."""
    path = _changes_path(root)
    return spark.read.parquet(path) if snapshots.path_exists(spark, path) else None


def newest_versions(spark: SparkSession, root: str, spec: StageSpec = ORDER_SPEC) -> DataFrame:
    """Newest row per key over the compacted base and the change log since."""
    parts = []
    upto = -1
    versions = snapshots.latest_versions(spark, root)
    if NEWEST in versions:
        parts.append(snapshots.read_layer(spark, root, NEWEST, versions[NEWEST]))
        upto = snapshots.read_layer(spark, root, MARK, versions[NEWEST]).first()["upto_batch"]
    changes = _changes(spark, root)
    if changes is not None:
        parts.append(changes.filter(F.col("batch_id") > upto).drop("batch_id"))
    if not parts:
        raise FileNotFoundError(f"no streamed versions under {root}")
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return latest_per_key(rows, spec.keys, spec.version)


def compact(spark: SparkSession, root: str, spec: StageSpec = ORDER_SPEC) -> int:
    """Fold the change log into a new base version (newest row per key) and
    return its version; later reads start from it.

    How far the base reaches is a table of its own, committed with it, so that
    it does not depend on the base having rows.
    """
    changes = _changes(spark, root)
    upto = changes.agg(F.max("batch_id")).first()[0] if changes is not None else None
    newest = newest_versions(spark, root, spec)
    version = snapshots.latest_versions(spark, root).get(NEWEST, -1) + 1
    mark = spark.createDataFrame([(-1 if upto is None else int(upto),)], "upto_batch bigint")
    written = [
        snapshots.write_version(newest, root, NEWEST, version),
        snapshots.write_version(mark, root, MARK, version),
    ]
    snapshots.commit(spark, root, written)
    return version


def streamed_silver(spark: SparkSession, root: str, spec: StageSpec = ORDER_SPEC) -> DataFrame:
    """Silver as of the last landed batch."""
    newest = newest_versions(spark, root, spec)
    return medallion.silver_columns(newest.filter(F.col("quality_issue").isNull()))


def _read_batch(bronze: DataFrame, root: str, batch_id: int) -> DataFrame:
    """The batch's bronze rows as written (the batch is computed once)."""
    return bronze.sparkSession.read.parquet(os.path.join(root, "bronze_stream", f"batch_id={batch_id}"))


def start_newest_versions(
    source_stream: DataFrame,
    root: str,
    checkpoint_location: str,
    spec: StageSpec = ORDER_SPEC,
    available_now: bool = True,
) -> StreamingQuery:
    """Run the bronze -> newest-version ingest over a stream of source rows."""

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        bronze = medallion.bronze(batch)
        # One folder per batch id, overwritten on a retry: appends exactly once.
        bronze.write.mode("overwrite").parquet(os.path.join(root, "bronze_stream", f"batch_id={batch_id}"))
        append_changes(_read_batch(bronze, root, batch_id), root, batch_id, spec)

    writer = source_stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def daily_event_counts_stream(
    events: DataFrame,
    allowed_types: Sequence[str],
    lateness: str = "1 day",
) -> DataFrame:
    """Windowed daily counters of allow-listed events.  The watermark lets a
    day's count be emitted (append mode) once events ``lateness`` past its end
    have been seen, and bounds the state kept for open days."""
    # Watermarks need TIMESTAMP; the session runs in UTC, so the cast keeps
    # the wall-clock value of a TIMESTAMP_NTZ column.
    return (
        events.filter(F.col("event_type").isin(*allowed_types))
        .withColumn("event_time", F.col("ts").cast("timestamp"))
        .withWatermark("event_time", lateness)
        .groupBy(F.window("event_time", "1 day").alias("w"), F.col("event_type"))
        .agg(F.count(F.lit(1)).alias("events"))
        .select(F.to_date(F.col("w.start")).alias("day"), "event_type", "events")
    )
