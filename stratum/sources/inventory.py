"""Source inventory (S-5, S-7, S-8) and string previews (S-6)."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.sinks.snapshots import missing_path
from stratum.sources.records import HEADER, csv_record_count, csv_records
from stratum.sources.tables import TABLE_NAMES, read_table

INVENTORY_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType(), False),
        T.StructField("present", T.BooleanType(), False),
        T.StructField("row_count", T.LongType(), False),
    ]
)


def source_inventory(spark: SparkSession, sf_dir: str, names: Sequence[str] = TABLE_NAMES) -> DataFrame:
    """``(source, present, row_count)`` per named source.

    Each present source contributes a one-row count aggregate (parquet
    answers it from file footers); a missing one a row with 0.  The rows are
    unioned into one result.
    """
    parts = []
    for name in names:
        try:
            df = read_table(spark, sf_dir, name)
            parts.append(
                df.agg(F.count(F.lit(1)).alias("row_count")).select(
                    F.lit(name).alias("source"), F.lit(True).alias("present"), F.col("row_count")
                )
            )
        except AnalysisException as e:
            if not missing_path(e):
                raise
            parts.append(spark.createDataFrame([(name, False, 0)], INVENTORY_SCHEMA))
    return reduce(DataFrame.unionByName, parts)


def _counted(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """One row, ``n``: the records of a file or folder.  CSV records may span lines; a JSON file is one array."""
    if fmt == "csv":
        return csv_record_count(spark, path)
    reader = spark.read.option("multiLine", True) if fmt == "json" else spark.read
    return reader.format(fmt).load(path).agg(F.count(F.lit(1)).alias("n"))


def file_rows(spark: SparkSession, path: str, fmt: str = "csv") -> int:
    """Records in a file or folder, header excluded; a missing path is 0 (S-5)."""
    try:
        return _counted(spark, path, fmt).first()["n"]
    except AnalysisException as e:
        if not missing_path(e):
            raise
        return 0


def file_inventory(spark: SparkSession, files: dict[str, str], fmt: str = "csv") -> DataFrame:
    """``(source, present, row_count)`` for named files of any format (S-7):
    one count aggregate per present file, unioned; missing files give 0."""
    parts = []
    for name, path in files.items():
        try:
            counted = _counted(spark, path, fmt)
            parts.append(counted.select(F.lit(name).alias("source"), F.lit(True).alias("present"), F.col("n").alias("row_count")))
        except AnalysisException as e:
            if not missing_path(e):
                raise
            parts.append(spark.createDataFrame([(name, False, 0)], INVENTORY_SCHEMA))
    if not parts:
        return spark.createDataFrame([], INVENTORY_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


PACK_SCHEMA = T.StructType(
    [T.StructField("metric", T.StringType(), False), T.StructField("value", T.LongType(), False)]
)


def pack_summary(spark: SparkSession, files: dict[str, tuple[str, str]]) -> DataFrame:
    """``(metric, value)``: record counts of named source and configuration
    files (S-8).  ``files`` maps a metric name to ``(path, fmt)`` where fmt is
    ``csv`` (header row) or ``json`` (one JSON array); a missing file is 0."""
    parts = []
    for metric, (path, fmt) in files.items():
        try:
            parts.append(_counted(spark, path, fmt).select(F.lit(metric).alias("metric"), F.col("n").alias("value")))
        except AnalysisException as e:
            if not missing_path(e):
                raise
            parts.append(spark.createDataFrame([(metric, 0)], PACK_SCHEMA))
    if not parts:
        return spark.createDataFrame([], PACK_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def csv_preview(spark: SparkSession, path: str, limit: int = 2) -> list[dict[str, str]]:
    """First ``limit`` records of a CSV as text, NULL fields left out; a
    missing file gives [] (S-6).  Only ``limit`` rows reach the driver."""
    try:
        records = csv_records(spark, path)
        first = records.orderBy("file", "record_no").limit(1).select("record").collect()
    except AnalysisException as e:
        if not missing_path(e):
            raise
        return []
    if not first:
        return []
    names = next(csv.reader([first[0]["record"]]))
    # Fields are bound by place, so that names may repeat or hold any sign.
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    rows = records.filter(F.col("record_no") > HEADER).orderBy("source_rank").limit(limit)
    fields = rows.select("source_rank", F.from_csv("record", schema, {"escape": '"'}).alias("r")).orderBy("source_rank")
    return [{k: v for k, v in zip(names, row["r"], strict=True) if v is not None} for row in fields.collect()]


def source_preview(df: DataFrame, order_by: Sequence[str], limit: int = 2) -> DataFrame:
    """First ``limit`` rows in key order with every value as text.  A NULL
    stays NULL (a JSON rendering drops it, as ``to_json`` does)."""
    ordered = df.orderBy(*order_by).limit(limit) if order_by else df.limit(limit)
    return ordered.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def preview_json(df: DataFrame) -> DataFrame:
    """Each row as one JSON object; NULL fields are left out."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("record"))
