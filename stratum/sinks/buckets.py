"""Keyed tables in hash buckets, so that an upsert rewrites only what it touches (K-4).

A table is a folder of partitions ``bucket=<n>``; a row's bucket follows from
its keys.  An upsert reads the buckets that its source has keys in, merges
them, and overwrites those partitions alone; the files of the others stay.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators.upsert import keyed_upsert
from stratum.session import ensure_checkpoint_dir

BUCKET = "bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """A row's bucket, from its keys."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _gathered(placed: DataFrame) -> DataFrame:
    """Rows gathered by bucket; a large bucket, whose rows one task would have to sort, is cut into tasks of the advisory size."""
    return placed.hint("rebalance", BUCKET)


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Write a new bucketed table; each bucket is gathered, so it has few files."""
    placed = df.withColumn(BUCKET, bucket_of(keys, buckets))
    _gathered(placed).write.partitionBy(BUCKET).parquet(path)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)


def upsert_bucketed(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    buckets: int,
    stamp_col: str | None = None,
    stamp: Column | None = None,
) -> list[int]:
    """Upsert ``source`` into the table at ``path``; return the buckets that were rewritten.

    ``buckets`` must be the number that the table was written with.  Rows of
    untouched buckets are neither read nor written.  The merged buckets go to
    the session's checkpoint folder first: the write never reads the files it
    replaces, and a failed one can be repeated from there.  An empty source
    rewrites nothing.
    """
    ensure_checkpoint_dir(spark)
    placed = source.withColumn(BUCKET, bucket_of(keys, buckets)).checkpoint(eager=True)
    # At most as many numbers as the table has buckets.
    touched = sorted(r[BUCKET] for r in placed.select(BUCKET).distinct().collect())
    if not touched:
        return []
    target = spark.read.parquet(path).filter(F.col(BUCKET).isin(touched))
    columns = [c for c in target.columns if c != BUCKET]
    merged = keyed_upsert(target, placed.select(*[c for c in source.columns if c != stamp_col], BUCKET), keys, stamp_col, stamp)
    merged = merged.select(*columns, BUCKET).checkpoint(eager=True)
    writer = _gathered(merged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(BUCKET).parquet(path)
    return touched
