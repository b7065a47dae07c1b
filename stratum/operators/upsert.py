"""Keyed upsert (K-3, K-4, J-1) as a set-based DataFrame rewrite.

``MERGE INTO target USING source ON target.k = source.k WHEN MATCHED THEN
UPDATE ... WHEN NOT MATCHED THEN INSERT ...`` without a delete branch is:
target rows whose key is not in the source, plus every source row.  Matching
is SQL equality, so a NULL key never matches (as in MERGE).  Applying the same
source twice gives the same table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """The upsert source holds one key more than once."""


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-NULL keys that occur more than once (aggregated, partial combine)."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return source.filter(cond).groupBy(*keys).count().filter(F.col("count") > 1)


def keyed_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    stamp_col: str | None = "loaded_at",
    stamp: Column | None = None,
    check_unique: bool = True,
) -> DataFrame:
    """Update matched keys, insert new keys, keep the rest; never delete.

    ``stamp_col`` is set to ``stamp`` (default ``current_timestamp()``) on
    updated and inserted rows; untouched target rows keep their value.  A
    source with a repeated key is refused: the rewrite would duplicate rows
    where MERGE would fail.
    """
    keys = list(keys)
    if check_unique and duplicate_keys(source, keys).limit(1).count() > 0:
        raise DuplicateKeyError(f"upsert source is not unique on {keys}")
    if stamp_col:
        stamp = stamp if stamp is not None else F.current_timestamp()
        source = source.withColumn(stamp_col, stamp.cast(dict(target.dtypes).get(stamp_col, "timestamp")))
    kept = target.join(source.select(*keys), on=keys, how="left_anti")
    return kept.unionByName(source.select(*target.columns))


def upsert_changes(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per source key, whether the upsert updates or inserts it (K-4's
    affected-row count is this table's size)."""
    keys = list(keys)
    matched = target.select(*keys).distinct().withColumn("_matched", F.lit(True))
    return (
        source.select(*keys)
        .join(matched, on=keys, how="left")
        .select(*keys, F.when(F.col("_matched"), F.lit("update")).otherwise(F.lit("insert")).alias("change"))
    )
