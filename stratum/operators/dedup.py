"""Latest-version deduplication (W-1, W-2) that a hot key cannot stall.

The newest version of a key is row 1 of ``row_number() OVER (PARTITION BY
keys ORDER BY c1 DESC NULLS LAST, ...)``.  Only that row is ever kept, and
the plan is written as ``row_number() ... = 1``: Catalyst then plans a
*partial* ``WindowGroupLimit`` before the shuffle, so every map task sends
at most one row per key.  A key holding a third of all rows therefore costs
one row per map task in the shuffle, never the whole group in one task.

A full window over the key (every row with its rank) would put a hot key's
rows in one task; ``flag_latest`` avoids it by joining each row to its key's
newest version instead, a join that AQE can split on the row side.

The last ordering column must be unique per row (a source rank) so that the
newest version is unique, as ``row_number`` needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.session import ensure_checkpoint_dir

LATEST = "_latest"
_RN = "_version_rn"


def _newest_first(order: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in order]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """One row per key: its newest version, with all of ``df``'s columns."""
    w = Window.partitionBy(*keys).orderBy(*_newest_first(order))
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def _null_safe_keys(df: DataFrame, keys: Sequence[str]) -> dict[str, Column]:
    """(value-or-placeholder, is-null) per key: equality on these pairs is
    the NULL-safe match, and both join sides can be partitioned by them."""
    types = {f.name: f.dataType for f in df.schema.fields}
    norm: dict[str, Column] = {}
    for i, k in enumerate(keys):
        placeholder = F.lit("") if isinstance(types[k], T.StringType) else F.lit(0).cast(types[k])
        norm[f"_k{i}"] = F.coalesce(F.col(k), placeholder)
        norm[f"_n{i}"] = F.col(k).isNull()
    return norm


def flag_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    flag: str = "is_latest",
    versions: DataFrame | None = None,
) -> DataFrame:
    """Every row of ``df`` plus a boolean ``flag``: is it its key's newest?

    The per-key newest ordering values come from the map-side-limited
    window above (narrow columns only); each row is joined back to them on
    the NULL-safe key (NULL keys form one group, as in a window partition).
    The per-key side has one row per key, so a hot key is skew only on the
    row side, which AQE's skew-join handling splits for this join shape.

    ``versions`` may supply the ``keys + order`` columns of every row of
    ``df`` from a cheaper plan (e.g. a table ``df`` was derived from by
    row-preserving lookups); by default they are taken from ``df``.
    """
    keys = list(keys)
    order = list(order)
    norm = _null_safe_keys(df, keys)
    left = df.withColumns(norm)
    # The window is partitioned by the raw keys and the join uses the
    # (value, is-null) pairs: the per-key side then gets a shuffle of its own
    # (narrow, one row per key) right under the join, so both join inputs are
    # plain shuffle stages and AQE can split a hot key's partition on the row
    # side instead of sending it to one task.
    version_rows = (versions if versions is not None else df).select(*keys, *order)
    newest = latest_per_key(version_rows, keys, order).select(
        *[expr.alias(name) for name, expr in norm.items()], F.struct(*[F.col(c) for c in order]).alias(LATEST)
    )
    joined = left.join(newest, on=list(norm), how="inner")
    # Struct equality treats NULL fields as equal, so a newest version whose
    # order_ts is NULL still matches itself.
    is_latest = F.coalesce(F.struct(*[F.col(c) for c in order]) == F.col(LATEST), F.lit(False))
    return joined.select(*[F.col(c) for c in df.columns], is_latest.alias(flag))


def version_rank(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rank_col: str = "row_rank",
    partitions: int | None = None,
) -> DataFrame:
    """Every row with its exact version rank (1 = newest), as
    ``row_number() OVER (PARTITION BY keys ORDER BY order DESC NULLS LAST)``
    gives it, without sending a key's whole history to one task.

    Rows are range partitioned by key and version, so a hot key, even one
    whose versions share an instant, lies in as many partitions as its rows
    need.  A row's place in its sorted partition, less the place where its key
    begins there, is its rank among the key's rows of that partition; the
    counts of a key's earlier partitions, one row each, are summed and added.

    The sorted rows are checkpointed once, as the plan is built: ranges come
    from a sample, and a second run of the shuffle could cut them elsewhere.
    ``partitions`` defaults to the session's shuffle partitions, coalesced.
    """
    keys = list(keys)
    ensure_checkpoint_dir(df.sparkSession)
    by = [*[F.col(k).asc_nulls_first() for k in keys], *_newest_first(order)]
    ranged = df.repartitionByRange(*([partitions] if partitions else []), *by)
    placed = ranged.sortWithinPartitions(*by).withColumn("_place", F.monotonically_increasing_id()).checkpoint(eager=True)
    # The upper bits of such an id are the partition's number.
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    parts = placed.groupBy(*keys, "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *[F.col(k).alias(f"_o_{k}") for k in keys],
        F.col("_part").alias("_o_part"),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_offset"),
    )
    cond = F.col("_part") == F.col("_o_part")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    rank = (F.col("_place") + F.col("_offset") + 1).cast("int").alias(rank_col)
    return placed.join(offsets, cond).select(*[F.col(c) for c in df.columns], rank)
