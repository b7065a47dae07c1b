"""Join helpers for a row side with hot keys against a side unique per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_unique_side(
    rows: DataFrame,
    unique: DataFrame,
    rows_key: str,
    unique_key: str,
    how: str = "left",
) -> DataFrame:
    """Join many ``rows`` to a side with one row per key, skew-splittable.

    The unique side usually comes out of an aggregate already partitioned by
    its key, so Spark would join it without a shuffle of its own; AQE can then
    not split a hot key of the row side (its skew-join rule needs a shuffle
    right under both join inputs).  Joining on ``(hash(key), key)`` gives the
    unique side a narrow shuffle of its own, and a key holding a third of all
    rows is split over many tasks instead of landing in one.  The hash is part
    of the equality, so the result is the plain equi-join on the key.
    """
    r = rows.withColumn("_jh", F.xxhash64(F.col(rows_key)))
    u = unique.withColumn("_uh", F.xxhash64(F.col(unique_key)))
    cond = (r["_jh"] == u["_uh"]) & (r[rows_key] == u[unique_key])
    return r.join(u, cond, how).drop("_jh", "_uh")
