"""Connected components of a distributed edge list."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import written

#: Edges that one task reduces to stars, about.
TASK_EDGES = 500_000


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``u, v``: each id of the edges that is not the least of its component, and that least id."""
    ids, flat = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = flat[: len(u)], flat[len(u) :]
    root = np.arange(len(ids))
    while len(a):
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(root, up := root[root]):
            root = up
        a, b = root[a], root[b]
        a, b = a[a != b], b[a != b]
    leaves = np.flatnonzero(root != np.arange(len(ids)))
    return ids[leaves], ids[root[leaves]]


def _starred_by_task(edges: DataFrame, tasks: int) -> DataFrame:
    """Edges that make the same components: the stars of what each of so many tasks reads."""

    def reduce(batches):
        read = [(batch.column(0).to_numpy(), batch.column(1).to_numpy()) for batch in batches]
        if read:
            u, v = stars(*map(np.concatenate, zip(*read, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return edges.select("u", "v").coalesce(tasks).mapInArrow(reduce, "u bigint, v bigint")


def _neighbours(edges: DataFrame) -> DataFrame:
    return edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame, least: DataFrame) -> DataFrame:
    """The larger neighbours of each id linked to the least of its neighbours and itself, ``m``."""
    out = _neighbours(edges).filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.filter(F.col("u") != F.col("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """The smaller neighbours of each id, and the id, linked to the least of them."""
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    out = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
    return out.filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` of every id in ``edges`` (columns ``u, v``).

    A component is named by its least id.  Each task reduces the edges it reads
    to stars, without a shuffle; edges that fit one task are done then.  More
    of them go through large-star and small-star steps, which alternate until
    every edge points at its component's least id.  The least neighbours are
    found by a pre-combined aggregate and written, so the joins' hub keys come
    from plain exchanges that Spark may split; each step is written to the
    shared folder, so lineage stays short.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter(F.col("u") != F.col("v"))
    edges = written(edges, "edges")
    tasks = max(1, -(-edges.count() // TASK_EDGES))
    edges = written(_starred_by_task(edges, tasks), "edges")
    if tasks > 1:
        edges = written(edges.distinct(), "edges")
    while tasks > 1:
        below, above = F.col("v") < F.col("u"), F.col("v") > F.col("u")
        least = _neighbours(edges).groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count_if(below).alias("below"), F.count_if(above).alias("above"))
        least = written(least, "least")
        # Stars already: every id has one smaller neighbour, or only larger ones.
        if least.filter("below > 1 OR below = 1 AND above > 0").isEmpty():
            break
        edges = written(_large_star(edges, least.select("u", "m")), "edges")
        edges = written(_small_star(edges), "edges")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
