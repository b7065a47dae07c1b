"""Shared helpers of the training-data operators."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.session import ensure_checkpoint_dir


def read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Scan a table, keeping only the named columns (extra ones never clash)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a table in the shared folder.

    The table outlives any executor, so a lost one costs a re-read of its
    splits and never the work before the cut.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


def worker_memory(name: str, make: Callable):
    """What a Python worker keeps from one task to the next; only ever a cache.

    Workers outlive stages, so what another operator kept goes first: names
    that agree behind their first hyphen belong together.
    """
    home = sys.modules.setdefault("stratum_worker_memory", types.ModuleType("stratum_worker_memory"))
    kept = home.__dict__.setdefault("kept", {})
    if name not in kept:
        owner = name.partition("-")[2]
        for other in [k for k in kept if k.partition("-")[2] != owner]:
            del kept[other]
        kept[name] = make()
    return kept[name]
