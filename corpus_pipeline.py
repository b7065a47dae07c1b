"""The corpus pipeline: documents in, packed training sequences out.

Every stage takes what its predecessor kept, by whole texts, and returns the
columns of documents for what it keeps; only the last returns pieces of packed
sequences.  A stage's result is written before the next one reads it.
"""

from __future__ import annotations

import gc

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import read, written
from stratum.llm.decontamination import leaks
from stratum.llm.minhash import near_duplicates
from stratum.llm.packing import pack
from stratum.llm.quality import quality_model
from stratum.llm.subword import Model, keep
from stratum.llm.toxicity import toxicity_model

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _trained(model: Model) -> Model:
    """Give back the driver's memory of the sample; the model itself is small."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    return model


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that score as toxic; the model learns from the labelled ones among ``docs``.

    Null and empty texts, long ones (scored whole) and repeated rows get a
    score like any other, rows without an id too.  If not both classes are
    labelled among ``docs``, every document is kept; an empty table stays empty.
    """
    model = _trained(toxicity_model(docs, read(spark, sf_dir, "labels", "doc_id", "toxic")))
    return keep(docs.select(*COLUMNS), model, wanted=0)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that score as of low quality; the model learns from the labelled ones among ``docs``.

    Null and empty texts, long ones, repeated rows, rows without an id, and
    tables without labels or rows are treated as by ``toxicity``.
    """
    model = _trained(quality_model(docs, read(spark, sf_dir, "labels", "doc_id", "quality")))
    return keep(docs.select(*COLUMNS), model, wanted=1)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates, the one with the least id.

    Exact repeats of a row are one document.  Rows that share an id but not
    the text are documents of their own, told apart by a hash of both; which
    of them stands for its group is then up to the hash.  Null and empty texts
    are near nothing and stay, as do rows without an id.
    """
    docs = docs.select(*COLUMNS)
    text = F.xxhash64(F.col("text").isNull(), "text")
    texts = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(text).alias("a"), F.max(text).alias("b"))
    shared = written(texts.filter("a != b").select("doc_id", F.lit(True).alias("shared")), "shared-ids")
    if shared.isEmpty():
        keyed = docs.withColumn("key", F.col("doc_id"))
    else:
        own = F.xxhash64("doc_id", F.col("text").isNull(), "text")
        keyed = docs.join(shared, "doc_id", "left").withColumn("key", F.when(F.col("shared"), own).otherwise(F.col("doc_id")))
    groups = near_duplicates(keyed.select("key", "text"), width=5, percent=80, id_col="key")
    gone = groups.filter("NOT kept").select(F.col("doc_id").alias("key")).distinct()
    named = keyed.filter("doc_id IS NOT NULL").join(gone, "key", "left_anti")
    once = named.dropDuplicates(["key", "text"]).select(*COLUMNS)
    return once.unionByName(docs.filter("doc_id IS NULL"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold an item of the benchmark, as asked or with other values.

    Null and empty texts hold none and stay, as do rows without an id, which
    cannot be named; rows that share an id go together.  Texts are searched
    whole, and an empty benchmark or table drops nothing.
    """
    held = leaks(docs, read(spark, sf_dir, "benchmark", "item_id", "text")).select("doc_id").distinct()
    return docs.select(*COLUMNS).join(held, "doc_id", "left_anti").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 2048 ids.

    Every row is a document, repeats and rows without an id too; a null or
    empty text is its end id alone, and a long one runs on through as many
    sequences as it needs.  An empty table makes no pieces.
    """
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Tokenizing and the classifiers cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each stage's result is written and read again."""
    docs = read(spark, sf_dir, "documents", *COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
