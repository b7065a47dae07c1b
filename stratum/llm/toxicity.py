"""Toxicity: a subword-bag classifier.

A word that was never seen shares character n-grams with those that were, so
misspelt and inflected insults land near the spelling that was labelled.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import read
from stratum.llm.subword import Features, Model, Training, held_out, judged, train

MODULUS, HELD_OUT = 5, 0
_EDGES = re.compile(r"^\W+|\W+$")


def _normal(word: str) -> str:
    return _EDGES.sub("", word.lower())


#: Every word counts once, in lower case and without punctuation at its ends.
FEATURES = Features(words=str.split, normal=_normal, shortest=3, longest=5, padding=30, distinct=True)
#: Clean texts vary more than insults, so more of them are fitted.
TRAINING = Training(rows=(4000, 2000))


def labelled(labels: DataFrame) -> DataFrame:
    return labels.filter(F.col("toxic").isNotNull()).select("doc_id", F.col("toxic").alias("label"))


def toxicity(docs: DataFrame, labels: DataFrame, training: Training = TRAINING) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    Labelled rows with crc32(doc_id) mod 5 = 0 are never learnt from.  A text
    that is null, empty or without words scores the model's prior; rows with a
    null id are scored like any other and count as not held out; repeated rows
    are scored alike; other columns of either table are ignored.
    """
    return judged(docs, labelled(labels), held_out(MODULUS, HELD_OUT), FEATURES, training)


def toxicity_model(docs: DataFrame, labels: DataFrame, training: Training = TRAINING) -> Model:
    return train(docs, labelled(labels).filter(~held_out(MODULUS, HELD_OUT)), FEATURES, training)


def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: toxicity of all documents."""
    return toxicity(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "labels", "doc_id", "toxic"))
