"""Quality: a subword-bag classifier over words as they are written.

Case and punctuation stay, since shouting and markers tell junk from prose,
and a word that repeats the one before it adds a mark of its own.
"""

from __future__ import annotations

from operator import eq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import read
from stratum.llm.subword import Features, Model, Training, held_out, judged, train

MODULUS, HELD_OUT = 3, 1
AGAIN = "\0again"


def _words(text: str) -> list[str]:
    words = text.split()
    return words + [AGAIN] * sum(map(eq, words, words[1:]))


FEATURES = Features(words=_words, normal=str, shortest=3, longest=5)
TRAINING = Training(rows=(1500, 1500), steps=24_000)


def labelled(labels: DataFrame) -> DataFrame:
    return labels.filter(F.col("quality").isNotNull()).select("doc_id", F.col("quality").alias("label"))


def quality(docs: DataFrame, labels: DataFrame, training: Training = TRAINING) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    Labelled rows with crc32(doc_id) mod 3 = 1 are never learnt from.  A text
    that is null, empty or without words scores the model's prior; rows with a
    null id are scored like any other and count as not held out; repeated rows
    are scored alike; other columns of either table are ignored.
    """
    return judged(docs, labelled(labels), held_out(MODULUS, HELD_OUT), FEATURES, training)


def quality_model(docs: DataFrame, labels: DataFrame, training: Training = TRAINING) -> Model:
    return train(docs, labelled(labels).filter(~held_out(MODULUS, HELD_OUT)), FEATURES, training)


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: quality of all documents."""
    return quality(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "labels", "doc_id", "quality"))
