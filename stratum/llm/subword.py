"""Subword-bag classifiers: averaged hashed embeddings into a linear softmax.

A word has one hashed vector for itself and one for each of its character
n-grams; its embedding is their mean, a document's is the mean of its words',
and a linear softmax sits on top.  Embeddings and softmax are trained jointly
by stochastic gradient descent in numpy on a bounded sample of labelled rows.

Since everything below the softmax is an average, a trained two-class model
boils down to one number a hash bucket: a document's log-odds are the mean over
its words of the mean over the word's buckets.  Tasks score with these numbers
and remember the value of words that they have met.
"""

from __future__ import annotations

import math
import pickle
import uuid
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from zlib import crc32 as _crc

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import worker_memory

BUCKETS = 1 << 16
#: A word's value is kept while fewer than this many words are known; then the memory starts anew.
KNOWN_WORDS = 400_000
LONG_WORD = 64


@dataclass(frozen=True)
class Features:
    """How a text becomes hash buckets.

    ``words`` splits a text, ``normal`` maps a word to the form that is hashed.
    """

    words: Callable[[str], list[str]]
    normal: Callable[[str], str]
    shortest: int = 3
    longest: int = 5
    #: So many words without meaning join every text: few words prove little.
    padding: int = 0
    #: Whether a repeated word counts once.
    distinct: bool = False

    def buckets(self, word: str) -> list[int]:
        """Buckets of the word itself and of its n-grams, which see its ends."""
        w = self.normal(word)
        if not w:
            return []
        framed = f"<{w}>"
        sizes = range(self.shortest, self.longest + 1)
        if framed.isascii():
            raw = framed.encode()
            found = [_crc(raw[i : i + n]) % BUCKETS for n in sizes for i in range(len(raw) - n + 1)]
        else:
            found = [
                _crc(framed[i : i + n].encode("utf-8", "replace")) % BUCKETS for n in sizes for i in range(len(framed) - n + 1)
            ]
        found.append(_crc(b"w" + w.encode("utf-8", "replace")) % BUCKETS)
        return found

    def counted(self, text: str) -> list[tuple[str, int]]:
        """Words with their weight in the average: once each, or as often as they occur."""
        words = self.words(text)
        return [(w, 1) for w in set(words)] if self.distinct else list(Counter(words).items())

    def bag(self, text: str, known: dict[str, list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct buckets of a whole text and their weights, which sum to 1."""
        ids: list[int] = []
        weights: list[float] = []
        total = 0
        for word, n in self.counted(text):
            b = known.get(word)
            if b is None:
                b = self.buckets(word)
                if len(word) <= LONG_WORD:
                    if len(known) >= KNOWN_WORDS // 8:
                        known.clear()
                    known[word] = b
            if b:
                ids += b
                weights += [n / len(b)] * len(b)
                total += n
        if not total:
            return np.zeros(0, np.uint16), np.zeros(0, np.float32)
        total += self.padding
        dense = np.bincount(ids, weights, minlength=BUCKETS)
        used = np.flatnonzero(dense)
        return used.astype(np.uint16), (dense[used] / total).astype(np.float32)


@dataclass(frozen=True)
class Training:
    #: Labelled rows of class 0 and of class 1 that are fitted, at most.
    rows: tuple[int, int] = (2000, 2000)
    dimensions: int = 8
    #: Steps of the descent; a smaller sample is gone through more often.
    steps: int = 48_000
    rate: float = 0.5
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """Log-odds a bucket, and those of a text without words."""

    value: list[float]
    bias: float
    features: Features
    name: str
    #: Whether rows of both classes were fitted.
    learnt: bool = True

    def word_value(self, word: str) -> float | None:
        b = self.features.buckets(word)
        return sum(map(self.value.__getitem__, b)) / len(b) if b else None

    def score(self, text: str, known: dict[str, float | None]) -> float:
        """Probability of class 1 of a whole text."""
        total, n = 0.0, 0
        for word, count in self.features.counted(text):
            try:
                v = known[word]
            except KeyError:
                v = self.word_value(word)
                if len(word) <= LONG_WORD:
                    if len(known) >= KNOWN_WORDS:
                        known.clear()
                    known[word] = v
            if v is not None:
                total += count * v
                n += count
        odds = self.bias + (total / (n + self.features.padding) if n else 0.0)
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, odds))))


def fit(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, features: Features, t: Training) -> Model:
    """Joint stochastic gradient descent with a rate that adapts to each parameter.

    One class alone gives a constant score; no rows at all give 0.5.
    """
    rng = np.random.default_rng(t.seed)
    emb = rng.normal(0, 1 / t.dimensions, (BUCKETS, t.dimensions)).astype(np.float32)
    seen = np.full((BUCKETS, t.dimensions), 1e-6, np.float32)
    out = rng.normal(0, 1, (2, t.dimensions)).astype(np.float32)
    out_seen = np.full((2, t.dimensions), 1e-3, np.float32)
    bias = np.zeros(2, np.float32)
    if len(labels):
        share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
        bias[:] = np.log([1 - share, share])
    epochs = -(-t.steps // max(1, len(labels)))
    for epoch in range(epochs):
        rate = np.float32(t.rate * (1 - epoch / epochs))
        for i in rng.permutation(len(labels)):
            ids, w = bags[i]
            if not len(ids):
                continue
            rows = emb[ids]
            h = w @ rows
            z = out @ h + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            grad = w[:, None] * (p @ out)
            grad_out = p[:, None] * h
            scale = seen[ids] + grad * grad
            seen[ids] = scale
            emb[ids] = rows - rate * grad / np.sqrt(scale)
            out_seen += grad_out * grad_out
            out -= np.float32(0.2) * rate * grad_out / np.sqrt(out_seen)
            bias -= np.float32(0.02) * rate * p
    value = (emb @ (out[1] - out[0])).astype(np.float64) if len(labels) else np.zeros(BUCKETS)
    return Model(value.tolist(), float(bias[1] - bias[0]), features, uuid.uuid4().hex, len(set(labels.tolist())) == 2)


def held_out(modulus: int, remainder: int, id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % modulus == remainder, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, features: Features, t: Training) -> Model:
    """Fit a model on a bounded sample of ``labels`` (doc_id, label) and their texts.

    The sample takes ``t.rows`` rows of each class at most, by a hash of their
    ids, so it is the same however the tables are split.  Texts become bags of
    at most ``BUCKETS`` numbers in tasks; the driver sees bags alone.
    """
    known = labels.filter(F.col("doc_id").isNotNull()).select("doc_id", F.col("label").cast("int").alias("label"))
    sample = None
    for label, n in enumerate(t.rows):
        part = known.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        sample = part if sample is None else sample.unionAll(part)
    # At most sum(t.rows) rows of two numbers, whatever the size of the tables.
    texts = docs.select("doc_id", "text").join(F.broadcast(sample.dropDuplicates(["doc_id"])), "doc_id")
    texts = texts.dropDuplicates(["doc_id"]).select("doc_id", "label", "text")

    def bags(batches):
        words: dict[str, list[int]] = {}
        for batch in batches:
            found = [features.bag(x or "", words) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    batch.column(1).cast(pa.int32()),
                    pa.array([x.tobytes() for x, _ in found], pa.binary()),
                    pa.array([w.tobytes() for _, w in found], pa.binary()),
                ],
                names=["doc_id", "label", "ids", "weights"],
            )

    rows = texts.mapInArrow(bags, "doc_id bigint, label int, ids binary, weights binary").toArrow()
    order = np.argsort(rows["doc_id"].to_numpy())
    found = list(zip(_views(rows["ids"], np.uint16), _views(rows["weights"], np.float32), strict=True))
    return fit([found[i] for i in order], rows["label"].to_numpy()[order].astype(np.int64), features, t)


def _views(column: pa.ChunkedArray, dtype: type) -> list[np.ndarray]:
    """The arrays that a binary column holds, where they are; its values one by one would be copies."""
    out = []
    for chunk in column.cast(pa.binary()).chunks:
        if len(chunk):
            _, offsets, data = chunk.buffers()
            at = np.frombuffer(offsets, np.int32)[chunk.offset :][: len(chunk) + 1] // np.dtype(dtype).itemsize
            flat = np.frombuffer(data, dtype, at[-1]) if at[-1] else np.zeros(0, dtype)
            out += np.split(flat[at[0] :], at[1:-1] - at[0])
    return out


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row, in one pass without a shuffle."""
    shipped = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))
    name = model.name

    def scores(batches):
        model = worker_memory(f"model-{name}", lambda: pickle.loads(shipped.value))
        known = worker_memory(f"words-{name}", dict)
        for batch in batches:
            found = [model.score(x or "", known) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(found, pa.float64())], names=["doc_id", "score"]
            )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        scores, "doc_id bigint, score double"
    )


def judged(docs: DataFrame, labels: DataFrame, out, features: Features, t: Training) -> DataFrame:
    """Train on the labelled rows that are not held out and score all documents."""
    model = train(docs, labels.filter(~out), features, t)
    return score(docs, model).select(
        "doc_id", out.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )


def keep(docs: DataFrame, model: Model, wanted: int) -> DataFrame:
    """The rows of ``docs`` whose text the model puts into the wanted class, with all their columns.

    A model that has not seen both classes tells nothing: every row is kept.
    """
    if not model.learnt:
        return docs
    shipped = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))
    name = model.name

    def filtered(batches):
        model = worker_memory(f"model-{name}", lambda: pickle.loads(shipped.value))
        known = worker_memory(f"words-{name}", dict)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            ok = [(model.score(x or "", known) >= 0.5) == bool(wanted) for x in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(ok, pa.bool_()))

    return docs.mapInArrow(filtered, docs.schema)
