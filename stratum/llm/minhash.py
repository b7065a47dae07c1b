"""Near-duplicate detection by circulant MinHash.

Two fixed permutations serve all signature coordinates: the first scatters a
document's shingles, the second, circularly shifted by k, orders them for
coordinate k.  Bands of coordinates make candidate buckets, and shingle sets
are compared exactly before two documents are linked.

* Documents with equal sets are one class, found by a pre-combined aggregate;
  only the class's least id goes on.
* The members of a bucket are tied to its least member.  The components of
  these ties are loose groups: every pair of documents that meet in a bucket
  is inside one.
* Each loose group is dealt into blocks of bounded size, and each pair of
  blocks is compared exactly, in its own task, with every pair of documents in
  it.  What leaves a task is a spanning forest of the links found, not the
  links: as many rows as documents at most.
* The components of these forests are the result.

No pair is dropped, capped or sampled: documents of similarity 0.8 that share
none of the 24 buckets of 4 coordinates are missed with a probability of
3e-6 a pair.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import read, worker_memory, written
from stratum.llm.graph import components

BANDS, ROWS = 24, 4
#: Documents and shingles of a block, about.
BLOCK_DOCS, BLOCK_SHINGLES = 128, 500_000
KNOWN_WORDS = 400_000
SHIFTS = np.arange(BANDS * ROWS, dtype=np.uint32)[:, None]


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _permute32(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 32-bit integers."""
    x = x ^ (x >> np.uint32(16))
    x = x * np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles.

    A-Z are lower-cased and words are what ASCII white space separates.
    Fewer words than ``width`` are one shingle; no words are none.
    """
    known = worker_memory("minhash-words", dict)
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(known) > KNOWN_WORDS:
        known.clear()
    for w in words:
        if w not in known:
            known[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    count = max(1, len(words) - width + 1)
    out = np.full(count, len(words) if len(words) < width else width, np.uint64)
    for j in range(min(width, len(words))):
        out = _mix64(out * np.uint64(0x9E3779B97F4A7C15) + h[j : j + count])
    return np.unique(out)


def signature(hashes: np.ndarray) -> np.ndarray:
    """Circulant MinHash: coordinate k is the least of the shifted permutation."""
    scattered = (_mix64(hashes) >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(SHIFTS), 0xFFFFFFFF, np.uint32)
    for a in range(0, len(scattered), 2048):
        np.minimum(out, _permute32(scattered[None, a : a + 2048] - SHIFTS).min(axis=1), out=out)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key a band; the band's number is part of it."""
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        key = _mix64(key * np.uint64(0x9E3779B97F4A7C15) + sig.reshape(BANDS, ROWS)[:, j])
    return key.view(np.int64)


def sketch(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n, same, bands``: size, fingerprint and bucket keys of each set."""

    def rows(batches):
        for batch in batches:
            n, same, bands = [], [], []
            for text in batch.column(1).to_pylist():
                s = shingles(text or "", width)
                n.append(len(s))
                same.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                bands.append(band_keys(signature(s)) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(same, pa.binary())]
                + [pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n", "same", "bands"],
            )

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")).mapInArrow(
        rows, "doc_id bigint, n bigint, same binary, bands array<bigint>"
    )


def _sets(docs: DataFrame, width: int) -> DataFrame:
    def rows(batches):
        for batch in batches:
            sets = [shingles(x or "", width).view(np.int64) for x in batch.column("text").to_pylist()]
            kept = [batch.column(c) for c in ("id", "grp", "block", "blocks")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sets, pa.list_(pa.int64()))], names=["id", "grp", "block", "blocks", "hashes"]
            )

    return docs.select("id", "grp", "block", "blocks", "text").mapInArrow(
        rows, "id bigint, grp bigint, block int, blocks int, hashes array<bigint>"
    )


def _forest(ids: np.ndarray, blocks: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of all links between the documents of two blocks (or inside one)."""
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    ids, blocks, sizes = ids[order], blocks[order], sizes[order]
    values, flat = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    mark = np.zeros(len(values), np.int32)
    inside = blocks[0] == blocks[-1] and (blocks == blocks[0]).all()
    root = np.arange(len(ids))
    found = []
    for i in range(len(ids) - 1):
        # Sorted by size: partners are those up to 100 / percent times as large.
        end = int(np.searchsorted(sizes, sizes[i] * 100 // percent, side="right"))
        if end <= i + 1:
            continue
        mine = flat[starts[i] : starts[i + 1]]
        mark[mine] = 1
        shared = np.add.reduceat(mark[flat[starts[i + 1] : starts[end]]], starts[i + 1 : end] - starts[i + 1])
        mark[mine] = 0
        union = sizes[i] + sizes[i + 1 : end] - shared
        linked = 100 * shared >= percent * union
        if not inside:
            linked &= blocks[i + 1 : end] != blocks[i]
        for j in np.flatnonzero(linked) + i + 1:
            a, b = root[i], root[j]
            if a != b:
                root[root == b] = a
                found.append((int(ids[i]), int(ids[j])))
    return found


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``.

    Documents are linked if their shingle sets' similarity is ``percent`` or
    more; a component is named by its least id, whose document is kept.  Null
    and empty texts are linked with nothing and kept.  Rows that repeat an id
    and its text are one document and get a row each; a row with a null id is
    in no component (null, kept).  Other columns of ``docs`` are ignored.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    all_rows = written(sketch(docs, width, "doc_id", "text"), "sketches")
    real = all_rows.filter("n > 0 AND doc_id IS NOT NULL")
    classes = written(real.groupBy("same").agg(F.min("doc_id").alias("id")), "classes")
    heads = real.join(classes.select("same", F.col("id").alias("doc_id")), ["same", "doc_id"], "left_semi")
    members = heads.select(F.col("doc_id").alias("id"), F.explode("bands").alias("bucket")).distinct()
    leaders = members.groupBy("bucket").agg(F.min("id").alias("leader"), F.count("*").alias("members"))
    leaders = written(leaders.filter("members > 1").select("bucket", "leader"), "leaders")
    ties = members.join(leaders, "bucket").filter("id != leader").select(F.col("id").alias("u"), F.col("leader").alias("v"))
    loose = written(components(ties).withColumnRenamed("component", "grp"), "loose")

    sizes = loose.join(heads.select(F.col("doc_id").alias("id"), "n").distinct(), "id").groupBy("grp").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_DOCS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    placed = written(loose.join(sizes, "grp"), "blocks").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks").cast("bigint")).cast("int")
    )
    texts = docs.join(placed.withColumnRenamed("id", "doc_id"), "doc_id").withColumnRenamed("doc_id", "id")
    sets = written(_sets(texts.dropDuplicates(["id", "text"]), width), "sets")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = sets.withColumn("other", other).select(
        "id", "grp", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "hashes"
    )

    def compare(table: pa.Table) -> pa.Table:
        hashes = table["hashes"].combine_chunks()
        at = hashes.offsets.to_numpy()
        flat = hashes.values.to_numpy()
        sets = [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        found = _forest(table["id"].to_numpy(), table["block"].to_numpy(), sets, percent) if len(sets) > 1 else []
        return pa.table({"u": pa.array([u for u, _ in found], pa.int64()), "v": pa.array([v for _, v in found], pa.int64())})

    links = dealt.groupBy("grp", "lo", "hi").applyInArrow(compare, "u bigint, v bigint")
    named = components(links).withColumnsRenamed({"id": "head", "component": "named"})
    named = written(
        classes.join(named, F.col("id") == F.col("head"), "left").select("same", F.coalesce("named", "id").alias("component")),
        "named",
    )
    out = all_rows.select("doc_id", "n", "same").join(named, "same", "left")
    component = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("component")), F.col("doc_id"))
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def minhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: components of near-duplicate documents by 4-word shingles."""
    return near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"), width=4)


def minhash_sql() -> str:
    """The components by brute force over shared shingles."""
    return r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda w: w != '') AS w FROM documents),
sets AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY ALL),
links AS (
  SELECT u, v FROM shared JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
  WHERE 100 * c >= 80 * (x.n + y.n - c)),
both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (
  SELECT doc_id AS id, doc_id AS node FROM documents
  UNION SELECT id, v FROM reach JOIN both_ways ON u = node),
named AS (SELECT id, min(node) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN named ON id = d.doc_id LEFT JOIN sizes USING (doc_id)"""
