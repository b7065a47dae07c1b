"""Spelling variants: a vocabulary joined with itself within one edit, on sorted lists.

A sorted list of words is scanned once for each of its words.  The banded edit
matrix (three cells a row) grows by a row a character, and neighbours in the
list share the rows of their longest common prefix.  Where a row holds no cell
below two, no word that shares the prefix can be near, and the scan jumps to
the first word that doesn't.

Lists are made for Spark to spread.  Two words one edit apart agree in the
first or in the last half of the shorter one, so a word stands in four lists:
as the shorter and as the longer of a pair, by its head and by its tail.  A
list with over ``LIST_WORDS`` words is cut anew: its words agree in one half,
so halves of what they need not agree in name shorter lists, down to a single
character, where the alphabet bounds the list.  No pair is lost, and no list
grows with the vocabulary.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import read, written

MIN_LENGTH, MIN_COUNT = 6, 5
#: A variant's form is this many times as frequent, or more.
DOMINANCE = 5
#: A list with more words is cut anew.
LIST_WORDS = 1024
#: Counts that a task keeps before it hands them on.
KEPT_WORDS = 300_000
#: Of the occurrences whose checksum this number divides, a letter is lost.
LOSS = 199
#: A run of letters; A-Z are lower-cased before.
_RUN = re.compile("[a-zÀ-ÿ]+")


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: partial counts of the words of whole texts, of MIN_LENGTH or longer; sum them a word."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def flushed():
            found = [(w, n) for w, n in counts.items() if len(w) >= MIN_LENGTH]
            counts.clear()
            words, n = [w for w, _ in found], [n for _, n in found]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                start = zlib.crc32(f"{doc}:".encode()) if doc is not None else None
                for run, n in Counter(_RUN.findall(text.encode("utf-8", "replace").lower().decode() if text else "")).items():
                    if len(run) >= MIN_LENGTH:
                        if start is not None and (h := zlib.crc32(run.encode(), start)) % LOSS == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                        counts[run] += n
                if len(counts) > KEPT_WORDS:
                    yield flushed()
        yield flushed()

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")).mapInArrow(rows, "word string, n bigint")


def near_pairs(words: list[str]) -> Iterator[tuple[str, str]]:
    """Pairs of different words of a sorted list that are one edit apart, by a scan for each word."""
    n = len(words)
    shared = [0] * (n + 1)
    for i in range(1, n):
        a, b = words[i - 1], words[i]
        most = min(len(a), len(b))
        k = 0
        while k < most and a[k] == b[k]:
            k += 1
        shared[i] = k
    # The next word that shares less with its neighbour than this one does.
    less, stack = [n] * (n + 1), []
    shared[n] = -1
    for i in range(n + 1):
        while stack and shared[stack[-1]] > shared[i]:
            less[stack.pop()] = i
        stack.append(i)

    for i in range(n - 1):
        word = words[i]
        size = len(word)
        # Row d: the edits between the first d characters of the list's word
        # and the first d-1, d and d+1 of this one; 2 stands for more.
        rows = [(2, 0, 1)] + [(1, 0, 1)] * size
        j, kept = i + 1, shared[i + 1]
        while j < n:
            other = words[j]
            length = len(other)
            d, dead = min(kept, length), -1
            del rows[d + 1 :]
            low, mid, high = rows[d]
            while d < length:
                c = other[d]
                new_low = min(low + (d < 1 or d > size or c != word[d - 1]), mid + 1)
                new_mid = min(mid + (d >= size or c != word[d]), high + 1, new_low + 1)
                new_high = min(high + (d + 1 >= size or c != word[d + 1]), new_mid + 1)
                d += 1
                # Cells beyond the end of this word don't exist.
                low, mid, high = new_low, new_mid if d <= size else 2, new_high if d < size else 2
                if low > 1 and mid > 1 and high > 1:
                    dead = d
                    break
                rows.append((low, mid, high))
            if dead < 0:
                gap = size - length
                if (low, mid, high)[gap + 1] == 1 if -1 <= gap <= 1 else False:
                    yield word, other
                j += 1
                kept = shared[j]
            else:
                # Skip the words that share the prefix no word within one edit has.
                j += 1
                while shared[j] >= dead:
                    j = less[j]
                kept = shared[j]


def _lists(words: DataFrame, size: Column, head: Column, tail: Column) -> DataFrame:
    """Each word in a list of its own half: ``size`` characters of a pair's shorter word, of which
    the first ``head`` and the last ``tail`` agree, and one half of the others."""
    half = F.floor((size - head - tail) / 2).cast("int")
    cuts = F.array(
        F.struct((head + half).alias("head"), tail.alias("tail")),
        F.struct(head.alias("head"), (size - head - half).alias("tail")),
    )
    return (
        words.select("word", size.alias("size"), F.explode(cuts).alias("cut"))
        .select("word", "size", "cut.head", "cut.tail")
        .withColumn(
            "list",
            F.xxhash64(
                "size", "head", "tail", F.expr("left(word, head)"), F.expr("right(word, tail)")
            ),
        )
    )


def _compared(lists: DataFrame) -> DataFrame:
    """``word, other`` of the pairs inside each list, from one pass over sorted partitions."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, words, by_tail, found = None, [], False, []

        def scanned() -> None:
            if len(words) > 1:
                # Lists by tail are scanned from their ends, so that neighbours share the most.
                if by_tail:
                    found.extend((a[::-1], b[::-1]) for a, b in near_pairs(sorted(w[::-1] for w in words)))
                else:
                    found.extend(near_pairs(sorted(words)))

        for batch in batches:
            names, tails = batch.column(2).to_pylist(), batch.column(1).to_pylist()
            for name, tail, word in zip(batch.column(0).to_pylist(), tails, names, strict=True):
                if name != current:
                    scanned()
                    current, words, by_tail = name, [], tail
                words.append(word)
            if len(found) > 50_000:
                yield _pairs(found)
                found = []
        scanned()
        yield _pairs(found)

    def _pairs(found) -> pa.RecordBatch:
        cols = [pa.array([p[k] for p in found], pa.string()) for k in (0, 1)]
        return pa.RecordBatch.from_arrays(cols, names=["word", "other"])

    dealt = lists.select("list", (F.col("tail") > F.col("head")).alias("by_tail"), "word")
    return dealt.repartition("list").sortWithinPartitions("list").mapInArrow(rows, "word string, other string")


def near_words(vocabulary: DataFrame, limit: int = LIST_WORDS) -> DataFrame:
    """``word, other``: every ordered pair of ``vocabulary.word`` (distinct) that is one edit apart."""
    words = vocabulary.select("word", F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("size"))
    words = words.filter("size > 0")
    lists = _lists(words, F.col("size"), F.lit(0), F.lit(0))
    found = None
    while True:
        lists = written(lists, "lists")
        sizes = lists.groupBy("list").agg(F.count("*").alias("n"), F.first(F.col("size") - F.col("head") - F.col("tail")).alias("open"))
        several = written(sizes.filter("n > 1"), "list-sizes")
        long = several.filter((F.col("n") > limit) & (F.col("open") > 1)).select("list")
        short = several.filter((F.col("n") <= limit) | (F.col("open") <= 1)).select("list")
        pairs = _compared(lists.join(short, "list"))
        found = pairs if found is None else found.unionAll(pairs)
        if long.isEmpty():
            break
        lists = _lists_of(lists.join(long, "list"))
    both = found.unionAll(found.select(F.col("other").alias("word"), F.col("word").alias("other")))
    return both.distinct()


def _lists_of(lists: DataFrame) -> DataFrame:
    return _lists(lists.select("word", "size", "head", "tail"), F.col("size"), F.col("head"), F.col("tail"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of words that have a form, by doubling: a form's count is five times as large, so chains are short."""
    at = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        at = written(at.join(on, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        if at.filter("moved").isEmpty():
            return at.select("word", "root")
        at = at.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word with MIN_COUNT occurrences or more in ``docs``.

    Words are the runs of letters of at least MIN_LENGTH characters, A-Z
    lower-cased.  Of occurrences whose checksum of id and run LOSS divides, the
    run loses a character; the others, and those of rows without an id, count
    as they are.  Null and empty texts hold none, every row counts (repeats
    too), and texts are read whole.  ``form`` is the most frequent near word
    (the smallest of equals) if it is DOMINANCE times as frequent as the word.
    An empty table has no words; other columns of ``docs`` are ignored.
    """
    counted = word_counts(docs, id_col, text_col).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)
    words = written(counted, "words")
    near = written(near_words(words), "near")
    best = (
        near.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
        .groupBy("word")
        .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    )
    out = words.join(best, "word", "left")
    rules = -F.col("best.less") >= DOMINANCE * F.col("n")
    out = out.select(
        "word",
        F.when(rules, F.col("best.other")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(rules, -F.col("best.less")).alias("form_n"),
    )
    out = written(out, "forms")
    roots = _roots(out.filter("form IS NOT NULL"))
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: spelling variants among the words of all documents."""
    return variants(read(spark, sf_dir, "documents", "doc_id", "text"))


def spelling_sql() -> str:
    """The same by brute force: checksums from a table of bytes, near words by their strings less one character.

    A checksum runs on from the id's: its state passes the run's length in
    zero bytes, then joins the run's own checksum from state zero.
    """
    return r"""
WITH RECURSIVE steps AS (
  SELECT i::BIGINT AS byte, i::BIGINT AS v, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT byte, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS MATERIALIZED (SELECT list(v ORDER BY byte) AS t FROM steps WHERE k = 8),
runs AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
    FROM documents) GROUP BY ALL HAVING length(run) >= 6),
sums AS MATERIALIZED (
  SELECT run, octet_length(encode(run)) AS bytes, list_reduce(list_prepend(0::BIGINT, list_transform(
    range(0, octet_length(encode(run))), lambda i: ('0x' || substr(hex(encode(run)), (2 * i + 1)::INT, 2))::BIGINT)),
    lambda s, b: xor(t[xor(s & 255, b) + 1], s >> 8)) AS own
  FROM (SELECT DISTINCT run FROM runs), crc),
ids AS (
  SELECT doc_id, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR || ':', ''),
    lambda c: ascii(c)::BIGINT)), lambda s, b: xor(t[xor(s & 255, b) + 1], s >> 8)) AS state
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), crc),
passed AS (
  SELECT doc_id, 0 AS bytes, state FROM ids
  UNION ALL SELECT doc_id, bytes + 1, xor(t[(state & 255) + 1], state >> 8) FROM passed, crc
  WHERE bytes < (SELECT max(bytes) FROM sums)),
hashed AS (
  SELECT run, n, xor(xor(state, own), 4294967295::BIGINT) AS h
  FROM runs JOIN sums USING (run) LEFT JOIN passed USING (doc_id, bytes)),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
      ELSE run END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
less AS MATERIALIZED (
  SELECT word, i, length(word) AS size, substr(word, 1, i::INT - 1) || substr(word, i::INT + 1) AS part
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other FROM less a JOIN less b ON a.part = b.part AND a.i = b.i AND a.size = b.size AND a.word != b.word
  UNION SELECT word, part FROM less WHERE part IN (SELECT word FROM words)
  UNION SELECT part, word FROM less WHERE part IN (SELECT word FROM words)),
best AS (
  SELECT a.word, count(*) AS n_near, first(b.word ORDER BY b.n DESC, b.word) AS other, max(b.n) AS other_n
  FROM near a JOIN words b ON a.other = b.word GROUP BY a.word),
forms AS MATERIALIZED (
  SELECT word, CASE WHEN other_n >= 5 * n THEN other END AS form, n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN other_n >= 5 * n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root, form AS beyond FROM forms
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.beyond)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, root FROM chain WHERE beyond IS NULL) USING (word)"""
