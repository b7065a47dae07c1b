"""Packing by concatenating and cutting.

Documents are tokenised once, each closed by an end id, and thought of as one
long stream that is cut every ``length`` ids.

Pass one tokenises each partition, writes the ids to a table in the shared
folder and notes each document's offset inside its partition.  Pass two sums
the partitions' totals into global offsets - one row a partition - and cuts
each document at the multiples of ``length`` it spans.  Nothing but the totals
is ordered globally, and no row is tokenised twice.  A retried task of pass
one rewrites the same rows, and pass two reads a committed table.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.llm.common import read, worker_memory, written

END_ID = 1
LENGTH = 2048
#: A word's ids are kept while fewer than this many words are known; then the memory starts anew.
KNOWN_WORDS = 700_000
LONG_WORD = 64
#: ASCII white space; no token of the word tokenizer spans it.
_WORD = re.compile(r"[^\t-\r ]+")
#: What str.split() takes for white space besides, so that texts with it are split by the pattern.
_ODD_ASCII = "\x1c\x1d\x1e\x1f"
_ODD = _ODD_ASCII + "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Letters and the punctuation after them are separate tokens; apostrophes may join both.
_TAIL = re.compile(r"(.*[A-Za-zÀ-ÖØ-öø-ÿ])([!-&(-/:-@\[-^`{-~]+)")
#: Letters that normalising leaves alone, but for their case.
_LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: The tokenizer's characters for bytes: printable ones stand for themselves, the others follow from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in _PRINTABLE)}

TOKENS = "part int, doc_id bigint, start_in_part bigint, n bigint, ids binary"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _split(text: str) -> list[str]:
    odd = _ODD_ASCII if text.isascii() else _ODD
    return _WORD.findall(text) if any(c in text for c in odd) else text.split()


class WordIds(dict):
    """Ids of a word as little-endian 32-bit integers, remembered by the worker.

    The tokenizer's pattern never matches across white space, so a text's ids
    are those of its words one after the other.  Nor does it match across the
    end of a word's letters, and case does not matter to it: a new word is
    looked up without its punctuation and in lower case first.
    """

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.model = self.tokenizer.model

    def __missing__(self, word: str) -> bytes:
        ids = self._ids(word)
        if len(word) <= LONG_WORD:
            if len(self) >= KNOWN_WORDS:
                self.clear()
            self[word] = ids
        return ids

    def _ids(self, word: str) -> bytes:
        if "<|" not in word and len(word) <= LONG_WORD:
            if found := _TAIL.fullmatch(word):
                return self[found[1]] + self[found[2]]
            if _LETTERS.fullmatch(word):
                if (low := word.lower()) != word:
                    return self[low]
                # Nothing is left to normalise or to split: merging is all.
                found = self.model.tokenize("".join([_BYTE[b] for b in word.encode()]))
                return struct.pack(f"<{len(found)}I", *[t.id for t in found])
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, _split(text)))


def tokenized(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, end_id: int) -> DataFrame:
    """Pass one: ``part, doc_id, start_in_part, n, ids`` of every row."""
    end = end_id.to_bytes(4, "little")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, words, at = TaskContext.get().partitionId(), worker_memory(f"ids-{tokenizer_path}", lambda: WordIds(tokenizer_path)), 0
        for batch in batches:
            ids = [words.encode(t or "") + end for t in batch.column(1).to_pylist()]
            sizes = [len(x) // 4 for x in ids]
            starts = []
            for n in sizes:
                starts.append(at)
                at += n
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(ids), pa.int32()),
                    batch.column(0).cast(pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                names=["part", "doc_id", "start_in_part", "n", "ids"],
            )

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")).mapInArrow(encode, TOKENS)


def pack(
    docs: DataFrame,
    tokenizer_path: str | None = None,
    length: int = LENGTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
) -> DataFrame:
    """Every document's pieces: ``doc_id, start, ids, doc_tokens, sequence_id, offset``.

    ``ids`` holds little-endian 32-bit integers.  All sequences but the last
    are full.  A null or empty text is its end id alone; repeated rows are
    packed as often as they occur; an empty table gives no rows; further
    columns of ``docs`` are ignored.
    """
    tokens = written(tokenized(docs, tokenizer_path or default_tokenizer(), id_col, text_col, end_id), "tokens")
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    # One row for each partition of pass one: bounded by the number of input splits.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    at = tokens.join(F.broadcast(bases), "part").withColumn("first", F.col("base") + F.col("start_in_part"))
    first, last = F.col("first"), F.col("first") + F.col("n")

    def cut(s):
        start = F.greatest(first, s * length)
        stop = F.least(last, (s + 1) * length)
        return F.struct(
            (start - first).alias("start"),
            F.substring(F.col("ids"), ((start - first) * 4 + 1).cast("int"), ((stop - start) * 4).cast("int")).alias("ids"),
            s.alias("sequence_id"),
            (start - s * length).alias("offset"),
        )

    windows = F.sequence(F.floor(first / length), F.floor((last - 1) / length))
    return at.select("doc_id", F.col("n").alias("doc_tokens"), F.explode(F.transform(windows, cut)).alias("p")).select(
        "doc_id", "p.start", "p.ids", "doc_tokens", "p.sequence_id", "p.offset"
    )


def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: all documents in sequences of 2048 ids."""
    pieces = pack(read(spark, sf_dir, "documents", "doc_id", "text"))
    return pieces.select(
        "doc_id",
        "start",
        F.floor(F.octet_length("ids") / 4).alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
