"""Cross-tokenizer alignment by diagonal run skipping.

A text is encoded by two tokenizers whose tokens cover the same bytes.  Where
a token of A and a token of B end at one byte the text is cut into groups;
tokens whose bytes overlap are linked.

* Both end arrays are walked together.  While A's end ``i + k`` equals B's end
  ``j + k`` the tokens pair one to one along a diagonal of constant index
  shift; exponential probing compares ever longer slices of both arrays at
  that shift and jumps the whole stretch.  Where the slices differ, the ends
  are merged locally until they meet, which closes one irregular group and
  sets the next shift.
* An id pair's count, the number of documents that hold it linked, is summed
  from chunks of documents: a chunk names each of its pairs once, so a pair
  that every document holds makes a row a chunk and not a row a document.  The
  counts return to the chunks the same way.

Both tokenizers start anew at white space, so a text's ids are those of its
words with the white space before them.  Workers remember words' ids.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import read, worker_memory, written

#: Words a worker remembers, about; then the memory starts anew.
KNOWN_WORDS = 350_000
LONG_WORD = 64
#: Characters of text in a chunk, about.
CHUNK_CHARS = 8_000_000
#: Characters that are encoded together, about.
STRETCH_CHARS = 500_000
#: Unicode's white space.
_SPACES = "".join(chr(c) for c in (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
_PIECE_SPACE = "\u2581"
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
#: The byte-level alphabet: printable characters stand for themselves, the others follow from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_OF = {chr(b): b for b in _PRINTABLE} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in _PRINTABLE)}

ALIGNED = (
    "chunk bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "pairs array<bigint>, times array<int>"
)
SCORED = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
)


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def diagonal(ea: list[int], eb: list[int]) -> tuple[list[int], list[int]]:
    """The tokens that close the groups of two end arrays, as indices into either.

    Both arrays rise and close with the same end.
    """
    closing_a, closing_b = [], []
    n = len(ea)
    # Ends that differ stop every stretch.
    ea, eb = [*ea, -1], [*eb, -2]
    i = j = 0
    while i < n:
        x, y = ea[i], eb[j]
        if x == y:
            a, b, w = i, j, 4
            while ea[i : i + w] == eb[j : j + w]:
                i += w
                j += w
                w += w
            # The stretch ends within the next w tokens.
            while w > 4:
                w //= 2
                if ea[i : i + w] == eb[j : j + w]:
                    i += w
                    j += w
            while ea[i] == eb[j]:
                i += 1
                j += 1
            closing_a += range(a, i)
            closing_b += range(b, j)
        else:
            while x != y:
                if x < y:
                    i += 1
                    x = ea[i]
                else:
                    j += 1
                    y = eb[j]
            closing_a.append(i)
            closing_b.append(j)
            i += 1
            j += 1
    return closing_a, closing_b


class Words:
    """Ids and token ends of words, each with the white space before it, by both tokenizers.

    Words' tokens lie one after the other in pools, so that a text's arrays are
    gathered from them at once.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for text, i in vocabulary.items():
            known = all(c in _BYTE_OF for c in text)
            self.bytes_a[i] = bytes(_BYTE_OF[c] for c in text) if known else text.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [self._piece_bytes(p) for p in pieces]
        self.unit = self._unit(pieces)
        #: By 4 id + 2 side + 1 at a group's end: the id and the sign behind it.
        self.names = [f"{i}{sign}" for i in range(max(len(self.bytes_a), len(self.bytes_b))) for sign in ",|,;"]
        self._clear()

    @staticmethod
    def _unit(pieces: list[str]) -> re.Pattern:
        """The pattern of the parts of a text that both tokenizers encode each by itself.

        A part begins at white space after another character, or at
        punctuation after a part's first letters: A's pattern begins anew at
        both, and so does B wherever no piece holds the two characters.
        """
        inside = {c for p in pieces for c in p.lstrip(_PIECE_SPACE)[1:]}
        starts = "".join(c for c in "\n\t" if c not in inside) + " " * (_PIECE_SPACE not in inside)
        # Line feeds keep B's own space off a part, if they are pieces by themselves.
        if "\n" not in starts:
            return re.compile(".+", re.S)
        after = {y for p in pieces for x, y in zip(p, p[1:]) if x.isalnum()}
        marks = re.escape("".join(c for c in "!#$%&()*+,./:;<=>?@[]^_`{|}~-" if c not in after))
        others = "".join(c for c in _SPACES if c not in starts)
        word = f"[^{_SPACES}]*(?:[{others}][{_SPACES}]*[^{_SPACES}]*)*"
        letters = rf"[{starts}][{_SPACES}]*[^\W\d_]+(?=[{marks}])|" if marks else ""
        return re.compile(f"{letters}[{starts}][{_SPACES}]*{word}|[^{starts}]{word}", re.S)

    @staticmethod
    def _piece_bytes(piece: str) -> bytes:
        if found := _BYTE_PIECE.fullmatch(piece):
            return bytes([int(found[1], 16)])
        return piece.replace(_PIECE_SPACE, " ").encode()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        #: Of each word: whether both tokenizers give its bytes, how many there are, and the numbers of its ids.
        self.rows = array("i")
        self.ids, self.ends, self.starts = ((array("i"), array("i")) for _ in range(3))

    def _tokens(self, units: list[str]):
        """Each unit's ``ok, bytes, ids of A and B, ends of A and B``."""
        of_a, of_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        for k in range(0, len(units), 2000):
            some = units[k : k + 2000]
            found_a = self.a.encode_batch_fast(some, add_special_tokens=False)
            # B's own space stands for a leading space, unless nothing follows it: B gives none to an
            # empty text.  Before others a line feed keeps it off.
            own = [u[0] == " " != u for u in some]
            found_b = self.b.encode([u[1:] if k else "\n" + u for k, u in zip(own, some)], num_threads=1)
            for unit, k, a, b in zip(some, own, found_a, found_b):
                ids_a, ids_b = a.ids, b if k else b[2:]
                raw, parts_a, parts_b = unit.encode("utf-8", "replace"), list(map(of_a, ids_a)), list(map(of_b, ids_b))
                ok = b"".join(parts_a) == raw == b"".join(parts_b)
                yield ok, len(raw), (ids_a, ids_b), (accumulate(map(len, parts_a)), accumulate(map(len, parts_b)))

    def _learn(self, units: list[str]) -> None:
        known, (ids_a, ids_b), (ends_a, ends_b), (starts_a, starts_b) = self.known, self.ids, self.ends, self.starts
        for unit, (ok, size, ids, ends) in zip(units, self._tokens(units) if units else ()):
            known[unit] = len(known)
            self.rows.extend((ok, size, len(ids[0]), len(ids[1])))
            starts_a.append(len(ids_a))
            starts_b.append(len(ids_b))
            ids_a.extend(ids[0])
            ids_b.extend(ids[1])
            ends_a.extend(ends[0])
            ends_b.extend(ends[1])

    def _forget(self, units: list[str], row: int) -> None:
        """Drop the words learnt last, from a row on."""
        for unit in units:
            del self.known[unit]
        del self.rows[4 * row :]
        for k in (0, 1):
            start = self.starts[k][row]
            del self.starts[k][row:], self.ids[k][start:], self.ends[k][start:]

    def encode(self, texts: list[str | None]) -> list:
        """Each text's ``(ids, ends)`` of A and of B for space + text; None if there are none.

        Null and empty texts have none, nor have texts whose bytes one
        tokenizer doesn't give back.
        """
        out: list = [None] * len(texts)
        which = [k for k, t in enumerate(texts) if t and _PIECE_SPACE not in t]
        if not which:
            return out
        split = [self.unit.findall(" " + texts[k]) for k in which]
        distinct = set().union(*split)
        new = sorted(distinct.difference(self.known))
        if len(self.known) > KNOWN_WORDS and 4 * len(new) > len(distinct):
            # The texts have changed: what is known serves no more.
            self._clear()
            new = sorted(distinct)
        full = len(self.known) > KNOWN_WORDS
        passing = [u for u in new if full or len(u) > LONG_WORD]
        self._learn([] if full else [u for u in new if len(u) <= LONG_WORD])
        row = len(self.known)
        self._learn(passing)
        for k, found in zip(which, self._gather(split)):
            out[k] = found
        if passing:
            self._forget(passing, row)
        return out

    def _gather(self, split: list[list[str]]) -> Iterator:
        """The arrays of each list of known words."""
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), np.int64)
        rows = np.frombuffer(self.rows, np.int32).reshape(-1, 4)[at].astype(np.int64)
        counts = np.array([len(units) for units in split])
        first = np.cumsum(counts) - counts
        ok = np.minimum.reduceat(rows[:, 0], first)
        base = np.cumsum(rows[:, 1]) - rows[:, 1]
        base -= np.repeat(base[first], counts)
        sides = []
        for k in (0, 1):
            ids, ends, starts = (np.frombuffer(x[k], np.int32) for x in (self.ids, self.ends, self.starts))
            n = rows[:, 2 + k]
            before = np.cumsum(n) - n
            where = np.arange(n.sum()) + np.repeat(starts[at] - before, n)
            cuts = np.append(before[first], len(where)).tolist()
            sides.append((ids[where].astype(np.int64), ends[where] + np.repeat(base, n), cuts))
        (ids_a, ends_a, at_a), (ids_b, ends_b, at_b) = sides
        for k, good in enumerate(ok.tolist()):
            a, b = slice(at_a[k], at_a[k + 1]), slice(at_b[k], at_b[k + 1])
            yield ((ids_a[a], ends_a[a]), (ids_b[b], ends_b[b])) if good else None

    def aligned(self, both) -> tuple:
        """``n_a, n_b, n_groups, n_links, groups_sha256, pairs, times`` of an encoded text."""
        if both is None:
            return 0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int32)
        (ids_a, ends_a), (ids_b, ends_b) = both
        closing = diagonal(ends_a.tolist(), ends_b.tolist())
        # A group's ids of A stand before its ids of B, and what closes them has another sign behind it.
        names, turns = [], []
        for k, ids in enumerate((ids_a, ids_b)):
            closes = np.zeros(len(ids), np.int64)
            closes[closing[k]] = 1
            names.append(4 * ids + 2 * k + closes)
            turns.append(2 * (np.cumsum(closes) - closes) + k)
        order = np.argsort(np.concatenate(turns), kind="stable")
        text = "".join(map(self.names.__getitem__, np.concatenate(names)[order].tolist()))
        digest = hashlib.sha256(text[:-1].encode()).hexdigest()
        # Every stretch between neighbouring ends, of whichever side, lies in one token of either: a link.
        at_a, at_b = (np.zeros(ends_a[-1] + 1, np.int32) for _ in range(2))
        at_a[ends_a] = at_b[ends_b] = 1
        ends = np.flatnonzero(at_a | at_b)
        codes = ids_a[(np.cumsum(at_a) - at_a)[ends]] << 32 | ids_b[(np.cumsum(at_b) - at_b)[ends]]
        pairs, times = np.unique(codes, return_counts=True)
        return len(ids_a), len(ids_b), len(closing[0]), len(codes), digest, pairs, times.astype(np.int32)


def _stretches(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that are encoded together: about STRETCH_CHARS characters."""
    start = size = 0
    for k, t in enumerate(texts):
        size += len(t or "")
        if size >= STRETCH_CHARS:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's alignment: its counts, the digest of its groups and its linked id pairs.

    ``pairs`` holds A's id in the upper and B's in the lower 32 bits, ``times``
    how often each is linked.  ``chunk`` names about ``CHUNK_CHARS`` characters
    of neighbouring rows.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words = worker_memory(f"align-{path_a}-{path_b}", lambda: Words(path_a, path_b))
        chunk, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in _stretches(texts):
                found, chunks = [words.aligned(both) for both in words.encode(texts[a:b])], []
                for t in texts[a:b]:
                    chunks.append(chunk)
                    size += len(t or "")
                    if size >= CHUNK_CHARS:
                        chunk, size = chunk + 1, 0
                cols = list(zip(*found, strict=True))
                arrays = [pa.array(chunks, pa.int64()), batch.column(0).slice(a, b - a).cast(pa.int64())]
                arrays += [pa.array(c, pa.int64()) for c in cols[:4]] + [pa.array(cols[4], pa.string())]
                arrays += [pa.array(cols[5], pa.list_(pa.int64())), pa.array(cols[6], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(
                    arrays, names=["chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
                )

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")).mapInArrow(rows, ALIGNED)


def _scored(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """A chunk's documents with the counts of its pairs."""
    pair, n, best = (counts[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("pair", "n_docs", "best"))
    order = np.argsort(pair)
    pair, n, best = pair[order], n[order], best[order]
    lists = docs["pairs"].combine_chunks()
    at = lists.offsets.to_numpy()
    codes = lists.values.to_numpy()
    times = docs["times"].combine_chunks().values.to_numpy().astype(np.int64)
    where = np.searchsorted(pair, codes)

    def summed(values: np.ndarray) -> pa.Array:
        total = np.concatenate([[0], np.cumsum(values)])
        return pa.array(total[at[1:]] - total[at[:-1]], pa.int64())

    if len(codes):
        n_best, count_sum = summed(times * best[where]), summed(times * n[where])
    else:
        n_best = count_sum = pa.array([0] * len(docs), pa.int64())
    cols = {c: docs[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    return pa.table(cols | {"n_best": n_best, "count_sum": count_sum, "groups_sha256": docs["groups_sha256"]})


def align(
    docs: DataFrame, path_a: str | None = None, path_b: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row of ``docs``.

    ``n_best`` counts the links whose pair is among the most frequent of its A
    id; ``count_sum`` adds the counts of all links.  Null and empty texts, and
    texts whose bytes one tokenizer doesn't give back, have no tokens: zeros
    and an empty digest.  Every row is a document of its own, repeats and null
    ids too; texts are encoded whole, and other columns are ignored.
    """
    default_a, default_b = (path_a, path_b) if path_a and path_b else default_tokenizers()
    rows = written(aligned(docs, path_a or default_a, path_b or default_b, id_col, text_col), "aligned")
    by_chunk = rows.select("chunk", F.explode("pairs").alias("pair")).groupBy("chunk", "pair").agg(F.count("*").alias("n"))
    by_chunk = written(by_chunk, "chunk-pairs")
    counts = written(by_chunk.groupBy("pair").agg(F.sum("n").alias("n_docs")), "pairs")
    a_id = F.shiftright("pair", 32)
    top = counts.groupBy(a_id.alias("a")).agg(F.max("n_docs").alias("top"))
    counts = counts.withColumn("a", a_id).join(top, "a").select("pair", "n_docs", (F.col("n_docs") == F.col("top")).alias("best"))
    back = by_chunk.select("chunk", "pair").join(counts, "pair").select("chunk", "pair", "n_docs", "best")
    return rows.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(_scored, SCORED)


def alignment_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: alignment of the byte-level and the piece tokenizer on all documents."""
    return align(read(spark, sf_dir, "documents", "doc_id", "text"))
