"""Exact Jaccard join of documents by T-occurrence search.

Documents of n and m shingles reach a similarity of s only if they share
s (n + m) / (1 + s) shingles.  So a document looks for those that stand in T
of its shingles' inverted lists.  DivideSkip sets its longest lists apart, as
many as may be missed, merges the short ones through a heap that skips over
documents which can no longer reach the rest, and probes the long lists for
what is left by binary search.  Links are thus confirmed by full sets.

Spark deals out what can be linked at all:

* Equal sets are one class, found by a pre-combined aggregate.
* A linked document shares all but n - T + 1 of its shingles, whichever those
  are.  A document with that many shingles that no other class holds is linked
  with none.  Most documents go so after a look at the quarter of shingles with
  the least hashes; those left are counted in full.  Each count is one
  aggregate of shingles, so a shingle that a third of the documents hold is a
  row a task.
* The others are sorted by their shingles' frequency; two that are linked
  share one of the first n - T + 1.  Lists of these tie documents into groups,
  and groups are dealt into cells of bounded size.
* A group of one cell is searched at once.  A larger group is first dealt at
  random, twice: in a cell of near copies nearly all are linked, which makes
  them one component, and only pairs between different components matter from
  then on.  Documents whose lists then hold several components meet in every
  pair of cells whose sizes allow a link, so no link is lost.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import read, written
from stratum.llm.graph import components
from stratum.llm.minhash import _mix64

#: Documents and shingles of a cell, about.
CELL_DOCS, CELL_SHINGLES = 256, 400_000
#: The share of shingles, those of least hashes, that the first look takes.
FIRST_LOOK = 0.25
#: Bits of the filter that keeps most texts from being shuffled; more live documents than bits make it useless, never wrong.
FILTER_BITS = 1 << 24
#: DivideSkip's weight: how many long lists are set apart.
WEIGHT = 0.0085
DEAL_ROUNDS = 2
#: Bytes of texts that are cut into words at once, about, and of the longest word that is not hashed by itself.
CHUNK_BYTES, LONG_WORD = 1 << 17, 64

STEP = np.uint64(0x9E3779B97F4A7C15)
SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
#: What is kept of eight bytes of which so many belong to a word.
KEPT = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def required(n: int | np.ndarray, percent: int):
    """The least overlap of a set of n with any set that is linked with it."""
    return -(-percent * n // 100)


def _word_hashes(low: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words of lower-cased bytes, eight bytes at a time; ``low`` ends in eight more."""
    eights = np.lib.stride_tricks.sliding_window_view(low, 8)
    out = sizes.astype(np.uint64)
    for k in np.flatnonzero(sizes > LONG_WORD).tolist():
        word = low[starts[k] : starts[k] + sizes[k]].tobytes()
        out[k] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    at = np.flatnonzero(sizes <= LONG_WORD)
    starts, sizes = starts[at], sizes[at]
    while len(at):
        part = eights[starts].view("<u8")[:, 0] & KEPT[np.minimum(sizes, 8)]
        out[at] = _mix64(out[at] * STEP + part)
        more = sizes > 8
        at, starts, sizes = at[more], starts[more] + 8, sizes[more] - 8
    return out


def _chained(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` words that follow each other."""
    count = len(hashes) - width + 1
    out = np.full(count, width, np.uint64)
    for j in range(width):
        out = _mix64(out * STEP + hashes[j : j + count])
    return out


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's word shingles.

    A-Z are lower-cased and words are what ASCII white space separates.  Fewer
    words than ``width`` are one shingle; no words, or no text, are none.
    """
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, bounds, data = texts.buffers()
    if not len(texts):
        return
    bounds = np.frombuffer(bounds, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + CHUNK_BYTES, side="right")) - 1)
        yield from _chunk_sets(data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first], width)
        first = last


def _chunk_sets(data: np.ndarray, bounds: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The sets of texts that lie side by side in ``data``."""
    word = ~SPACE[data]
    # A word begins where none was before, and where its text does; it ends likewise.
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    after = np.concatenate([[False], word])
    before = np.concatenate([word, [False]])
    starts = np.flatnonzero(before & (~after | cut))
    ends = np.flatnonzero(after & (~before | cut))
    hashes = _word_hashes(np.concatenate([LOWER[data], np.zeros(8, np.uint8)]), starts, ends - starts)
    whole = _chained(hashes, width) if len(hashes) >= width else None
    at = np.searchsorted(starts, bounds).tolist()
    for a, b in zip(at[:-1], at[1:], strict=True):
        own = whole[a : b - width + 1] if b - a >= width else _chained(hashes[a:b], b - a) if b > a else hashes[:0]
        own = np.sort(own)
        yield own[np.append(True, own[1:] != own[:-1])] if len(own) else own


def _lists(sets: list[np.ndarray]) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
    flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int64()))


def sketch(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n, same, first``: each set's size, fingerprint and shingles of least hashes."""
    bound = np.uint64(int(FIRST_LOOK * 2**64))

    def rows(batches):
        for batch in batches:
            n, same, first = [], [], []
            for s in shingle_sets(batch.column(1), width):
                n.append(len(s))
                same.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                first.append(s[: np.searchsorted(s, bound)].copy())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(same, pa.binary()), _lists(first)],
                names=["doc_id", "n", "same", "first"],
            )

    return docs.mapInArrow(rows, "doc_id bigint, n bigint, same binary, first array<bigint>")


def _spare(n: Column, percent: int) -> Column:
    """How many shingles a linked document may lack, and one."""
    return n - F.ceil(n * percent / 100) + 1


def _alone(postings: DataFrame, key: str) -> DataFrame:
    """``key, alone``: how many shingles only this ``key`` holds."""
    held = postings.groupBy("shingle").agg(F.min(key).alias("least"), F.max(key).alias("most"))
    return held.filter("least = most").groupBy(F.col("least").alias(key)).agg(F.count("*").alias("alone"))


def _bits(ids: DataFrame) -> np.ndarray:
    """A filter of fixed size: the bits of the ids' hashes."""
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    words = ids.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc_id), {FILTER_BITS}) % 64 AS int))")).alias("bits"))
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    for row in words.collect():
        out[row.word] = np.int64(row.bits).view(np.uint64)
    return out


def _full_sets(docs: DataFrame, live: DataFrame, width: int) -> DataFrame:
    """``doc_id, n, shingles`` of the live classes' least documents."""
    filter_bits = _bits(live)

    def rows(batches):
        for batch in batches:
            at = batch.column(2).to_numpy()
            passed = (filter_bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            batch = batch.filter(pa.array(passed))
            sets = list(shingle_sets(batch.column(1), width))
            same = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(same, pa.binary()), _lists(sets)],
                names=["doc_id", "same", "shingles"],
            )

    hashed = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)).alias("bit")).filter("doc_id IS NOT NULL")
    sets = hashed.mapInArrow(rows, "doc_id bigint, same binary, shingles array<bigint>")
    return sets.join(live.select("doc_id", "same", "n"), ["doc_id", "same"]).dropDuplicates(["doc_id", "same"]).select("doc_id", "n", "shingles")


def divide_skip(lists: list[list[int]], need: int, wanted: Callable[[int], bool] = lambda _: True) -> Iterator[tuple[int, int]]:
    """``(element, times)`` of the wanted elements that stand in ``need`` or more of the sorted lists."""
    lists = sorted(filter(None, lists), key=len)
    if len(lists) < need:
        return
    apart = min(need - 1, int(need / (WEIGHT * math.log2(len(lists[-1]) + 1) + 1)))
    short, long = lists[: len(lists) - apart], lists[len(lists) - apart :]
    for element, times in _merge_skip(short, need - apart):
        if not wanted(element):
            continue
        left = len(long)
        for x in long:
            if times + left < need:
                break
            at = bisect_left(x, element)
            times += at < len(x) and x[at] == element
            left -= 1
        if times >= need:
            yield element, times


def _merge_skip(lists: list[list[int]], least: int) -> Iterator[tuple[int, int]]:
    """``(element, times)`` of the elements that stand in ``least`` or more of the sorted lists, by a heap of their heads."""
    heap = [(x[0], k, 0) for k, x in enumerate(lists)]
    heapq.heapify(heap)
    while heap:
        top, popped = heap[0][0], []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap))
        goal = top + 1
        if len(popped) >= least:
            yield top, len(popped)
        else:
            # What stands in enough lists is no less than the head of the least-th list: skip to it.
            while heap and len(popped) < least - 1:
                popped.append(heapq.heappop(heap))
            if not heap:
                return
            goal = heap[0][0]
        for _, k, at in popped:
            at = bisect_left(lists[k], goal, at)
            if at < len(lists[k]):
                heapq.heappush(heap, (lists[k][at], k, at))


def cell_links(ids: np.ndarray, n: np.ndarray, joined: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links inside a cell between documents of different components ``joined``."""
    order = np.lexsort((ids, n))
    ids, n, joined = ids[order], n[order], joined[order]
    sets = [sets[k] for k in order]
    count = len(ids)
    doc = np.repeat(np.arange(count), [len(s) for s in sets])
    flat = np.concatenate(sets)
    by = np.lexsort((doc, flat))
    flat, doc = flat[by], doc[by]
    starts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    ends = np.append(starts[1:], len(flat))
    end_of = np.repeat(ends, ends - starts)
    # Each document's places in the lists; what follows a place there is larger, or as large.
    place = np.argsort(doc, kind="stable")
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    last = np.searchsorted(n, n * 100 // percent, side="right")
    _, root = np.unique(joined, return_inverse=True)
    found = []
    all_docs = doc.tolist()
    for i in range(count - 1):
        if last[i] <= i + 1 or (root[i + 1 : last[i]] == root[i]).all():
            continue
        mine = place[bounds[i] : bounds[i + 1]]
        mine = mine[end_of[mine] > mine + 1]
        need = -(-2 * percent * int(n[i]) // (100 + percent))
        if len(mine) < need:
            continue
        lists = [all_docs[a + 1 : b] for a, b in zip(mine.tolist(), end_of[mine].tolist(), strict=True)]
        size, end = int(n[i]), int(last[i])
        for j, shared in divide_skip(lists, need, lambda j: j < end and root[j] != root[i]):
            if root[j] != root[i] and 100 * shared >= percent * (size + int(n[j]) - shared):
                root[root == root[j]] = root[i]
                found.append((int(ids[i]), int(ids[j])))
    return found


def _linked(dealt: DataFrame, cell: list[str], percent: int) -> DataFrame:
    """``u, v`` of the links inside each cell."""

    def compare(table: pa.Table) -> pa.Table:
        lists = table["shingles"].combine_chunks()
        at, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        sets = [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        found = []
        if len(sets) > 1:
            found = cell_links(*(table[c].to_numpy() for c in ("doc_id", "n", "joined")), sets, percent)
        return pa.table({"u": pa.array([u for u, _ in found], pa.int64()), "v": pa.array([v for _, v in found], pa.int64())})

    return dealt.select(*cell, "doc_id", "n", "joined", "shingles").groupBy(*cell).applyInArrow(compare, "u bigint, v bigint")


def _groups(ties: DataFrame) -> DataFrame:
    """``doc_id, grp``: components of documents that stand in one list; ``ties`` has ``shingle, doc_id``."""
    leaders = ties.groupBy("shingle").agg(F.min("doc_id").alias("leader"), F.max("doc_id").alias("most")).filter("leader < most")
    tied = ties.join(leaders, "shingle").filter("doc_id != leader").select(F.col("doc_id").alias("u"), F.col("leader").alias("v"))
    return components(tied).withColumnsRenamed({"id": "doc_id", "component": "grp"})


def _with_components(docs: DataFrame, links: DataFrame) -> DataFrame:
    """``docs`` with ``joined``, the component that the links so far make."""
    named = components(links).withColumnsRenamed({"id": "doc_id", "component": "joined"})
    return docs.join(named, "doc_id", "left").withColumn("joined", F.coalesce("joined", "doc_id"))


def _links(sets: DataFrame, ties: DataFrame, percent: int) -> DataFrame:
    """``u, v``: links that span the components; ``sets`` has ``doc_id, n, shingles``, ``ties`` the lists' ``shingle, doc_id``."""
    placed = written(_groups(ties), "groups")
    sizes = placed.join(sets.select("doc_id", F.size("shingles").alias("size")), "doc_id").groupBy("grp").agg(
        F.greatest(F.ceil(F.count("*") / CELL_DOCS), F.ceil(F.sum("size") / CELL_SHINGLES)).cast("int").alias("cells")
    )
    placed = written(placed.join(sizes, "grp"), "cells")
    whole = sets.join(placed.filter("cells = 1"), "doc_id").withColumn("joined", F.col("doc_id"))
    links = written(_linked(whole, ["grp"], percent), "links")
    large = placed.filter("cells > 1")
    if large.isEmpty():
        return links
    large = written(sets.join(large, "doc_id"), "large")
    own = None
    for deal in range(DEAL_ROUNDS):
        cell = F.pmod(F.xxhash64("doc_id", F.lit(deal)), F.col("cells").cast("bigint"))
        so_far = _with_components(large, own) if own else large.withColumn("joined", F.col("doc_id"))
        new = _linked(so_far.withColumn("cell", cell), ["grp", "cell"], percent)
        own = written(own.unionAll(new) if own else new, "links")
    # What is left: documents in lists that hold several components.
    at = written(_with_components(large.select("doc_id", "n"), own), "joined")
    held = ties.join(at.select("doc_id", "joined"), "doc_id")
    mixed = held.groupBy("shingle").agg(F.min("joined").alias("least"), F.max("joined").alias("most")).filter("least < most")
    left = written(held.join(mixed.select("shingle"), "shingle").select("shingle", "doc_id"), "mixed")
    if not left.isEmpty():
        own = own.unionAll(_between(large.drop("grp", "cells"), at.drop("n"), left, percent))
    return links.unionAll(own)


def _between(sets: DataFrame, joined: DataFrame, ties: DataFrame, percent: int) -> DataFrame:
    """Links between different components, from every pair of cells of a group whose sizes allow one."""
    placed = written(_groups(ties).join(joined, "doc_id").join(sets.select("doc_id", "n", F.size("shingles").alias("size")), "doc_id"), "left")
    # Sizes of linked documents lie in one band or in neighbouring ones.
    band = F.floor(F.log("n") / math.log(100.01 / percent)).cast("int")
    placed = placed.withColumn("band", band)
    sizes = placed.groupBy("grp", "band").agg(
        F.greatest(F.ceil(F.count("*") / CELL_DOCS), F.ceil(F.sum("size") / CELL_SHINGLES)).cast("int").alias("cells")
    )
    sizes = written(sizes, "band-sizes")
    above = sizes.select("grp", (F.col("band") - 1).alias("band"), F.col("cells").alias("above"))
    below = sizes.select("grp", (F.col("band") + 1).alias("band"), F.col("cells").alias("below"))
    placed = placed.join(sizes.join(above, ["grp", "band"], "left").join(below, ["grp", "band"], "left"), ["grp", "band"])
    placed = placed.withColumn("cell", F.pmod(F.xxhash64("doc_id", F.lit(-1)), F.col("cells").cast("bigint")).cast("int"))
    empty = F.array().cast("array<struct<lo:int,lo_cell:int,hi:int,hi_cell:int>>")

    def cells(n: Column, make) -> Column:
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), make)).otherwise(empty)

    def pair(lo, lo_cell, hi, hi_cell) -> Column:
        parts = zip((lo, lo_cell, hi, hi_cell), ("lo", "lo_cell", "hi", "hi_cell"), strict=True)
        return F.struct(*[x.cast("int").alias(name) for x, name in parts])

    b, c = F.col("band"), F.col("cell")
    meets = F.concat(
        cells(F.col("cells"), lambda k: pair(b, F.least(c, k.cast("int")), b, F.greatest(c, k.cast("int")))),
        cells(F.coalesce("above", F.lit(0)), lambda k: pair(b, c, b + 1, k)),
        cells(F.coalesce("below", F.lit(0)), lambda k: pair(b - 1, k, b, c)),
    )
    dealt = placed.select("doc_id", "joined", "grp", F.explode(meets).alias("meets")).select("doc_id", "joined", "grp", "meets.*")
    return _linked(sets.join(dealt, "doc_id"), ["grp", "lo", "lo_cell", "hi", "hi_cell"], percent)


def overlap_join(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``, without loss.

    Documents whose shingle sets have a similarity of ``percent`` or more are
    linked; a component is named by its least id.  Null and empty texts hold
    no shingles and are linked with nothing.  Every row is judged by its own
    text, repeats of a row alike; a row without an id has no component.  Texts
    are taken whole, and other columns of ``docs`` are ignored.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = written(sketch(docs, width), "sketches")
    real = rows.filter("n > 0 AND doc_id IS NOT NULL")
    mark = F.conv(F.substring(F.hex("same"), 1, 15), 16, 10).cast("bigint")
    classes = written(
        real.groupBy("same").agg(F.min("doc_id").alias("doc_id"), F.min("n").alias("n")).withColumn("mark", mark), "classes"
    )
    first = real.select(mark.alias("mark"), F.explode("first").alias("shingle"))
    alone = _alone(first, "mark")
    live = classes.join(alone, "mark", "left").filter(F.coalesce("alone", F.lit(0)) < _spare(F.col("n"), percent))
    live = written(live.select("doc_id", "same", "n"), "live")

    sets = written(_full_sets(docs, live, width), "sets")
    postings = sets.select("doc_id", F.explode("shingles").alias("shingle"))
    alone = written(_alone(postings, "doc_id"), "alone")
    spare = _spare(F.col("n"), percent)
    sets = sets.join(alone, "doc_id", "left").withColumn("alone", F.coalesce("alone", F.lit(0)))
    sets = written(sets.filter(F.col("alone") < spare), "sets")
    postings = sets.select("doc_id", F.explode("shingles").alias("shingle"))
    times = postings.groupBy("shingle").agg(F.count("*").alias("times")).filter("times > 1")
    sorted_sets = (
        postings.join(times, "shingle")
        .groupBy("doc_id")
        .agg(F.sort_array(F.collect_list(F.struct("times", "shingle"))).alias("s"))
        .select("doc_id", F.col("s.shingle").alias("sorted"))
    )
    # Shingles that no other document left holds come first: they are part of what may be lacking.
    looks = spare - (F.size("shingles") - F.size("sorted"))
    sets = sets.join(sorted_sets, "doc_id").select("doc_id", "n", F.col("sorted").alias("shingles"), looks.cast("int").alias("looks"))
    sets = written(sets.filter("looks > 0"), "sets")
    ties = sets.select("doc_id", F.explode(F.slice("shingles", F.lit(1), F.col("looks"))).alias("shingle"))
    named = components(_links(sets.drop("looks"), written(ties, "ties"), percent))
    named = named.withColumnsRenamed({"id": "least", "component": "named"})
    named = classes.join(named, F.col("doc_id") == F.col("least"), "left")
    named = written(named.select("same", F.coalesce("named", "doc_id").alias("component")), "named")
    out = rows.select("doc_id", "n", "same").join(named, "same", "left")
    component = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("component")), F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def overlap_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: components of documents that share 85 % of their 4-word shingles."""
    return overlap_join(read(spark, sf_dir, "documents", "doc_id", "text"), width=4, percent=85)


def overlap_join_sql() -> str:
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
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (
  SELECT doc_id AS id, doc_id AS node FROM documents
  UNION SELECT id, v FROM reach JOIN both_ways ON u = node),
named AS (SELECT id, min(node) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d JOIN named ON id = d.doc_id LEFT JOIN sizes USING (doc_id)"""
