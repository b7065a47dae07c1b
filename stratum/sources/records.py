"""CSV records cut in parallel, with an arrival rank that no split changes (S-1, S-5, P-4).

Spark reads a file's lines in splits.  A line is a record unless a quoted field
holds its line feed, and whether a line lies inside quotes depends on all
quotes before it.  Quotes are doubled inside fields, so a line with an odd
number of them opens or closes a field that spans lines: the k-th such line of
a file opens one if k is even and closes it if k is odd.

* A scan task reads a split's lines in order.  One pass over them counts a
  split's odd lines, and its records for both cases, that it begins outside
  quotes or inside.  Prefix sums over a file's splits tell which case holds;
  only the splits' counts are ordered.
* A second pass cuts each split into records while it is read.  No line is
  sorted or shuffled: of the lines of a record only those in other splits than
  its first are gathered, as one piece of text a split.
* Prefix sums of the splits' record counts, in the order of file names and
  places, give the arrival rank.  It is the same for every split size.

A split is known by its file and place.  Both come from the scan; a record
whose split is unknown stops the run rather than lose its rank.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A record with more characters is a quote that was never closed.
MAX_RECORD_CHARS = 64_000_000
SPLIT = ("file", "split")
#: Record number of a file's header.
HEADER = -1


COUNTED = "file string, split bigint, odds bigint, outside bigint, inside bigint"
CUT = "file string, split bigint, place bigint, whole bigint, record binary"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, split, odd, blank, value``: the lines, in their order inside a split."""
    text = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        (quotes % 2 == 1).alias("odd"),
        (F.trim(F.regexp_replace("value", "[\r﻿]", "")) == "").alias("blank"),
        "value",
    )


def _matched(rows: DataFrame, splits: DataFrame, *cols: str) -> DataFrame:
    """``rows`` with columns of their split; a split that the other scan didn't have stops the run.

    The splits, one row each, are sent to the rows, which keep their order.
    """
    joined = rows.join(F.broadcast(splits.select(*SPLIT, *cols)), list(SPLIT), "left")
    stop = F.raise_error(F.concat(F.lit("splits changed while being read: "), "file")).cast("bigint")
    return joined.withColumns({c: F.coalesce(F.col(c), stop) for c in cols})


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Neighbouring lines of one split, with the split they lie in."""
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch["file"].dictionary_encode()
        file, split = names.indices.to_numpy(), batch["split"].to_numpy()
        cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(split) != 0)) + 1
        for a, b in pairwise([0, *cuts.tolist(), batch.num_rows]):
            yield (names.dictionary[int(file[a])].as_py(), int(split[a])), batch.slice(a, b - a)


def _flags(lines: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``odd, blank`` of lines, and how many odd ones come before each."""
    odd, blank = (lines[c].to_numpy(zero_copy_only=False) for c in ("odd", "blank"))
    return odd, blank, np.cumsum(odd) - odd


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row a split: its odd lines, and the records that begin in it if it begins outside or inside quotes."""
    rows: dict[tuple[str, int], list[int]] = {}
    for key, lines in _stretches(batches):
        odd, blank, seen = _flags(lines)
        row = rows.setdefault(key, [0, 0, 0])
        starts = odd | ~blank
        inside = (row[0] + seen) % 2 == 1
        row[0] += int(odd.sum())
        row[1] += int((starts & ~inside).sum())
        row[2] += int((starts & inside).sum())
    cols = list(zip(*[(*key, *row) for key, row in rows.items()], strict=True)) or [()] * 5
    yield pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.string()), *[pa.array(c, pa.int64()) for c in cols[1:]]], names=["file", "split", "odds", "outside", "inside"]
    )


class _Open:
    """A split that is being cut: its record that has begun, or goes on from the split before."""

    def __init__(self, key: tuple[str, int], odds_before: int, max_chars: int):
        self.key, self.odds, self.max_chars = key, odds_before, max_chars
        self.records, self.lines, self.chars, self.first = 0, [], 0, None
        #: Whether the lines go on from the split before.
        self.continued = odds_before % 2 == 1

    def _batch(self, place, whole, records) -> pa.RecordBatch:
        n = len(place)
        arrays = [pa.array([self.key[0]] * n, pa.string()), pa.array([self.key[1]] * n, pa.int64())]
        arrays += [pa.array(place, pa.int64()), pa.array(whole, pa.int64()), pa.array(records, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["file", "split", "place", "whole", "record"])

    def cut(self, lines: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        odd, blank, seen = _flags(lines)
        seen = seen + self.odds
        inside = seen % 2 == 1
        place = self.records - 1 + np.cumsum(~inside & (odd | ~blank))
        plain = ~inside & ~odd & ~blank
        self.records, self.odds = int(place[-1]) + 1, self.odds + int(odd.sum())
        if plain.any():
            yield self._batch(place[plain], [None] * int(plain.sum()), lines["value"].filter(pa.array(plain)))
        parts = np.flatnonzero(inside | odd)
        values, sizes = lines["value"].take(pa.array(parts)).to_pylist(), lines["chars"].to_numpy()
        found, places, wholes = [], [], []
        for i, value in zip(parts.tolist(), values):
            if not inside[i]:
                self.first = int(place[i])
            self.lines.append(value)
            self.chars += int(sizes[i]) + 1
            if self.chars > self.max_chars:
                raise ValueError(f"a record has over {self.max_chars} characters, its quotes may not close: {self.key[0]}")
            if inside[i] and odd[i]:
                found.append(b"\n".join(self.lines))
                places.append(self.first)
                wholes.append(int(seen[i]) // 2 if self.continued else None)
                self.lines, self.chars, self.first, self.continued = [], 0, None, False
        if found:
            yield self._batch(places, wholes, found)

    def rest(self) -> Iterator[pa.RecordBatch]:
        """What goes on in the next split."""
        if self.lines:
            yield self._batch([self.first], [self.odds // 2], [b"\n".join(self.lines)])


def _cut(spark: SparkSession, path: str | list[str], splits: DataFrame, max_chars: int) -> DataFrame:
    """``file, split, place, record``: records with the split and the place there of their first line."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Open | None = None
        for key, lines in _stretches(batches):
            if now is None or now.key != key:
                if now:
                    yield from now.rest()
                now = _Open(key, lines["odds_before"][0].as_py(), max_chars)
            yield from now.cut(lines)
        if now:
            yield from now.rest()

    def cut(lines: DataFrame) -> DataFrame:
        # Bytes, as they stand in the file.
        value = F.col("value").cast("binary").alias("value")
        lines = lines.select(*SPLIT, "odds_before", "odd", "blank", F.length("value").alias("chars"), value)
        return lines.mapInArrow(rows, CUT).withColumn("record", F.col("record").cast("string"))

    lines = _matched(_lines(spark, path), splits, "odds_before", "odds_after")
    # Only splits that begin or end inside quotes have pieces.
    pieces = cut(lines.filter("odds_before % 2 = 1 OR odds_after % 2 = 1")).filter("whole IS NOT NULL")
    # The size is known before anything is collected.
    long = F.raise_error(F.concat(F.lit(f"a record has over {max_chars} characters, its quotes may not close: "), "file")).cast("string")
    sizes = pieces.groupBy("file", "whole").agg(F.sum(F.length("record") + 1).alias("chars"))
    pieces = pieces.join(sizes, ["file", "whole"]).withColumn("record", F.when(F.col("chars") > max_chars, long).otherwise(F.col("record")))
    pieces = pieces.groupBy("file", "whole").agg(F.sort_array(F.collect_list(F.struct("split", "place", "record"))).alias("p"))
    first = F.col("p")[0]
    pieces = pieces.select("file", first["split"].alias("split"), first["place"].alias("place"), F.array_join("p.record", "\n").alias("record"))
    return cut(lines).filter("whole IS NULL").select(*SPLIT, "place", "record").unionByName(pieces)


def _splits(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, split, odds_before, odds_after, n``: odd lines of the file up to a split and through it, and the records that begin in it."""
    counted = _lines(spark, path).select(*SPLIT, "odd", "blank").mapInArrow(_counted, COUNTED)
    in_file = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("odds").over(in_file), F.lit(0))
    n = F.when(F.col("odds_before") % 2 == 1, F.col("inside")).otherwise(F.col("outside"))
    counted = counted.withColumn("odds_before", before)
    return counted.select(*SPLIT, "odds_before", (F.col("odds_before") + F.col("odds")).alias("odds_after"), n.alias("n"))


def csv_records(spark: SparkSession, path: str | list[str], max_chars: int = MAX_RECORD_CHARS) -> DataFrame:
    """``file, record_no, source_rank, record`` of every record of UTF-8 CSV files, each with a header.

    ``record`` is the record's text.  ``record_no`` counts a file's records
    from 0, the header being -1; ``source_rank`` counts those of all files, in
    the order of their names, and is null for headers.  Blank lines outside
    quotes are no records.  Line feeds end lines; a carriage return before one
    is dropped at the end of a record.  An empty file has no rows.
    """
    splits = _splits(spark, path)
    in_file = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("in_file", F.coalesce(F.sum("n").over(in_file), F.lit(0)))
    # One row a file is ordered at last: its header is no record of the rank.
    files = splits.groupBy("file").agg((F.greatest(F.sum("n"), F.lit(1)) - 1).alias("rows"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("in_files"))
    splits = splits.join(files, "file")
    records = _matched(_cut(spark, path, splits, max_chars), splits, "in_file", "in_files")
    number = F.col("in_file") + F.col("place") - 1
    text = F.regexp_replace("record", "(^﻿)|(\r$)", "")
    rank: Column = F.when(number >= 0, F.col("in_files") + number)
    return records.select("file", number.alias("record_no"), rank.alias("source_rank"), text.alias("record"))


def csv_record_count(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row, ``n``: the records of CSV files, headers excluded."""
    splits = _splits(spark, path)
    files = splits.groupBy("file").agg((F.greatest(F.sum("n"), F.lit(1)) - 1).alias("n"))
    return files.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n"))
