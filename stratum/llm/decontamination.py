"""Benchmark decontamination by canonical templates.

Numbers, names and units become typed placeholders, so a question that was
asked again with other values keeps its template.  Template windows of
documents are hash-joined with those of the benchmark; pairs with enough
windows are aligned, and the values in their slots must correspond: one value
of the question always to the same value of the document.  That is judged for
each place of the document where the question may stand, so that a document
may hold it several times with other values; equal values need no judgement.

Template windows with few literal words would match anything, so they are not
joined.  Items that have such windows, or just one window, are searched by
their plain words with all values besides: windows of these are exact, so they
need no literals and no judgement, and a first word is the same word whether
or not it was read as a name.

Only SQL expressions are used.  Documents are scanned for window hashes, of
plain words only if an item needs them, and again for the slots of the few
that matched.  The benchmark's windows
are joined without a hint; the planner sends them to all executors if their
size allows that, and shuffles both sides otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.llm.common import read, written

#: Words of a window, and how many of them must not be placeholders.
WINDOW, LITERALS = 8, 5
#: A pair counts with so many windows of an item: 13 consecutive words, or half of a shorter item.
ENOUGH = 6
#: Share of an item's matched slots whose value always goes with the same value.
CONSISTENT = 0.8

UNITS = (
    "kilometers|kilometres|kilometer|kilometre|kilograms|kilogram|centimeters|centimeter|meters|metres|meter|metre"
    "|grams|gram|liters|litres|liter|litre|miles|mile|feet|foot|inches|inch|yards|yard|pounds|pound|ounces|ounce"
    "|hours|hour|minutes|minute|seconds|second|days|day|weeks|week|months|month|years|year|dollars|dollar|euros|euro"
    "|cents|cent|percent|degrees|degree|kmh|mph|km|cm|mm|kg|mg|ml|lb|oz|ft|m|g|l|s|h"
)
#: Mid-sentence capitalised words: after a letter, digit or comma and one space.
#: Groups are repeated by ``*+``, in a loop; ``*`` takes a stack frame a repeat, and a long run of words ended the JVM.
_NAME = r"(?<=[\p{L}\p{N},;] )\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*+"
_NUMBER = r"(?<![\p{L}\p{N}])[$€£]?\p{N}+(?:[.,:]\p{N}+)*+"


def _canonical(text: Column) -> Column:
    """Lower-case words; a placeholder keeps its value behind a colon: ``‹num:12›``."""
    named = F.regexp_replace(text, f"{_NAME}|{_NUMBER}", "‹$0›")
    united = F.regexp_replace(named, rf"(?<=\p{{N}}›) ?({UNITS})\b", " ‹~$1›")
    # Spaces inside a name would split it.
    return F.split(F.lower(F.regexp_replace(united, r"(?<=‹)([^›]*) (?=[^‹]*›)", "$1_")), r"[^\p{L}\p{N}_‹›~.,:$€£]+|[.,:]+(?![\p{N}])")


def _words(text: str) -> Column:
    return F.filter(_canonical(F.coalesce(F.col(text), F.lit(""))), lambda w: w != "")


def _template(word: Column) -> Column:
    """A word without its value."""
    return (
        F.when(~word.startswith("‹"), word)
        .when(word.startswith("‹~"), F.lit("‹unit›"))
        .when(word.rlike(r"^‹[$€£]?\p{N}"), F.lit("‹num›"))
        .otherwise(F.lit("‹name›"))
    )


def _hashes(marks: Column, width: int | Column) -> Column:
    """The hash of every window of ``marks``; null if there are fewer than ``width``.

    Spark hashes an array as its elements one after the other, so a width that
    is a column gives the same hashes as a number.
    """
    if isinstance(width, int):
        hashed = lambda i: F.xxhash64(F.lit(width), *[F.get(marks, i + j) for j in range(width)])
    else:
        hashed = lambda i: F.xxhash64(width, F.slice(marks, i + 1, width))
    at = F.sequence(F.lit(0), F.greatest(F.size(marks) - width, F.lit(0)))
    return F.when(F.size(marks) >= width, F.transform(at, hashed))


def _windowed(df: DataFrame, text: str, width: int | Column, slots: bool = False) -> DataFrame:
    """Replace ``text`` by ``windows``, an array with the hash of every template window.

    With ``slots``, each is a struct ``hash, pos, slots``: the window's first
    word, and its placeholders in order, as structs ``offset, value``.
    """
    df = df.withColumn("words", _words(text)).drop(text)
    df = df.withColumn("marks", F.transform("words", lambda w: F.xxhash64(_template(w))))
    windows = _hashes(F.col("marks"), width)
    if slots:
        placed = lambda w, j: F.struct(j.alias("offset"), w.alias("value"))
        slice_at = lambda i: F.slice("words", i + 1, width)
        valued = lambda i: F.filter(F.transform(slice_at(i), placed), lambda x: x["value"].startswith("‹"))
        windows = F.transform(windows, lambda h, i: F.struct(h.alias("hash"), i.alias("pos"), valued(i).alias("slots")))
    return df.withColumn("windows", windows).drop("marks", "words")


def benchmark_windows(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """``item_id, n_windows, n_places, n_words, at, width, hash, slots`` of every window of the benchmark.

    A text of fewer words than a window is one window of its own width; windows
    with fewer than ``LITERALS`` words that are no placeholders (or than their
    width, if that is less) are too common to count.
    """
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.filter("item_id IS NOT NULL AND text IS NOT NULL")
    sized = items.withColumn("n_words", F.size(_words("text"))).withColumn("width", F.least("n_words", F.lit(width)))
    parts = _windowed(sized.filter("width > 0"), "text", F.col("width"), slots=True)
    parts = parts.select("item_id", "width", "n_words", F.explode("windows").alias("x"))
    parts = parts.select("item_id", "width", "n_words", F.col("x.pos").alias("at"), "x.hash", "x.slots")
    out = parts.filter(F.col("width") - F.size("slots") >= F.least(F.lit(LITERALS), F.col("width")))
    at = F.flatten(F.collect_list(F.transform("slots", lambda x: x["offset"] + F.col("at"))))
    n = out.groupBy("item_id").agg(F.count_distinct("at").cast("int").alias("n_windows"), F.size(F.array_distinct(at)).alias("n_places"))
    return out.join(n, "item_id")


def _plain(text: str) -> Column:
    """Lower-case words with their values."""
    return F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _plain_windows(df: DataFrame, text: str, width: int | Column) -> DataFrame:
    """Replace ``text`` by ``windows``, an array with the hash of every window of plain words."""
    df = df.withColumn("marks", F.transform(_plain(text), lambda w: F.xxhash64(w))).drop(text)
    return df.withColumn("windows", _hashes(F.col("marks"), width)).drop("marks")


def plain_windows(benchmark: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """``item_id, width, at, hash, n_windows, n_values`` of the items that template windows don't cover.

    Those are the items with a window of too few literals, and those of one
    window; ``items`` are the template windows.
    """
    texts = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    texts = texts.filter("item_id IS NOT NULL AND text IS NOT NULL").withColumn("n_words", F.size(_words("text")))
    kept = items.groupBy("item_id").agg(F.max("n_windows").alias("kept"))
    most = F.greatest(F.col("n_words") - width + 1, F.lit(1))
    bare = (F.coalesce("kept", F.lit(0)) < most) | (F.col("n_words") <= width)
    texts = texts.join(kept, "item_id", "left").filter(bare)
    n_values = F.size(F.array_distinct(F.filter(_words("text"), lambda w: w.startswith("‹")))).cast("bigint")
    sized = texts.select("item_id", "text", n_values.alias("n_values"), F.least(F.size(_plain("text")), F.lit(width)).alias("width"))
    at = _plain_windows(sized.filter("width > 0"), "text", F.col("width"))
    parts = at.select("item_id", "width", "n_values", F.posexplode("windows").alias("at", "hash"))
    n = parts.groupBy("item_id").agg(F.count_distinct("at").cast("int").alias("n_windows"))
    return parts.join(n, "item_id")


def _verbatim(docs: DataFrame, items: DataFrame, needed: Column) -> DataFrame | None:
    """Pairs, in the columns of ``LEAKS``, that share enough windows of plain words; None if no item asks for them."""
    widths = sorted(r[0] for r in items.select("width").distinct().collect())
    found = None
    for w in widths:
        seen = _plain_windows(docs, "text", w).select("doc_id", F.explode(F.array_distinct("windows")).alias("hash"))
        hits = seen.join(items.filter(F.col("width") == w).drop("width"), "hash")
        found = hits if found is None else found.unionAll(hits)
    if found is None:
        return None
    pairs = found.groupBy("doc_id", "item_id").agg(
        F.count_distinct("at").alias("windows"), F.max("n_windows").alias("n_windows"), F.max("n_values").alias("slots")
    )
    pairs = pairs.filter(F.col("windows") >= needed)
    return pairs.select(
        "doc_id", "item_id", "windows", F.col("n_windows").alias("item_windows"), "slots",
        F.lit(0).cast("bigint").alias("changed_slots"), F.lit("exact").alias("kind"),
    )


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pairs of a document and a benchmark item that it holds.

    Returns ``doc_id, item_id, windows, item_windows, slots, changed_slots,
    kind``, where ``kind`` is ``exact`` or ``reparameterised``.  Null and empty
    texts hold nothing and are held by nothing; rows with a null id cannot be
    named and are left out; rows that repeat an id count as one document;
    further columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL")
    items = written(benchmark_windows(benchmark), "benchmark")
    needed = F.least(F.lit(ENOUGH), F.ceil(F.col("n_windows") / 2))
    canonical = _by_template(docs, items, needed)
    verbatim = _verbatim(docs, written(plain_windows(benchmark, items), "plain"), needed)
    found = [x for x in (canonical, verbatim) if x is not None]
    if not found:
        return docs.sparkSession.createDataFrame([], LEAKS)
    if len(found) == 1:
        return found[0]
    best = F.max_by(F.struct("windows", "item_windows", "slots", "changed_slots", "kind"), F.struct(F.col("kind") == "exact", "windows"))
    return found[0].unionByName(found[1]).groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")


def _by_template(docs: DataFrame, items: DataFrame, needed: Column) -> DataFrame | None:
    """Pairs, in the columns of ``LEAKS``, whose template windows match and whose values correspond."""
    # The distinct widths of the benchmark's windows: WINDOW of them at most.
    widths = sorted(r[0] for r in items.select("width").distinct().collect())
    found = None
    for w in widths:
        seen = _windowed(docs, "text", w).select("doc_id", F.explode(F.array_distinct("windows")).alias("hash"))
        hits = seen.join(items.filter(F.col("width") == w).select("hash", "item_id", "at", "n_windows"), "hash")
        found = hits if found is None else found.unionAll(hits)
    if found is None:
        return None
    pairs = found.groupBy("doc_id", "item_id").agg(
        F.count_distinct("at").alias("windows"), F.max("n_windows").alias("n_windows")
    )
    pairs = written(pairs.filter(F.col("windows") >= needed), "pairs")

    again = docs.join(pairs.select("doc_id").distinct(), "doc_id").withColumn("copy", F.xxhash64("text"))
    hits = None
    for w in widths:
        asked = items.filter(F.col("width") == w).select("hash", "item_id", "at", "n_windows", "n_places", "n_words", F.col("slots").alias("asked"))
        # Not outer, the planner would test the windows' size below the join, once more computing them for all documents.
        said = _windowed(again, "text", w, slots=True).select("doc_id", "copy", F.explode_outer("windows").alias("x"))
        said = said.select("doc_id", "copy", "x.hash", "x.pos", F.col("x.slots").alias("said"))
        part = said.join(asked, "hash").drop("hash")
        hits = part if hits is None else hits.unionAll(part)
    hits = hits.join(pairs.select("doc_id", "item_id"), ["doc_id", "item_id"], "left_semi")
    hits = written(hits.dropDuplicates(["doc_id", "copy", "item_id", "pos", "at"]), "hits")
    best = F.max_by(F.struct("slots", "changed"), F.struct(F.col("changed") == 0, "slots"))
    judged = _as_a_whole(pairs, hits).unionAll(_by_place(hits, needed)).unionAll(_equal(hits, needed))
    judged = judged.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")
    kind = F.when(F.col("changed") == 0, F.lit("exact")).otherwise(F.lit("reparameterised"))
    return pairs.join(judged, ["doc_id", "item_id"]).select(
        "doc_id", "item_id", "windows", F.col("n_windows").alias("item_windows"), "slots", F.col("changed").alias("changed_slots"), kind.alias("kind")
    )


def _slot_values(hits: DataFrame, *by: str) -> DataFrame:
    """Of every value asked for: with how many values it goes, and in how many places of the item it stands."""
    slots = hits.select(*by, "at", F.explode(F.arrays_zip("asked", "said")).alias("p"))
    slots = slots.select(
        *by, (F.col("at") + F.col("p.asked.offset")).alias("place"), F.col("p.asked.value").alias("asked"), F.col("p.said.value").alias("said")
    )
    return slots.groupBy(*by, "asked").agg(
        F.count_distinct("said").alias("n"), F.count_distinct("place").alias("places"), F.min("said").alias("said")
    )


def _slots() -> tuple[Column, Column]:
    """Distinct values asked for, and those that the document changes."""
    changed = F.count_if((F.col("n") > 1) | (F.col("said") != F.col("asked")))
    return F.count("asked").alias("slots"), changed.alias("changed")


def _as_a_whole(pairs: DataFrame, hits: DataFrame) -> DataFrame:
    """Pairs whose values correspond over the whole document."""
    judged = _slot_values(hits, "doc_id", "item_id").groupBy("doc_id", "item_id")
    judged = judged.agg(*_slots(), F.count_if(F.col("n") == 1).alias("steady"))
    out = pairs.select("doc_id", "item_id").join(judged, ["doc_id", "item_id"], "left").fillna(0, ["slots", "steady", "changed"])
    return out.filter(F.col("steady") >= CONSISTENT * F.col("slots")).select("doc_id", "item_id", "slots", "changed")


def _by_place(hits: DataFrame, needed: Column) -> DataFrame:
    """Pairs whose values correspond at one place of the document.

    Windows of one copy of an item have one difference of positions, or about
    one if words were put in or left out: differences are also taken together
    that lie within an item's length, in two cuts, so that none splits a copy
    both times.  Then a window of the item counts where most others agree.
    A place must hold all slots of the item; parts are judged as a whole.
    """
    shift, half = F.col("pos") - F.col("at"), F.floor(F.col("n_words") / 2)
    near = lambda x: F.floor(x / F.col("n_words"))
    cuts = [(0, shift.cast("bigint")), (1, near(shift)), (2, near(shift + half))]
    one = Window.partitionBy("doc_id", "item_id", "copy", "shift")
    hits = hits.withColumn("shift", shift).withColumn("agree", F.count("*").over(one))
    places = F.array(*[F.struct(F.lit(k).alias("cut"), "copy", at.alias("at")) for k, at in cuts])
    by = ["doc_id", "item_id", "place_of"]
    likely = F.max_by(F.struct("asked", "said", "n_windows", "n_places"), F.struct("agree", -F.col("shift")))
    aligned = hits.withColumn("place_of", F.explode(places)).groupBy(*by, "at").agg(likely.alias("x")).select(*by, "at", "x.*")
    enough = aligned.groupBy(*by).agg(F.count("*").alias("windows"), F.max("n_windows").alias("n_windows"), F.max("n_places").alias("n_places"))
    enough = enough.filter(F.col("windows") >= needed)
    judged = _slot_values(aligned, *by).groupBy(*by)
    judged = judged.agg(*_slots(), F.sum(F.when(F.col("n") == 1, F.col("places")).otherwise(0)).alias("steady"), F.sum("places").alias("places"))
    out = enough.join(judged, by, "left").fillna(0, ["slots", "steady", "changed", "places"]).filter("places = n_places")
    return out.filter(F.col("steady") >= CONSISTENT * F.col("places")).select("doc_id", "item_id", "slots", "changed")


def _equal(hits: DataFrame, needed: Column) -> DataFrame:
    """Pairs with enough windows whose values are the item's own."""
    values = hits.withColumn("asked", F.col("asked.value")).filter(F.col("asked") == F.col("said.value"))
    out = values.groupBy("doc_id", "item_id").agg(
        F.count_distinct("at").alias("windows"), F.max("n_windows").alias("n_windows"), F.flatten(F.collect_set("asked")).alias("asked")
    )
    slots = F.size(F.array_distinct("asked")).cast("bigint")
    return out.filter(F.col("windows") >= needed).select("doc_id", "item_id", slots.alias("slots"), F.lit(0).cast("bigint").alias("changed"))


LEAKS = "doc_id bigint, item_id bigint, windows bigint, item_windows int, slots bigint, changed_slots bigint, kind string"


def decontamination_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: the documents that hold benchmark items."""
    return leaks(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"))
