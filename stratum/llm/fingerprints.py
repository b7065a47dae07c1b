"""Document fingerprints by one-permutation MinHash.

Every shingle is hashed once; the hash's top bits name a bin and the least
hash of a bin stands for it.  A bin without a shingle borrows from another by
optimal densification: it tries the other bins in an order of its own and
takes the first that has one.  A fingerprint is the low-order bits of all bins,
packed into hex digits, and the share of equal digits, corrected for those
that agree by chance, estimates the similarity of two texts' shingle sets.

Only SQL expressions are used.  Each step is a column of its own, so that no
array is computed anew for every element that looks at it.
"""

from __future__ import annotations

import json
import random
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.llm.common import read

BINS, BIN_BITS = 128, 7
#: Low-order bits that are kept of a bin: one hex digit.
BITS = 4
WIDTH = 5
SPACE = " \t\n\x0b\x0c\r"
#: Documents of a stretch of ids, about: what one sort puts in order to find each document's successor.
STRETCH = 2000
#: Cuts of the order at one level; there are two levels.
FAN = 256
#: Stretches from here on hold the rows without an id.
NO_ID = 1 << 30
#: An odd factor a bin: (j - i) * factor mod BINS is bin i's order of trying the bins j, itself first.
FACTORS = [2 * random.Random(i).randrange(BINS // 2) + 1 for i in range(BINS)]


def with_fingerprint(df: DataFrame, text: str, name: str, width: int = WIDTH) -> DataFrame:
    """Add the fingerprint of column ``text`` as column ``name``; empty if it has no words.

    A-Z are lower-cased, words are what ASCII white space separates, and fewer
    words than ``width`` are one shingle.
    """
    t = lambda step: f"__{name}_{step}"
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.split(F.trim(lower, F.lit(SPACE)), r"[\x20\x09-\x0D]+")
    df = df.withColumn(t("w"), F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w)))
    w = F.col(t("w"))
    at = F.sequence(F.lit(0), F.greatest(F.size(w) - width, F.lit(0)))
    whole = F.array(F.xxhash64(F.concat_ws(" ", w.cast("array<string>"))))
    df = df.withColumn(
        t("s"),
        F.when(F.size(w) == 0, F.array().cast("array<bigint>"))
        .when(F.size(w) < width, whole)
        .otherwise(F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(width)]))),
    )
    df = df.withColumn(t("s"), F.sort_array(t("s")))
    s, bin_of = F.col(t("s")), lambda x: F.shiftrightunsigned(x, 64 - BIN_BITS)
    least = lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(s, i - 1)))
    df = df.withColumn(t("m"), F.filter(s, least))
    m = F.col(t("m"))
    df = df.withColumn(t("b"), F.transform(m, lambda x: bin_of(x).cast("int")))
    b = F.col(t("b"))
    digit = F.transform(m, lambda x: x.bitwiseAND(2**BITS - 1).cast("int"))
    df = df.withColumn(t("d"), F.map_from_arrays(b, digit))
    d = F.col(t("d"))
    bins = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(f).alias("f")) for i, f in enumerate(FACTORS)])

    def filled(bin_: Column) -> Column:
        order = lambda j: ((j - bin_["i"]) * bin_["f"]).bitwiseAND(BINS - 1) * BINS + j
        borrowed = F.array_min(F.transform(b, order)).bitwiseAND(BINS - 1)
        return F.coalesce(F.try_element_at(d, bin_["i"]), F.element_at(d, borrowed))

    packed = F.concat_ws("", F.transform(bins, lambda x: F.lower(F.hex(filled(x)))))
    df = df.withColumn(name, F.when(F.size(b) == 0, F.lit("")).otherwise(packed))
    return df.drop(*[t(x) for x in "wsmbd"])


def likeness(a: Column, b: Column) -> Column:
    """Estimated similarity, 0 to 1; texts without words are alike, and unlike all others."""
    same = F.size(F.filter(F.sequence(F.lit(1), F.lit(BINS)), lambda i: F.substr(a, i, F.lit(1)) == F.substr(b, i, F.lit(1))))
    chance = 2.0**-BITS
    corrected = (same / float(BINS) - chance) / (1 - chance)
    return (
        F.when((a == "") & (b == ""), F.lit(1.0))
        .when((a == "") | (b == ""), F.lit(0.0))
        .otherwise(F.greatest(F.lit(0.0), corrected))
    )


def cuts_of(docs: DataFrame) -> tuple[list[tuple[int, int]], int]:
    """Where to cut the order of (id, hash of the text), and the number of rows without an id.

    Quantiles of the ids, at most ``FAN`` of them, and as many again between
    each two; an id that spans several is cut by the hash, which is uniform.
    They steer how even stretches are, never a result.
    """
    quantiles = lambda n: F.percentile_approx("doc_id", [k / n for k in range(1, n)] or [0.5], 20 * FAN)
    total, known = docs.agg(F.count("*"), F.count("doc_id")).first()
    wanted = known // STRETCH + 1
    ids = docs.select("doc_id").filter("doc_id IS NOT NULL")
    coarse = list(ids.agg(quantiles(min(wanted, FAN)).alias("q")).first()["q"] or []) if wanted > 1 else []
    found = coarse
    if wanted > FAN:
        part = F.size(F.filter(_listed(sorted(set(coarse)), "bigint"), lambda c: c <= F.col("doc_id")))
        finer = ids.groupBy(part).agg(quantiles(min(wanted // FAN + 1, FAN)).alias("q")).select("q").collect()
        found = coarse + [q for r in finer for q in r["q"]]
    cuts = []
    for i, times in sorted(Counter(found).items()):
        cuts += [(i, -(2**63) + k * 2**64 // times) for k in range(times)]
    return cuts, total - known


def _listed(values: list, kind: str) -> Column:
    """A constant array, as one literal."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


def stretch_of(cuts: list[tuple[int, int]], without_id: int) -> Column:
    """The stretch of a row by its ``doc_id`` and ``tie``; rows without an id have stretches after all others."""
    key = F.struct(F.col("doc_id").alias("i"), F.col("tie").alias("t"))
    below = lambda known: F.size(F.filter(known, lambda c: c <= key))
    groups = [[{"i": i, "t": t} for i, t in cuts[k : k + FAN]] for k in range(0, len(cuts), FAN)]
    coarse = _listed([g[0] for g in groups], "struct<i:bigint,t:bigint>")
    group = F.get(_listed(groups, "array<struct<i:bigint,t:bigint>>"), below(coarse) - 1)
    known = below(coarse) * FAN * 2 + F.coalesce(below(group), F.lit(0))
    parts = min(without_id // STRETCH + 1, FAN * FAN)
    unknown = NO_ID + F.floor((F.col("tie") / 2.0**64 + 0.5) * parts).cast("int")
    return F.when(F.col("doc_id").isNull(), unknown).otherwise(known)


def with_successor(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Add the text and fingerprint of the next document by id; the first follows the last.

    Documents are dealt in stretches of the order, about ``STRETCH`` in each
    (more beyond ``FAN`` x ``FAN`` stretches), and ordered inside a stretch
    only; the last one of a stretch is joined to the first of the next.  The
    firsts are as many as the stretches, so they may be broadcast.
    """
    rows = docs.withColumn("tie", F.xxhash64("text"))
    rows = rows.withColumn("stretch", stretch_of(*cuts_of(docs)))
    order = F.struct("doc_id", "tie")
    firsts = rows.groupBy("stretch").agg(F.min(order).alias("f")).select("stretch", "f.doc_id", "f.tie")
    # At most 2 x FAN x FAN rows; rows without an id have no successor beyond their last.
    along = Window.partitionBy(F.col("stretch") >= NO_ID).orderBy("stretch")
    last = F.max("stretch").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    before = F.coalesce(F.lag("stretch").over(along), F.when(F.col("stretch") < NO_ID, last))
    firsts = firsts.withColumn("before", before).withColumnsRenamed({"stretch": "at", "doc_id": "first_id", "tie": "first_tie"})
    same = (F.col("stretch") == F.col("at")) & (F.col("tie") == F.col("first_tie")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    heads = rows.join(F.broadcast(firsts), same).dropDuplicates(["at"])
    heads = with_fingerprint(heads, "text", "head_print", width)
    heads = heads.select(F.col("before").alias("stretch"), F.col("text").alias("head"), "head_print")
    heads = heads.filter("stretch IS NOT NULL")
    inside = Window.partitionBy("stretch").orderBy("doc_id", "tie")
    led = with_fingerprint(rows, "text", "fingerprint", width).withColumns(
        {
            "led": F.lead("text").over(inside),
            "led_print": F.lead("fingerprint").over(inside),
            "is_last": F.lead("stretch").over(inside).isNull(),
        }
    )
    return led.join(heads, "stretch", "left").select(
        "doc_id",
        "text",
        "fingerprint",
        F.when(F.col("is_last"), F.coalesce("head", F.lit(""))).otherwise(F.col("led")).alias("next_text"),
        F.when(F.col("is_last"), F.coalesce("head_print", F.lit(""))).otherwise(F.col("led_print")).alias("next_print"),
    )


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """Fingerprints of every row's text and of the text with its last half replaced.

    Returns ``doc_id, text, edited, fingerprint, edited_fingerprint, near_edited,
    near_next``.  A null text is empty, an empty one has an empty
    fingerprint, and long ones are taken whole.
    Rows that repeat an id follow one another by a hash of their texts; rows
    with a null id are ordered among themselves by that hash, and the last of
    them is followed by an empty text.  Other columns are ignored.
    """
    docs = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left("text", n - half), F.left("next_text", half))
    rows = with_fingerprint(with_successor(docs, width).withColumn("edited", edited), "edited", "edited_fingerprint", width)
    return rows.select(
        "doc_id",
        "text",
        "edited",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_print")).alias("near_next"),
    )


def fingerprints_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: fingerprints of all documents and of their edited texts."""
    return edited_fingerprints(read(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )
