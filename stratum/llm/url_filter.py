"""URL filter: rules first, then naive Bayes over segmented host names.

A rule names a host and the start of a path and decides its host and all
subdomains; the longest rule that fits wins.  Urls that no rule decides are
judged by multinomial naive Bayes over the words of host and path, learnt from
the urls that rules decide.  Host names are words written together: a unigram
Viterbi splits them, with word counts from all pages.

Only substrings of distinct host labels are joined with the word counts, and
the classifier is a table of words that is joined with the words of distinct
urls, so neither the vocabulary nor the hosts pass through the driver.  Words
that hold a ``HEAVY``th of all occurrences, at most ``HEAVY`` of them, are
broadcast; what is left for the shuffle has no hot word.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import read, written
from stratum.operators.joins import join_unique_side

#: Words that smoothing supposes, each with one occurrence in each class.
BUCKETS = 1 << 16
#: A word with more than this part of all occurrences is heavy.
HEAVY = 1 << 16


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @staticmethod
    def of(verdict: str, name: str) -> Rule:
        host, slash, path = name.partition("/")
        return Rule(verdict, host, slash + path)

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


RULES = (
    Rule.of("block", "net/"),
    Rule.of("allow", "example.net/en/"),
    Rule.of("block", "example.com/de/"),
    Rule.of("allow", "org/fr/"),
)


def host_of(url: Column) -> Column:
    """From the first ``://`` to the next ``/``, ``?`` or ``#``, A-Z in lower case; else empty."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """``rule, verdict`` of the longest rule that fits; nulls if none does."""
    out = None
    for r in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        hit = F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))
        out = F.when(r.fits(host, path), hit) if out is None else out.when(r.fits(host, path), hit)
    return out


def word_counts(pages: DataFrame) -> DataFrame:
    """``word, n``: how often a word of letters occurs in the texts of all pages."""
    bare = F.regexp_replace(F.coalesce(F.col("html"), F.lit("")), r"<[^>]*>|&[#\p{L}\p{N}]*;", " ")
    words = F.explode(F.split(F.lower(bare), r"[^\p{L}]+")).alias("word")
    return pages.select(words).filter("word != ''").groupBy("word").agg(F.count("*").alias("n"))


def by_word(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Inner join of ``rows`` with a table that has one row a word, by ``word``.

    Words of more than a ``HEAVY``th of the rows are at most ``HEAVY`` and may be
    broadcast; the others are shuffled, none of them hot.
    """
    counted = rows.groupBy("word").agg(F.count("*").alias("rows")).join(table, "word")
    counted = written(counted, "words")
    least = (counted.agg(F.sum("rows")).first()[0] or 0) / HEAVY
    heavy = F.broadcast(counted.filter(F.col("rows") > least).drop("rows"))
    light = counted.filter(F.col("rows") <= least).drop("rows")
    rest = rows.join(heavy.select("word"), "word", "left_anti")
    return rows.join(heavy, "word").unionByName(rest.join(light, "word"))


def viterbi(label: str, counts: dict[tuple[int, int], int], total: int) -> list[str]:
    """The most probable split of ``label`` by unigram counts of its substrings (start, end).

    An unknown string has a probability that falls by ten a letter.  Of equal
    splits the one with the longest last word is taken.
    """
    n, letter = math.log(max(total, 1) + 1.0), math.log(10.0)
    ending: dict[int, list[tuple[int, int]]] = {}
    for (start, end), c in sorted(counts.items()):
        ending.setdefault(end, []).append((start, c))
    best, back = [0.0], [0]
    # Where an unknown word would best begin, for any end.
    unknown, since = 0.0, 0
    for end in range(1, len(label) + 1):
        top = (unknown - end * letter - n, since)
        for start, c in ending.get(end, ()):
            p = best[start] + math.log(c) - n
            if p > top[0] or p == top[0] and start < top[1]:
                top = (p, start)
        best.append(top[0])
        back.append(top[1])
        if top[0] + end * letter > unknown:
            unknown, since = top[0] + end * letter, end
    words, end = [], len(label)
    while end:
        words.append(label[back[end] : end])
        end = back[end]
    return words[::-1]


def segmented(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """``host, words``: the words of all labels of each distinct host."""
    parts = hosts.select("host", F.posexplode(F.split("host", r"[^\p{L}\p{N}]+")).alias("nth", "label")).filter("label != ''")
    labels = written(parts.select("label").distinct(), "labels")
    # Sizes of words that some label may hold: no more than the longest label has letters.
    longest = labels.agg(F.max(F.length("label"))).first()[0] or 0
    fitting = counts.withColumn("size", F.length("word")).filter(F.col("size") <= longest)
    sizes = sorted(r["size"] for r in fitting.select("size").distinct().collect())
    starts = labels.select("label", F.explode(F.sequence(F.lit(0), F.length("label") - 1)).alias("start"))
    fit = F.filter(F.array(*[F.lit(n) for n in sizes]).cast("array<int>"), lambda n: n <= F.length("label") - F.col("start"))
    spans = starts.select("label", "start", F.explode(fit).alias("size"))
    spans = spans.withColumn("word", F.substr("label", F.col("start") + 1, F.col("size")))
    # One-letter words are in nearly every label: letters meet their counts once each.
    once = spans.select("word").distinct().join(fitting.select("word", "n"), "word")
    known = by_word(spans, once).select("label", "start", (F.col("start") + F.col("size")).alias("end"), "n")
    # At most one entry a size for each letter of a label.
    tables = known.groupBy("label").agg(F.collect_list(F.struct("start", "end", "n")).alias("known"))
    total = counts.agg(F.sum("n")).first()[0] or 0

    def split(batches):
        for batch in batches:
            found = [
                viterbi(label, {(k["start"], k["end"]): k["n"] for k in known or []}, total)
                for label, known in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], names=["label", "words"])

    words = labels.join(tables, "label", "left").select("label", "known").mapInArrow(split, "label string, words array<string>")
    ordered = parts.join(words, "label").groupBy("host").agg(F.array_sort(F.collect_list(F.struct("nth", "words"))).alias("w"))
    return ordered.select("host", F.flatten(F.transform("w", lambda x: x["words"])).alias("words"))


def _tokens() -> Column:
    """The words of host and path, told apart; numbers count as their length."""
    path = F.filter(F.split(F.lower("path"), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.concat(
        F.transform(F.coalesce("words", F.array().cast("array<string>")), lambda w: F.concat(F.lit("h "), w)),
        F.transform(path, lambda w: F.concat(F.lit("p "), F.when(w.rlike(r"^\p{N}+$"), F.concat(F.lit("#"), F.length(w).cast("string"))).otherwise(w))),
    )


def log_odds(decided: DataFrame) -> tuple[DataFrame, float, float]:
    """``word, value``, the value of any other word, and the prior, by the ``tokens`` of ``decided`` urls with so many ``rows`` each.

    Values are log-odds of block.  With one class alone there is nothing to
    learn, and all are 0.
    """
    is_block = F.col("decided") == "block"
    of_class = (F.sum(F.when(is_block, F.col("rows")).otherwise(0)).alias("block"), F.sum(F.when(is_block, 0).otherwise(F.col("rows"))).alias("allow"))
    priors = decided.agg(*of_class).first()
    seen = written(decided.select("decided", "rows", F.explode("tokens").alias("word")).groupBy("word").agg(*of_class), "odds")
    if not (priors["block"] and priors["allow"]):
        return seen.select("word", F.lit(0.0).alias("value")), 0.0, 0.0
    sums = seen.agg(F.sum("block").alias("block"), F.sum("allow").alias("allow")).first()
    other = math.log(((sums["allow"] or 0) + BUCKETS) / ((sums["block"] or 0) + BUCKETS))
    value = F.log(F.col("block") + 1.0) - F.log(F.col("allow") + 1.0) + other
    return seen.select("word", value.alias("value")), other, math.log(priors["block"] / priors["allow"])


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``page_id, url, host, path, words, rule, score, verdict`` of every row of ``pages``.

    ``score`` is the log-odds of block by naive Bayes; above 0 blocks.  A null
    url, or one without ``://``, has an empty host and path and no rule, and is
    judged by the class priors alone; with nothing to learn from, all scores
    are 0 and nothing is blocked.  Null and empty html has no words, and long
    ones are counted whole.  Repeated rows are judged alike; an empty table has
    no rows; further columns are ignored.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    hosts = rows.select("host").filter("host != ''").distinct()
    words = written(segmented(hosts, written(word_counts(pages), "counts")), "hosts")
    # Each different url once, with the number of its rows.
    urls = rows.groupBy("host", "path").agg(F.count("*").alias("rows"))
    urls = join_unique_side(urls, words.withColumnRenamed("host", "_host"), "host", "_host").drop("_host")
    urls = urls.withColumn("hit", rule_of(F.col("host"), F.col("path"), rules)).withColumn("tokens", _tokens())
    urls = written(urls.select("host", "path", "words", "rows", "hit.rule", F.col("hit.verdict").alias("decided"), "tokens"), "urls")

    table, other, prior = log_odds(urls.filter("decided IS NOT NULL"))
    each = urls.select("host", "path", F.explode("tokens").alias("word"))
    values = by_word(each, table).groupBy("host", "path").agg(F.sum("value").alias("value"), F.count("*").alias("n"))
    unseen = (F.size("tokens") - F.coalesce("n", F.lit(0))) * other
    scored = urls.join(values, ["host", "path"], "left").withColumn("score", prior + F.coalesce("value", F.lit(0.0)) + unseen)
    by_score = F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow"))
    # For every row of a url again; one may hold a third of all rows.
    told = scored.select(F.struct("host", "path").alias("_url"), "words", "rule", "score", F.coalesce("decided", by_score).alias("verdict"))
    met = join_unique_side(rows.withColumn("_of", F.struct("host", "path")), told, "_of", "_url")
    return met.select("page_id", "url", "host", "path", "words", "rule", "score", "verdict")


def url_filter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: the verdict on all page urls."""
    return judge(read(spark, sf_dir, "pages", "page_id", "url", "html")).select("page_id", "host", "path", "rule", "verdict", "words", "score")
