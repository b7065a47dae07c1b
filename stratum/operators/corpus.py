"""Checks over text and event tables (R-1..R-4, D-9).

Each is a projection, explode or aggregate over the whole table; terms and
allow-lists are literals inside the expression, so no join with a term
table (and no pairing of rows) is needed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions import text as X
from stratum.functions.rules import Rule, first_match
from stratum.operators.joins import join_unique_side


def term_hits(df: DataFrame, id_cols: Sequence[str], text_col: str, terms: Sequence[str]) -> DataFrame:
    """One row per (record, term) whose lower-cased text contains the term
    (R-1): ``explode(filter(array(terms), t -> contains(lower(text), t)))``.

    The whole text is scanned; the term list is a literal array, evaluated
    per row.
    """
    term_array = F.array(*[F.lit(t.lower()) for t in terms])
    # Lower-case once per row, outside the lambda (a lambda does not share
    # subexpressions with its enclosing row).
    lowered = df.select(*id_cols, F.lower(F.col(text_col)).alias("_lower_text"))
    hits = F.filter(term_array, lambda t: F.col("_lower_text").contains(t))
    return lowered.select(*id_cols, F.explode(hits).alias("term"))


#: Grams, and terms, that are sent to the texts at most (some 10 MB); more of them are joined by a shuffle.
BROADCAST_GRAMS = 200_000


def _grams(text: Column, size: int) -> Column:
    """Distinct runs of ``size`` characters."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), 1))


#: Characters of texts that are cut into grams together, and cells of the table of grams they hold.
STRETCH_CHARS, HELD_CELLS = 1_000_000, 1 << 24
#: Terms of so many characters are looked up by grams of this size.
LONG_GRAM = 6
#: Grams of a term that are looked up, the rarest first, before the term is searched itself.
LOOKED_UP = 16


def _runs(text: str, size: int) -> set[str]:
    return {text[i : i + size] for i in range(len(text) - size + 1)}


def _codes(text: str, size: int) -> np.ndarray:
    """Each run of ``size`` characters as one number; different ones of over three may share theirs."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + 1
    codes = c[: max(0, len(c) - size + 1)]
    for k in range(1, size):
        codes = codes * 2_097_169 + c[k : k + len(codes)]
    return codes


def _held(texts: Sequence[str], wanted: np.ndarray, sizes: Sequence[int]) -> np.ndarray:
    """By text and wanted gram, whether the text holds it.  Long texts are cut in pieces that overlap."""
    held = np.zeros((len(texts), len(wanted)), bool)
    for k, text in enumerate(texts):
        for start in range(0, len(text), STRETCH_CHARS):
            for n in sizes:
                codes = _codes(text[start : start + STRETCH_CHARS + n - 1], n)
                at = np.minimum(np.searchsorted(wanted, codes), len(wanted) - 1)
                held[k, at[wanted[at] == codes]] = True
    return held


def _hits_where_read(lowered: DataFrame, id_cols: Sequence[str], terms: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """``indexed_term_hits`` for terms that fit into every task: looked up and checked where the texts are read."""
    sc = lowered.sparkSession.sparkContext
    # As many as BROADCAST_GRAMS at most, of either.
    words = sorted(r["term"] for r in terms.collect())
    size_of = {t: LONG_GRAM if len(t) >= LONG_GRAM else min(len(t), max(sizes)) for t in words}
    sizes = sorted(set(size_of.values()))
    grams_of = [sorted(_runs(t, size_of[t]))[:LOOKED_UP] for t in words]
    code_of = {g: int(_codes(g, len(g))[0]) for grams in grams_of for g in grams}
    wanted = np.array(sorted(code_of.values()), np.int64)
    at_of = {g: int(k) for g, k in zip(code_of, np.searchsorted(wanted, list(code_of.values())))}
    # Short rows are filled up with their first gram.
    grams = np.array([[at_of[g] for g in gs + gs[:1] * (LOOKED_UP - len(gs))] for gs in grams_of], np.int32)
    step = max(1, HELD_CELLS // max(len(wanted), len(words)))
    index = sc.broadcast((words, wanted, grams))

    def hits(texts: list[str]) -> Iterator[tuple[int, str]]:
        words, wanted, grams = index.value
        held = _held(texts, wanted, sizes)
        # Rarest first.
        order = np.take_along_axis(grams, np.argsort(held.sum(0)[grams], axis=1), axis=1)
        row, term = np.nonzero(held[:, order[:, 0]])
        for j in range(1, LOOKED_UP):
            both = held[row, order[term, j]]
            row, term = row[both], term[both]
        for i, t in zip(row.tolist(), term.tolist()):
            if words[t] in texts[i]:
                yield i, words[t]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns - 1
            for k in range(0, batch.num_rows, step):
                some = batch.slice(k, step)
                rows, terms = zip(*pairs) if (pairs := list(hits(some.column(last).to_pylist()))) else ((), ())
                ids = some.select(list(range(last))).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([*ids.columns, pa.array(terms, pa.string())], names=[*ids.schema.names, "term"])

    schema = T.StructType([*lowered.select(*id_cols).schema.fields, T.StructField("term", T.StringType())])
    return lowered.filter("_text IS NOT NULL").mapInArrow(found, schema)


def indexed_term_hits(
    df: DataFrame, id_cols: Sequence[str], text_col: str, terms: DataFrame, term_col: str = "term", size: int = 3
) -> DataFrame:
    """``term_hits`` for a table of terms, thousands and more (R-1).

    Each term is looked up by that one of its grams (runs of ``size``
    characters, or the whole of a shorter term) which the fewest records
    hold; the terms of a record's grams are checked against its whole text.
    The cost of cutting texts into grams does not grow with the terms.  Up to
    ``BROADCAST_GRAMS`` grams and terms are sent to the texts, which are then
    searched where they are read, some thousands at a time, by the grams that are
    rarest there: no text, gram or candidate is shuffled.  More of them meet in
    plain equi-joins.  Terms are compared in lower case and once each; NULL and
    empty terms are ignored, as are NULL texts.
    """
    wanted = terms.select(F.lower(F.col(term_col)).alias("term")).filter("term != ''").distinct()
    by_size = [F.when(F.length("term") == n, _grams(F.col("term"), n)) for n in range(1, size)]
    term_grams = wanted.select("term", F.explode(F.coalesce(*by_size, _grams(F.col("term"), size))).alias("gram"))
    # At most ``size`` rows.
    sizes = sorted(r["n"] for r in wanted.select(F.least(F.length("term"), F.lit(size)).alias("n")).distinct().collect())
    lowered = df.select(*id_cols, F.lower(F.col(text_col)).alias("_text"))
    grams = term_grams.select("gram").distinct()
    if sizes and size <= LONG_GRAM and grams.count() <= BROADCAST_GRAMS and wanted.count() <= BROADCAST_GRAMS:
        return _hits_where_read(lowered, id_cols, wanted, sizes)
    # A hash over ids and text names a record: rows without an id do not meet
    # on one key, and two records of one hash only share what is checked.
    records = lowered.withColumn("_record", F.xxhash64(*id_cols, "_text"))
    cut = F.flatten(F.array(*[_grams(F.col("_text"), n) for n in sizes])) if sizes else F.array().cast("array<string>")
    text_grams = records.filter("_text IS NOT NULL").select("_record", F.explode(cut).alias("gram"))
    held = text_grams.join(grams, "gram").groupBy("gram").agg(F.count("*").alias("n"))
    # A term with a gram that no record holds is in no text.
    rarity = F.struct(F.coalesce(F.col("n"), F.lit(0)).alias("n"), F.col("gram").alias("gram"))
    rare = term_grams.join(held, "gram", "left").groupBy("term").agg(F.min(rarity).alias("r"))
    rare = rare.filter("r.n > 0").select("term", F.col("r.gram").alias("gram"))
    candidates = text_grams.join(rare, "gram").select("_record", "term").distinct()
    return records.join(candidates, "_record").filter(F.col("_text").contains(F.col("term"))).select(*id_cols, "term")


def link_audit(pages: DataFrame, html_col: str = "html", url_col: str = "url") -> DataFrame:
    """Every link of every page, classified, with broken targets flagged (R-2).

    Kinds, first match: ``machine_path`` (a local machine path marker),
    ``external`` (http, https, mailto, tel), ``anchor`` (``#...``), ``route``
    (absolute ``/...``) and ``local`` (relative); a local link that climbs out
    of its site is ``escape``.  Routes and local links are resolved and matched
    with the pages of the same host; one that finds no page is broken, and so
    are machine paths and escapes.
    """
    url = F.col(url_col)
    host = X.url_host(url)
    links = pages.select(
        "page_id", host.alias("_host"), X.url_path(url).alias("_page_path"), F.explode(X.hrefs(F.col(html_col))).alias("link")
    )
    links = links.withColumn("_kind", X.link_kind(F.col("link")))
    links = links.withColumn("_to", X.resolved(F.col("link"), F.col("_kind"), F.col("_page_path")))
    inside = F.col("_kind").isin("route", "local")
    kind = F.when(inside & F.col("_to.escapes"), F.lit("escape")).otherwise(F.col("_kind"))
    # Host and path as one key: neither part holds a space.
    target = F.when(inside, F.concat_ws(" ", "_host", X.page_key(F.col("_to.path"))))
    classified = links.select("page_id", "link", kind.alias("link_kind"), target.alias("_target"))
    known = pages.select(F.concat_ws(" ", host, X.page_key(X.url_path(url))).alias("_known")).distinct()
    # A popular target (say "/") can hold a large share of all links: the
    # join stays splittable for AQE on the link side.
    joined = join_unique_side(classified, known, "_target", "_known", "left")
    broken = F.col("link_kind").isin("machine_path", "escape") | (
        F.col("link_kind").isin("route", "local") & F.col("_known").isNull()
    )
    return joined.select("page_id", "link", "link_kind", broken.alias("broken"))


@dataclass(frozen=True)
class JsonContract:
    """What a JSON document must hold.

    Names are paths of keys joined by dots, ``section.key``.  ``required``
    must be present; ``bounds`` are integers from low to high; ``lists`` have
    so many entries at least; every entry of a list in ``item_keys`` is an
    object with these keys.
    """

    required: Sequence[str] = ()
    bounds: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    lists: Mapping[str, int] = field(default_factory=dict)
    item_keys: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def rules(self, doc: Column) -> list[Rule]:
        """In order: an object, its keys, its numbers, its lists, their items.

        ``doc`` is the document parsed once, as a variant.
        """
        at = lambda path, kind: F.try_variant_get(doc, f"$.{path}", kind)
        items = lambda path: at(path, "array<variant>")
        rules = [Rule("json_object", "malformed_json", ~F.coalesce(F.schema_of_variant(doc).startswith("OBJECT"), F.lit(False)))]
        for k in self.required:
            rules.append(Rule(f"has_{k}", f"missing_key:{k}", at(k, "variant").isNull()))
        for k, (low, high) in self.bounds.items():
            n = at(k, "bigint")
            rules.append(Rule(f"{k}_in_range", f"out_of_range:{k}", n.isNull() | (n < low) | (n > high)))
        for k, least in self.lists.items():
            rules.append(Rule(f"{k}_long_enough", f"short_list:{k}", F.coalesce(F.size(items(k)) < least, F.lit(True))))
        for k, keys in self.item_keys.items():
            for key in keys:
                rules.append(Rule(f"{k}_items_have_{key}", f"item_without:{k}.{key}", F.exists(items(k), _lacks(key))))
        return rules


def _lacks(key: str) -> Callable[[Column], Column]:
    return lambda item: F.try_variant_get(item, f"$.{key}", "variant").isNull()


def json_contract(df: DataFrame, json_col: str, id_cols: Sequence[str], contract: JsonContract) -> DataFrame:
    """Rows whose JSON document breaks the contract, with the first violation
    (R-3).  A document is parsed once; a NULL or unreadable one is malformed."""
    parsed = df.select(*id_cols, F.try_parse_json(F.col(json_col)).alias("_doc"))
    violation = first_match(contract.rules(F.col("_doc")))
    return parsed.select(*id_cols, violation.alias("violation")).filter(F.col("violation").isNotNull())


def url_policy(df: DataFrame, url_col: str, id_cols: Sequence[str], allowed_domains: Sequence[str]) -> DataFrame:
    """First-match URL policy per row (R-4): https only, no userinfo, a host,
    no explicit port, host on the allow-list (the domain or a subdomain).
    ``violation`` is NULL for an accepted URL; a NULL one has no host."""
    url = F.col(url_col)
    scheme = F.lower(X.url_scheme(url))
    host = X.url_host(url)
    allowed: Column = F.lit(False)
    for d in allowed_domains:
        allowed = allowed | (host == F.lit(d)) | host.endswith(F.lit("." + d))
    rules = [
        Rule("https_only", "not_https", scheme != F.lit("https")),
        Rule("no_userinfo", "userinfo", X.url_userinfo(url) != F.lit("")),
        Rule("host_present", "missing_host", F.coalesce(host, F.lit("")) == F.lit("")),
        Rule("no_port", "port", X.url_port(url) != F.lit("")),
        Rule("host_allowed", "host_not_allowed", ~allowed),
    ]
    return df.select(*id_cols, url_col, host.alias("host"), first_match(rules).alias("violation"))


def daily_counts(events: DataFrame, allowed_types: Sequence[str], ts_col: str = "ts", type_col: str = "event_type") -> DataFrame:
    """Daily counters of allow-listed events (D-9).  Only the day and the
    event type leave the scan: identifiers and payloads are never selected,
    and other event types are filtered at the scan."""
    return (
        events.filter(F.col(type_col).isin(*allowed_types))
        .groupBy(F.to_date(F.col(ts_col)).alias("day"), F.col(type_col).alias("event_type"))
        .agg(F.count(F.lit(1)).alias("events"))
    )
