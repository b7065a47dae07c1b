"""Main text by template deduction over the pages of a host.

Pages that come from one template share its tokens.  A token is a tag, or a
run of text, at its place in the page's tree; its occurrence vector says how
often it occurs on each page of the host.  Tokens with equal vectors form an
equivalence class; a class that stands on nearly all different pages and whose
tokens keep one order is valid, and the valid classes are the host's template.
HTML's own tree nests the classes: a token's place is its path of tags, and
block tags bound the slots between the template's tokens.

A page's text is that of the slots which no menu, header, footer, notice,
advert, form or comment encloses, without the blocks whose runs all belong to
the template; if most of it is in what the page marks as its article, only
that.  Menus and the like are told by tag names and class words.

Vectors, classes and orders are aggregates over all pages of a host, so a
page's text never depends on how the table is split.  Pages are parsed twice:
once for their tokens, once with the template of their host.
"""

from __future__ import annotations

import hashlib
import html as references
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import read, written

#: Different pages of a host that must share a token before it counts as the template's.
LEAST_PAGES = 4
#: Share of a host's different pages that a class must occur on, and of those in one order.
SUPPORT = 0.9
#: Characters of a host's part, about: a larger host is cut when its template is joined to its pages.
PART_CHARS = 8_000_000
#: Parts that all larger hosts have together, at most; beyond, parts grow.
PARTS = 1 << 16
#: Pages after which a task forgets the places it met.
PLACES_PAGES = 512

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+>|[^>]*(?:>|\Z))""",
    re.S,
)
_ATTR = re.compile(r"""([a-zA-Z:_-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td"
    " tfoot th thead title tr ul".split()
)
#: An opening tag closes these, up to the boundary.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
CLOSES["option"] = {"option"}
BOUNDARY = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
BOUNDARY["option"] = {"select"}
#: A paragraph ends where a block begins.
ENDS_P = BLOCK - {"br", "td", "th", "tr", "tbody", "thead", "tfoot", "body", "head", "html", "option", "legend", "title"}

#: Elements and roles that hold no article text.
DROPPED = frozenset(
    "nav footer aside form script style textarea title noscript iframe xmp noembed noframes template button select svg math"
    " dialog menu head canvas audio video object datalist".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form toolbar".split())
#: Words of a class or id that say the same.
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising advertorial adsense banner sponsor sponsored sponsors promo"
    " promos promotion cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup"
    " login signin sidebar sidebars widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead toolbar"
    " share sharing social related recommended recommendations comment comments commentlist reply replies respond disqus feedback"
    " search pagination pager copyright colophon paywall toc skip".split()
)
#: Beside these they speak of the page around it: ``with-sidebar``, ``no-ads``.
LAYOUT_WORDS = frozenset("with has no not free without layout".split())
HEADER_WORDS = frozenset(["header", "topbar"])
ARTICLE = frozenset(["article", "main"])


@dataclass
class Page:
    """Tokens of a page in order: (place, text or None), and blocks of runs."""

    tokens: list[tuple[int, str | None]]
    breaks: list[bool]


def _hash(*parts) -> int:
    digest = hashlib.blake2b("\x00".join(map(str, parts)).encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


class Places:
    """Places in the trees of pages, numbered; each has a name (the hash of its path) and a kind."""

    def __init__(self):
        self.number: dict[tuple, int] = {}
        self.name: list[int] = []
        self.kind: list[tuple[bool, bool]] = []

    def child(self, parent: int, tag: str, attrs: str) -> int:
        key = (parent, tag, attrs)
        n = self.number.get(key)
        if n is None:
            n = self.number[key] = len(self.kind)
            dropped, article = self.kind[parent] if parent >= 0 else (False, False)
            self.name.append(_hash(self.name[parent] if parent >= 0 else 0, tag, attrs))
            self.kind.append((dropped or is_dropped(tag, attrs, article), article or is_article(tag, attrs)))
        return n

    def run(self, place: int, plain: str) -> int:
        """Name of a run of text, white space apart, at its place."""
        return _hash("run", self.name[place] if place >= 0 else 0, plain)


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(text)}


def is_article(tag: str, attrs: str) -> bool:
    return tag in ARTICLE or "role" in attrs and _attributes(attrs).get("role") in ARTICLE


def is_dropped(tag: str, attrs: str, in_article: bool) -> bool:
    if tag in DROPPED or tag == "header" and not in_article:
        return True
    if not attrs or tag in ("html", "body", *ARTICLE):
        return False
    a = _attributes(attrs)
    if a.get("role", "").lower() in DROPPED_ROLES or a.get("aria-hidden") == "true" or "hidden" in a:
        return True
    if "display:none" in a.get("style", "").replace(" ", "").lower():
        return True
    for name in f"{a.get('class', '')} {a.get('id', '')}".split():
        words = {w.lower() for w in _WORD.findall(name)}
        if words & DROPPED_WORDS and not words & LAYOUT_WORDS or not in_article and words & HEADER_WORDS:
            return True
    return False


def _kept_attrs(text: str) -> str:
    """The part of a tag that names its place: class, id, role and what hides it."""
    if "=" not in text and "hidden" not in text:
        return ""
    a = _attributes(text)
    return " ".join(f'{k}="{a[k]}"' for k in ("class", "id", "role", "aria-hidden", "hidden", "style") if k in a)


def parse(source: str, places: Places) -> Page:
    """Tokens of a page.  A tag's place is its path of tags; a run of text has its element's place."""
    tokens: list[tuple[int, str | None]] = []
    breaks: list[bool] = []
    stack: list[tuple[str, int]] = []
    at, broken = 0, True

    def run(text: str) -> None:
        nonlocal broken
        if text:
            tokens.append((stack[-1][1] if stack else -1, references.unescape(text)))
            breaks.append(broken)
            broken = False

    while at < len(source):
        found = _TAG.search(source, at)
        if not found:
            break
        run(source[at : found.start()])
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if tag in BLOCK:
            broken = True
        if found[1]:
            if any(t == tag for t, _ in stack):
                while stack.pop()[0] != tag:
                    pass
            continue
        if tag in CLOSES:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in BOUNDARY[tag]:
                    break
                if stack[i][0] in CLOSES[tag]:
                    del stack[i:]
        if tag in ENDS_P:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    del stack[i:]
                    break
                if stack[i][0] in BLOCK:
                    break
        place = places.child(stack[-1][1] if stack else -1, tag, _kept_attrs(found[3]))
        tokens.append((place, None))
        breaks.append(True)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(source, at)
            at = end.start() if end else len(source)
            stack.append((tag, place))
        elif tag not in VOID and not found[3].endswith("/>"):
            stack.append((tag, place))
    run(source[at:])
    return Page(tokens, breaks)


def tokens_of(page: Page, places: Places) -> dict[int, int]:
    """How often each token occurs, in the order of first occurrences."""
    counts: dict[int, int] = {}
    for place, text in page.tokens:
        if text is None:
            token = places.name[place]
        elif plain := " ".join(text.split()):
            token = places.run(place, plain)
        else:
            continue
        counts[token] = counts.get(token, 0) + 1
    return counts


def template(pages: list[dict[int, int]]) -> set[int]:
    """The tokens of all valid classes of a few pages, by ``tokens_of``; ``host_templates`` does it for tables.

    A page that occurs several times counts once.
    """
    different = list({tuple(p.items()): p for p in pages}.values())
    vectors: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for n, page in enumerate(different):
        for token, c in page.items():
            vectors[token].append((n, c))
    classes: dict[tuple, set[int]] = defaultdict(set)
    for token, vector in vectors.items():
        if len(vector) >= max(LEAST_PAGES, SUPPORT * len(different)):
            classes[tuple(vector)].add(token)
    known: set[int] = set()
    for vector, members in classes.items():
        orders = Counter(tuple(t for t in different[n] if t in members) for n, _ in vector)
        if max(orders.values()) >= SUPPORT * len(vector):
            known |= members
    return known


def extract(page: Page, places: Places, known: set[int]) -> str:
    """The text of a page's article slots: blocks joined by a line feed.

    A block belongs to the template if all of its runs do, inside an article
    too.  Of the slots that remain, those of marked articles are the result if
    they hold half of the text at least; if not, the marks are of teasers or
    the like, and all slots are.
    """
    blocks: list[tuple[bool, list[tuple[str, bool]]]] = []
    fresh, inside = True, False
    for (place, text), broken in zip(page.tokens, page.breaks, strict=True):
        if text is None:
            continue
        fresh = fresh or broken
        dropped, article = places.kind[place] if place >= 0 else (False, False)
        if dropped:
            fresh = True
            continue
        if fresh or article != inside:
            blocks.append((article, []))
            fresh, inside = False, article
        plain = " ".join(text.split())
        blocks[-1][1].append((text, not plain or bool(known) and places.run(place, plain) in known))
    slots = [(a, " ".join("".join(text for text, _ in b).split())) for a, b in blocks if not all(constant for _, constant in b)]
    marked, other = (sum(len(s) for a, s in slots if a == mark) for mark in (True, False))
    return "\n".join(s for a, s in slots if a or marked < other)


def extract_block(sources: list[str]) -> list[str]:
    """Main texts of a few pages of one host, by the template that they share."""
    places = Places()
    pages = [parse(s, places) for s in sources]
    known = template([tokens_of(p, places) for p in pages])
    return [extract(p, places, known) for p in pages]


def _in_places(batches, *, rows: int) -> Iterator[tuple[Places, list[tuple]]]:
    """Rows in lists of at most ``rows``, each with places of its own."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held.append(row)
            if len(held) == rows:
                yield Places(), held
                held = []
    if held:
        yield Places(), held


def page_tokens(pages: DataFrame) -> DataFrame:
    """``host, page, tokens, counts, chars`` of each different page of a host.

    ``page`` is a hash of the tokens; pages of one hash are one row, which a
    task combines before the shuffle, and ``chars`` is the sum over them.
    """

    def tokens(batches):
        for places, rows in _in_places(batches, rows=PLACES_PAGES):
            found = [list(tokens_of(parse(html, places), places).items()) for _, html in rows]
            columns = [
                pa.array([h for h, _ in rows], pa.string()),
                pa.array([_hash(f) for f in found], pa.int64()),
                pa.array([[t for t, _ in f] for f in found], pa.list_(pa.int64())),
                pa.array([[c for _, c in f] for f in found], pa.list_(pa.int32())),
                pa.array([len(html) for _, html in rows], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "page", "tokens", "counts", "chars"])

    schema = "host string, page bigint, tokens array<bigint>, counts array<int>, chars bigint"
    every = pages.select("host", "html").mapInArrow(tokens, schema)
    return every.groupBy("host", "page").agg(
        F.first("tokens").alias("tokens"), F.first("counts").alias("counts"), F.sum("chars").alias("chars")
    )


def in_parts(rows: DataFrame, sizes: DataFrame, *mix: str) -> DataFrame:
    """Add ``part``: larger hosts are cut by a hash of ``mix``.  ``sizes`` (at most ``PARTS`` rows) may be broadcast."""
    cut = rows.join(F.broadcast(sizes), "host", "left")
    return cut.withColumn("part", F.pmod(F.xxhash64(*mix), F.coalesce("parts", F.lit(1)))).drop("parts")


def for_parts(per_host: DataFrame, sizes: DataFrame) -> DataFrame:
    """Repeat a row a host for each of the host's parts."""
    cut = per_host.join(F.broadcast(sizes), "host", "left")
    parts = F.sequence(F.lit(0).cast("bigint"), F.coalesce("parts", F.lit(1)) - 1)
    return cut.withColumn("part", F.explode(parts)).drop("parts")


def large_hosts(different: DataFrame) -> DataFrame:
    """``host, parts`` of hosts with more than one part: at most ``PARTS`` of them."""
    total = different.agg(F.sum("chars")).first()[0] or 0
    part = max(PART_CHARS, total // PARTS + 1)
    chars = different.groupBy("host").agg(F.sum("chars").alias("chars")).filter(F.col("chars") > part)
    return chars.select("host", (F.floor(F.col("chars") / part) + 1).alias("parts"))


def host_templates(different: DataFrame, sizes: DataFrame) -> DataFrame:
    """``host, known``: the tokens of the valid classes of each host that has any.

    A token's vector is kept as the number of pages and a hash of all (page,
    count).  Tokens on so many pages are about as many as a page has.
    """
    pages = different.groupBy("host").agg(F.count("*").alias("pages"))
    each = different.select("host", "page", F.explode(F.arrays_zip("tokens", "counts")).alias("t"))
    vectors = each.groupBy("host", F.col("t.tokens").alias("token")).agg(
        F.count("*").alias("n"), F.expr("bit_xor(xxhash64(page, t.counts))").alias("vector")
    )
    frequent = vectors.filter(F.col("n") >= LEAST_PAGES).join(pages, "host").filter(F.col("n") >= SUPPORT * F.col("pages"))
    classes = written(
        frequent.groupBy("host").agg(F.collect_list("token").alias("token"), F.collect_list("vector").alias("vector")), "classes"
    )

    def orders(batches):
        for batch in batches:
            hosts, vectors, found = [], [], []
            for host, tokens, of, vector in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                class_of = dict(zip(of, vector, strict=True))
                in_order: dict[int, list[int]] = defaultdict(list)
                for token in tokens:
                    if token in class_of:
                        in_order[class_of[token]].append(token)
                for v, members in in_order.items():
                    hosts.append(host)
                    vectors.append(v)
                    found.append(_hash(members))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(vectors, pa.int64()), pa.array(found, pa.int64())],
                names=["host", "vector", "seen"],
            )

    rows = in_parts(different.select("host", "page", "tokens"), sizes, "page")
    met = rows.join(for_parts(classes, sizes), ["host", "part"]).select("host", "tokens", "token", "vector")
    seen = met.mapInArrow(orders, "host string, vector bigint, seen bigint").groupBy("host", "vector", "seen").agg(F.count("*").alias("n"))
    valid = seen.groupBy("host", "vector").agg(F.max("n").alias("most"), F.sum("n").alias("n")).filter(F.col("most") >= SUPPORT * F.col("n"))
    members = classes.select("host", F.explode(F.arrays_zip("token", "vector")).alias("t")).select("host", "t.token", "t.vector")
    return members.join(valid.select("host", "vector"), ["host", "vector"]).groupBy("host").agg(F.collect_list("token").alias("known"))


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` of every row of ``pages``.

    A null or empty html has an empty text, and long pages are taken whole;
    rows without a url share a host of their own; repeated rows get the same
    text each and count once for the template; an empty table has no rows;
    further columns are ignored.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"://([^/?#]*)", 1))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", F.coalesce(F.col("html"), F.lit("")).alias("html"))
    rows = rows.withColumn("host", host)
    different = written(page_tokens(rows), "tokens")
    sizes = written(large_hosts(different), "hosts")
    known = written(host_templates(different, sizes), "templates")

    def texts(batches):
        for places, held in _in_places(batches, rows=PLACES_PAGES):
            found = [extract(parse(html, places), places, set(known or ())) for _, _, html, known in held]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, *_ in held], pa.int64()), pa.array([u for _, u, *_ in held], pa.string())]
                + [pa.array(found, pa.string())],
                names=["page_id", "url", "text"],
            )

    met = in_parts(rows, sizes, "page_id", "html").join(for_parts(known, sizes), ["host", "part"], "left")
    return met.select("page_id", "url", "html", "known").mapInArrow(texts, "page_id bigint, url string, text string")


def extraction_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: the main text of all pages."""
    found = main_text(read(spark, sf_dir, "pages", "page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
