"""Column functions for links and URLs, built from regular expressions.

A URL is split with one anchored pattern, ``scheme://[userinfo@]host[:port]
path``; a part that is absent is ''.  Text that is not such a URL has an
empty scheme and host.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

URL_PATTERN = r"^([A-Za-z][A-Za-z0-9+.\-]*)://(([^@/?#]*)@)?([^:/?#]*)(:([0-9]*))?([^?#]*)"
# Attribute names are case-blind; a value is in either kind of quotes, or bare.
HREF_PATTERN = r"""(?i)\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""

# Markers of a local machine path inside a link target.
MACHINE_PATH_MARKERS = ("/Users/", "/home/", "C:/Users/", "C:\\Users\\", "file://", "vscode://")
# Link schemes that point outside the site.
EXTERNAL_PREFIXES = ("http://", "https://", "mailto:", "tel:")


def _url_part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, URL_PATTERN, group)


def url_scheme(url: Column) -> Column:
    return _url_part(url, 1)


def url_userinfo(url: Column) -> Column:
    return _url_part(url, 3)


def url_host(url: Column) -> Column:
    """Lower-cased host without a trailing dot."""
    return F.regexp_replace(F.lower(_url_part(url, 4)), r"\.$", "")


def url_port(url: Column) -> Column:
    return _url_part(url, 6)


def url_path(url: Column) -> Column:
    return _url_part(url, 7)


def hrefs(html: Column) -> Column:
    """All ``href`` targets of a document, in order, without their quotes."""
    raw = F.regexp_extract_all(html, F.lit(HREF_PATTERN), 1)
    return F.transform(raw, lambda v: F.trim(F.regexp_replace(v, r"""^["']|["']$""", "")))


def link_kind(link: Column) -> Column:
    lowered = F.lower(link)
    machine = F.lit(False)
    for m in MACHINE_PATH_MARKERS:
        machine = machine | link.contains(F.lit(m))
    external = F.lit(False)
    for p in EXTERNAL_PREFIXES:
        external = external | lowered.startswith(F.lit(p))
    return (
        F.when(machine, F.lit("machine_path"))
        .when(external, F.lit("external"))
        .when(link.startswith(F.lit("#")), F.lit("anchor"))
        .when(link.startswith(F.lit("/")), F.lit("route"))
        .otherwise(F.lit("local"))
    )


def resolved(link: Column, kind: Column, page_path: Column) -> Column:
    """``path, escapes`` of a route or local link, without query and fragment.

    A relative link starts from the folder of its page; empty and ``.``
    segments go, ``..`` takes the segment before it away, and one that finds
    none leaves the site.  The root is ``/``.
    """
    path = F.regexp_extract(link, r"^([^#?]*)", 1)
    folder = F.regexp_extract(F.concat(F.lit("/"), page_path), r"^(.*/)", 1)
    full = F.when(kind == "route", path).when(path == "", page_path).otherwise(F.concat(folder, path))

    def step(at: Column, s: Column) -> Column:
        kept, escapes = at["kept"], at["escapes"]
        pair = lambda k, e: F.struct(k.alias("kept"), e.alias("escapes"))
        return (
            F.when((s == "") | (s == "."), at)
            .when(s != "..", pair(F.concat(kept, F.array(s)), escapes))
            .when(F.size(kept) > 0, pair(F.slice(kept, F.lit(1), F.size(kept) - 1), escapes))
            .otherwise(pair(kept, F.lit(True)))
        )

    start = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(False).alias("escapes"))
    walked = F.aggregate(F.split(full, "/"), start, step)
    return F.struct(F.concat(F.lit("/"), F.array_join(walked["kept"], "/")).alias("path"), walked["escapes"].alias("escapes"))


def page_key(path: Column) -> Column:
    """A page's path as links are matched with it: no slash at the end but the root's."""
    return F.concat(F.lit("/"), F.regexp_replace(F.regexp_replace(path, "^/+", ""), "/+$", ""))
