"""Text, link, URL and JSON checks on hand-made rows."""

import random

import pytest

from stratum.operators import corpus


def test_term_hits_whole_text(spark):
    long_text = ("filler " * 5000) + "We are Hiring now"
    df = spark.createDataFrame([(1, long_text), (2, "nothing here"), (3, "채용 공고 and a Cover Letter")], "id long, text string")
    got = sorted((r.id, r.term) for r in corpus.term_hits(df, ["id"], "text", ["hiring", "cover letter", "채용"]).collect())
    assert got == [(1, "hiring"), (3, "cover letter"), (3, "채용")]


@pytest.mark.parametrize("sent", [0, 200_000])
def test_indexed_term_hits_equal_the_literal_scan(spark, monkeypatch, sent):
    monkeypatch.setattr(corpus, "BROADCAST_GRAMS", sent)
    rnd = random.Random(7)
    letters = "abcdé漢😀. "
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.choice([0, 1, 2, 30, 400]))) for _ in range(60)]
    texts += [texts[5], "x " * 9000 + "Needle(.*)", None, "tail"]
    # Repeated ids with other texts, and rows without an id.
    rows = [(k // 2 if k % 5 else None, t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "id long, text string").repartition(3)
    terms = ["".join(rnd.choice(letters) for _ in range(n)) for n in (1, 2, 2, 3, 3, 4, 5, 6) for _ in range(20)]
    terms += ["NEEDLE(.*)", "needle(", "nowhere", "x x", "il"]
    table = spark.createDataFrame([(t,) for t in [*terms, terms[0], "", None]], "term string")
    got = corpus.indexed_term_hits(docs, ["id"], "text", table).collect()
    want = corpus.term_hits(docs, ["id"], "text", sorted({t.lower() for t in terms})).collect()
    key = lambda r: (r.id is None, r.id or 0, r.term)
    assert sorted(got, key=key) == sorted(want, key=key) and len(want) > 500
    assert corpus.indexed_term_hits(docs, ["id"], "text", table.limit(0)).count() == 0
    assert corpus.indexed_term_hits(docs.limit(0), ["id"], "text", table).count() == 0


def test_link_audit(spark):
    html = (
        '<a href="/en/1">ok</a><a href="/missing">x</a><a href="https://x.org">e</a>'
        '<a href="#top">a</a><a href="file:///Users/me/x">m</a><a href="2?q=1">rel</a><a href="?only">q</a>'
    )
    pages = spark.createDataFrame(
        [(1, "https://a.example.com/en/1", html), (2, "https://a.example.com/en/2", "")], "page_id long, url string, html string"
    )
    got = {r.link: (r.link_kind, r.broken) for r in corpus.link_audit(pages).collect()}
    assert got == {
        "/en/1": ("route", False),
        "/missing": ("route", True),
        "https://x.org": ("external", False),
        "#top": ("anchor", False),
        "file:///Users/me/x": ("machine_path", True),
        "2?q=1": ("local", False),  # resolves to /en/2, a known page
        "?only": ("local", False),
    }


def test_url_policy_first_match(spark):
    urls = [
        (1, "https://www.example.com/a"),
        (2, "http://www.example.com/a"),
        (3, "https://user:pw@example.com/a"),
        (4, "https:///nohost"),
        (5, "https://example.com:8443/a"),
        (6, "https://evil.example.net/a"),
        (7, "not a url"),
        (8, "HTTPS://Example.ORG./x"),
        (9, None),
    ]
    df = spark.createDataFrame(urls, "page_id long, url string")
    got = {r.page_id: r.violation for r in corpus.url_policy(df, "url", ["page_id"], ["example.com", "example.org"]).collect()}
    assert got == {
        1: None,
        2: "not_https",
        3: "userinfo",
        4: "missing_host",
        5: "port",
        6: "host_not_allowed",
        7: "not_https",
        8: None,
        9: "missing_host",
    }


def test_json_contract(spark):
    rows = [(1, '{"k": 3}'), (2, '{"j": 1}'), (3, "[1, 2]"), (4, "not json"), (5, '{"k": 120}'), (6, '{"k": "x"}')]
    df = spark.createDataFrame(rows, "id long, props string")
    got = {r.id: r.violation for r in corpus.json_contract(df, "props", ["id"], corpus.JsonContract(required=("k",), bounds={"k": (0, 99)})).collect()}
    assert got == {2: "missing_key:k", 3: "malformed_json", 4: "malformed_json", 5: "out_of_range:k", 6: "out_of_range:k"}


def test_json_contract_of_nested_documents(spark):
    c = corpus.JsonContract(
        required=("a.b",), bounds={"a.n": (1, 5)}, lists={"items": 2}, item_keys={"items": ("id",)}
    )
    docs = [
        '{"a": {"b": 1, "n": 2}, "items": [{"id": 1}, {"id": 2}]}',
        '{"a": {"n": 2}, "items": [{"id": 1}, {"id": 2}]}',
        '{"a": {"b": 1, "n": 9}, "items": [{"id": 1}, {"id": 2}]}',
        '{"a": {"b": 1, "n": 2}, "items": [{"id": 1}]}',
        '{"a": {"b": 1, "n": 2}, "items": [{"id": 1}, {"x": 2}]}',
        '{"a": {"b": 1, "n": 2}}',
        None,
    ]
    df = spark.createDataFrame(list(enumerate(docs)), "id long, doc string")
    got = {r.id: r.violation for r in corpus.json_contract(df, "doc", ["id"], c).collect()}
    assert got == {
        1: "missing_key:a.b",
        2: "out_of_range:a.n",
        3: "short_list:items",
        4: "item_without:items.id",
        5: "short_list:items",
        6: "malformed_json",
    }


def test_links_resolve_inside_their_host(spark):
    pages = spark.createDataFrame(
        [
            (1, "https://a.com", """<A HREF='/x.html'>1</A><a href=./y.html>2</a><a href="../../z">3</a><a href="/">4</a><a href="?q">5</a>"""),
            (2, "https://a.com/x.html", '<a href="y.html">6</a><a href="sub/../y.html#f">7</a><a href="/only-b">8</a>'),
            (3, "https://a.com/y.html", "<a href='..'>9</a>"),
            (4, "https://b.com/only-b", '<a href="/x.html">10</a><a href="/only-b/">11</a>'),
        ],
        "page_id long, url string, html string",
    )
    got = {(r.page_id, r.link): (r.link_kind, r.broken) for r in corpus.link_audit(pages).collect()}
    assert got == {
        (1, "/x.html"): ("route", False),
        (1, "./y.html"): ("local", False),
        (1, "../../z"): ("escape", True),
        (1, "/"): ("route", False),
        (1, "?q"): ("local", False),
        (2, "y.html"): ("local", False),
        (2, "sub/../y.html#f"): ("local", False),
        (2, "/only-b"): ("route", True),
        (3, ".."): ("escape", True),
        (4, "/x.html"): ("route", True),
        (4, "/only-b/"): ("route", False),
    }


def test_daily_counts_drop_identifiers(spark):
    import datetime as dt

    ev = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1, 1), 7, "view"), (2, dt.datetime(2024, 1, 1, 23), 8, "view"), (3, dt.datetime(2024, 1, 2), 9, "error")],
        "event_id long, ts timestamp_ntz, user_id long, event_type string",
    )
    out = corpus.daily_counts(ev, ["view", "click"])
    assert out.columns == ["day", "event_type", "events"]
    assert [(str(r.day), r.event_type, r.events) for r in out.collect()] == [("2024-01-01", "view", 2)]


def test_texts_are_searched_where_they_are_read(spark):
    """With terms that can be sent to the texts, neither texts nor candidates are shuffled."""
    docs = spark.createDataFrame([(1, "A rare phrase, and a Rare Phrase"), (2, None), (None, "phrase")], "id long, text string")
    terms = spark.createDataFrame([("rare phrase",), ("phrase",), ("none",)], "term string")
    found = corpus.indexed_term_hits(docs, ["id"], "text", terms)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.id or 0, r.term) for r in found.collect()) == [(0, "phrase"), (1, "phrase"), (1, "rare phrase")]
