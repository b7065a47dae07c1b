"""Spelling variants, the overlap join and tokenizer alignment against brute force, and on edge rows."""

import hashlib
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from edge_rows import edge_documents
from hypothesis import given, settings
from hypothesis import strategies as st

from stratum.llm import alignment, overlap_join, spelling
from stratum.llm.minhash import shingles


@pytest.fixture(scope="module")
def edge_docs(spark):
    return edge_documents(spark)


@pytest.fixture(scope="module")
def small(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    return docs, {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


# --- spelling variants -----------------------------------------------------


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_variants(rows):
    counts = Counter()
    for doc, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in "".join(c if "a" <= c <= "z" or "À" <= c <= "ÿ" else " " for c in low).split(" "):
            if run:
                h = zlib.crc32(f"{doc}:{run}".encode()) if doc is not None else 1
                counts[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 6 and k >= 5}
    near = {w: sorted((-n[o], o) for o in n if one_edit(w, o)) for w in n}
    form = {w: near[w][0][1] if near[w] and -near[w][0][0] >= 5 * n[w] else None for w in n}

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def variants_of(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=6), max_size=30, unique=True))
def test_scan_of_a_sorted_list(words):
    words.sort()
    found = list(spelling.near_pairs(words))
    assert len(set(found)) == len(found)
    assert set(found) == {(a, b) for i, a in enumerate(words) for b in words[i + 1 :] if one_edit(a, b)}


def test_variants_equal_brute_force(spark):
    rng = random.Random(3)
    stems = ["window", "windows", "cleaning", "Étranger×", "letterbox"]
    rows = []
    for i in range(120):
        words = []
        for _ in range(40):
            w = rng.choice(stems)
            if rng.random() < 0.3:
                k = rng.randrange(len(w))
                w = w[:k] + rng.choice(["", rng.choice("ae"), w[k] + rng.choice("xy")]) + w[k + 1 :]
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i if i % 20 else None, " 7".join(words)))
    rows += [(1, rows[1][1]), (500, None), (501, "")]
    rows += [(600, "lantern " * 200 + "lanterns " * 30 + "lanternsy " * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_variants(rows)
    assert len(want) > 50 and want["lanternsy"][:2] == ("lanterns", "lantern")
    assert variants_of(spelling.variants(docs)) == want


def test_long_lists_are_cut_without_loss(spark):
    words = sorted({f"prefix{a}{b}{c}suffix" for a in "abcd" for b in "abcd" for c in "abcd"} | {"prefixaasuffix", "prefixaaaasuffix"})
    vocabulary = spark.createDataFrame([(w,) for w in words], "word string")
    want = {(a, b) for a in words for b in words if a != b and one_edit(a, b)}
    for limit in (2, 10, 1000):
        assert {tuple(r) for r in spelling.near_words(vocabulary, limit).collect()} == want


def test_variants_of_edge_rows(spark, edge_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert variants_of(spelling.variants(edge_docs)) == brute_variants(rows)
    assert spelling.variants(edge_docs.limit(0)).collect() == []
    long = spark.createDataFrame([(1, ("a" * 100_000 + " ") * 5 + ("a" * 99_999 + " ") * 30)], "doc_id long, text string")
    got = variants_of(spelling.variants(long))
    assert got["a" * 100_000] == ("a" * 99_999, "a" * 99_999, 5, 1, 30) if len(got) == 2 else got


# --- overlap join ----------------------------------------------------------


def shingle_set(text, width):
    w = text.encode().lower().split()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute_components(texts, width, percent):
    sets = {i: shingle_set(t, width) for i, t in texts.items()}
    holders, shared, root = defaultdict(list), Counter(), {i: i for i in sets}
    for i in sorted(sets):
        for s in sets[i]:
            shared.update((j, i) for j in holders[s])
            holders[s].append(i)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sets(st.integers(0, 20)).map(sorted), min_size=1, max_size=12), st.integers(1, 12))
def test_divide_skip(lists, need):
    times = Counter(x for one in lists for x in one)
    assert sorted(overlap_join.divide_skip(lists, need)) == sorted((x, n) for x, n in times.items() if n >= need)


ODD_TEXT = st.text(st.sampled_from(" \t\n\v\f\rAaZzé\x1c\x85\u2003@[\x00"), max_size=40)
LONG_WORDS = st.lists(st.integers(1, 200).map(lambda n: "q" * n), max_size=6).map(" ".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | ODD_TEXT | LONG_WORDS, max_size=8), st.sampled_from([1, 2, 4]), st.sampled_from([1, 30, 1 << 17]))
def test_shingle_sets_of_a_batch(texts, width, chunk):
    with pytest.MonkeyPatch.context() as m:
        m.setattr(overlap_join, "CHUNK_BYTES", chunk)
        got = list(overlap_join.shingle_sets(pa.array(["before a b c d", *texts, "z"]).slice(1, len(texts)), width))
    want = [shingle_set(t or "", width) for t in texts]
    assert [len(s) for s in got] == [len(s) for s in want]
    assert all((s[1:] > s[:-1]).all() for s in got)
    for i, a in enumerate(want):
        for j, b in enumerate(want[:i]):
            assert len(np.intersect1d(got[i], got[j])) == len(a & b)


def test_shingle_sets_take_less_time_than_one_text_at_a_time():
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(500)) for _ in range(400)]
    batch = pa.array(texts)

    def least(run):
        took = []
        for _ in range(3):
            began = time.process_time()
            run()
            took.append(time.process_time() - began)
        return min(took)

    assert least(lambda: list(overlap_join.shingle_sets(batch, 4))) < 0.6 * least(lambda: [shingles(t, 4) for t in texts])


def test_bytes_that_are_no_utf8_have_shingles(spark):
    docs = spark.sql("SELECT 1L AS doc_id, cast(X'61FF' AS string) AS text UNION ALL SELECT 2L, cast(X'41FF20' AS string)")
    assert sorted(map(tuple, overlap_join.overlap_join(docs, 4, 85).collect())) == [(1, 1, 1), (2, 1, 1)]


@pytest.mark.parametrize("width, percent", [(4, 85), (5, 80), (2, 60)])
def test_overlap_join_equals_brute_force(small, width, percent):
    docs, texts = small
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in overlap_join.overlap_join(docs, width, percent).collect()}
    assert got == brute_components(texts, width, percent)


def near_copies(n, seed):
    """Chains and clusters of near copies, and texts made of passages that many share."""
    rng = random.Random(seed)
    passages = [[f"p{k}w{i}" for i in range(30)] for k in range(8)]
    texts = {}
    for i in range(n):
        kind = i % 3
        if kind == 0:
            words = [f"c{i % 2}w{k}" for k in range(60 + i % 4)]
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(50)}"
        elif kind == 1:
            words = [w for k in rng.sample(range(8), 3) for w in passages[k]]
        else:
            words = passages[i % 8] + [f"u{i}v{k}" for k in range(rng.randrange(12))]
        texts[i] = " ".join(words)
    return texts


def test_large_groups_lose_no_link(spark, monkeypatch):
    texts = near_copies(160, 1)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = brute_components(texts, 4, 85)
    assert len({c for _, c in want.values()}) > 20
    for size in (6, 40):
        monkeypatch.setattr(overlap_join, "CELL_DOCS", size)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in overlap_join.overlap_join(docs, 4, 85).collect()}
        assert got == want


def test_overlap_join_edges(spark, edge_docs):
    got = sorted(map(tuple, overlap_join.overlap_join(edge_docs, 4, 85).collect()), key=repr)
    by_id = dict((r[0], r[1:]) for r in got)
    assert len(got) == edge_docs.count()
    assert by_id[1] == by_id[2] == (15, 1) and by_id[3] == (0, 3) and by_id[4] == (0, 4) and by_id[5] == (0, 5)
    assert by_id[6] == by_id[7] == (1, 6) and by_id[10] == (1, 10) and by_id[None] == (2, None)
    assert sum(r[0] == 8 for r in got) == 2
    assert overlap_join.overlap_join(edge_docs.limit(0), 4, 85).collect() == []


# --- alignment -------------------------------------------------------------


@pytest.fixture(scope="module")
def words():
    return alignment.Words(*alignment.default_tokenizers())


def plain_alignment(words, text):
    """Groups and links of the whole text's tokens, token by token."""
    empty = (0, 0, 0, 0, "", Counter())
    if not text:
        return empty
    whole = " " + text
    ids = words.a.encode(whole, add_special_tokens=False).ids, words.b.encode(text)
    tokens = [words.bytes_a[i] for i in ids[0]], [words.bytes_b[i] for i in ids[1]]
    if any(b"".join(t) != whole.encode() for t in tokens):
        return empty
    ends = [np.cumsum([len(x) for x in t]).tolist() for t in tokens]
    groups, links = [], Counter()
    both = sorted(set(ends[0]) & set(ends[1]))
    for lo, hi in zip([0, *both], both):
        groups.append("|".join(",".join(str(i) for i, e in zip(ids[k], ends[k]) if lo < e <= hi) for k in (0, 1)))
    spans = [list(zip(i, [0, *e], e)) for i, e in zip(ids, ends)]
    j = 0
    for a, a_from, a_to in spans[0]:
        while spans[1][j][2] <= a_from:
            j += 1
        k = j
        while k < len(spans[1]) and spans[1][k][1] < a_to:
            links[a, spans[1][k][0]] += 1
            k += 1
    return len(ids[0]), len(ids[1]), len(groups), sum(links.values()), hashlib.sha256(";".join(groups).encode()).hexdigest(), links


ODD = [
    "  a  b\n\n c\t d  ",
    "\n\nx \n y\r\nz;\r",
    "ａ ﬁ ½\x1c\x1d é é 　 x <|endoftext|> <s> </s><0x41>\x00y",
    "a▁b",
    "it's  'tis don't 12 345 \U0001f600\U0001f600 ​  z  q",
    " ",
    "\n",
    "",
    "x" * 300 + " y " + "ab,cd" * 40,
    "Foo,bar(baz)foo.Bar;Foo",
]


def test_words_encode_as_whole_texts(words, small):
    texts = ODD + list(small[1].values())
    for text, both in zip(texts, words.encode(texts), strict=True):
        n_a, n_b, n_groups, n_links, digest, pairs, times = words.aligned(both)
        want = plain_alignment(words, text)
        assert (n_a, n_b, n_groups, n_links, digest) == want[:5], text[:80]
        assert {(p >> 32, p & 0xFFFFFFFF): t for p, t in zip(pairs.tolist(), times.tolist())} == want[5]


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)))
def test_diagonal(a, b):
    ea, eb = sorted(a | {61}), sorted(b | {61})
    closing_a, closing_b = alignment.diagonal(ea, eb)
    assert [ea[i] for i in closing_a] == [eb[j] for j in closing_b] == sorted(set(ea) & set(eb))


def test_memory_is_bounded(small):
    words = alignment.Words(*alignment.default_tokenizers())
    texts = list(small[1].values())
    want = [words.aligned(x)[4] for x in words.encode(texts)]
    before = alignment.KNOWN_WORDS
    try:
        alignment.KNOWN_WORDS = 500
        few = alignment.Words(*alignment.default_tokenizers())
        got = [few.aligned(x)[4] for k in range(0, len(texts), 20) for x in few.encode(texts[k : k + 20])]
    finally:
        alignment.KNOWN_WORDS = before
    assert got == want and len(few.known) < len(words.known)


def brute_align(words, rows):
    found = [(doc, plain_alignment(words, text)) for doc, text in rows]
    docs = Counter(p for _, x in found for p in x[5])
    top = defaultdict(int)
    for (a, _), n in docs.items():
        top[a] = max(top[a], n)
    return Counter(
        (doc, *x[:4], sum(t for p, t in x[5].items() if docs[p] == top[p[0]]), sum(t * docs[p] for p, t in x[5].items()), x[4])
        for doc, x in found
    )


def test_align_equals_brute_force(spark, small, words, monkeypatch):
    docs = small[0].repartition(5)
    want = brute_align(words, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert Counter(map(tuple, alignment.align(docs).collect())) == want
    monkeypatch.setattr(alignment, "CHUNK_CHARS", 3000)
    assert Counter(map(tuple, alignment.align(docs).collect())) == want


def test_align_edges(spark, edge_docs, words):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()] + list(enumerate(ODD, 100))
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, pairs int, chunk int")
    assert Counter(map(tuple, alignment.align(docs).collect())) == brute_align(words, rows)
    assert alignment.align(docs.limit(0)).collect() == []


ENDS_IN_SPACE = ["a ", "a b ", "Foo. ", "a\t ", "½ ", "a\n ", "a, ", "x<s> ", "word " * 50]


def test_texts_that_end_in_one_space_have_tokens(spark, words):
    for text in ENDS_IN_SPACE:
        n_a, n_b, *_ = words.aligned(words.encode([text])[0])
        assert n_a > 1 and n_b > 1, text
    rows = list(enumerate(ENDS_IN_SPACE))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, alignment.align(docs).collect())) == brute_align(words, rows)
