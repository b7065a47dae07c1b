"""Document operators against brute force, and on edge rows."""

import hashlib
import random
import re
import struct
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from edge_rows import edge_documents

from stratum.llm import decontamination, fingerprints, graph, minhash, packing, quality, sharding, subword, toxicity
from stratum.llm.subword import Features, Training, fit


@pytest.fixture(scope="module")
def edge_docs(spark):
    return edge_documents(spark)


@pytest.fixture(scope="module")
def small(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    return docs, {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


def shingle_set(text, width):
    w = text.encode().lower().split()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute_components(texts, width):
    sets = {i: shingle_set(t, width) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


# --- near-duplicates -------------------------------------------------------


@pytest.mark.parametrize("width", [4, 5])
def test_components_equal_brute_force(small, width):
    docs, texts = small
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, width).collect()}
    assert got == brute_components(texts, width)


def test_blocks_lose_no_link(spark, monkeypatch):
    """Many edits of one text, dealt into many small blocks."""
    monkeypatch.setattr(minhash, "BLOCK_DOCS", 5)
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    texts = {}
    for i in range(60):
        w = list(base)
        for k in rng.integers(0, 120, rng.integers(0, 6)):
            w[k] = f"x{rng.integers(0, 9)}"
        texts[i] = " ".join(w)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, 4).collect()}
    assert got == brute_components(texts, 4)


def test_near_duplicates_edges(edge_docs):
    got = minhash.near_duplicates(edge_docs, 4).collect()
    assert len(got) == 11
    by = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got}
    assert by[1] == (15, 1, True) and by[2] == (15, 1, False)
    assert by[3] == by[3][:1] + (3, True) and by[3][0] == 0 and by[4] == (0, 4, True) and by[5] == (0, 5, True)
    assert by[6] == (1, 6, True) and by[7] == (1, 6, False)
    assert by[None][1:] == (None, True)
    assert minhash.near_duplicates(edge_docs.limit(0)).count() == 0


def test_signature_is_circulant():
    s = minhash.shingles("a b c d e f g h", 4)
    x = (minhash._mix64(s) >> np.uint64(32)).astype(np.uint32)
    for k in (0, 1, 95):
        assert minhash.signature(s)[k] == minhash._permute32(x - np.uint32(k)).min()


def test_graph_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 7), (3, 1), (20, 30), (30, 40), (40, 50), (50, 60)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = dict(tuple(r) for r in graph.components(df).collect())
    assert got == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7, 20: 20, 30: 20, 40: 20, 50: 20, 60: 20}
    assert graph.components(df.limit(0)).count() == 0


@pytest.mark.parametrize("task_edges, most", [(500_000, 2), (60, 100)])
def test_graph_components_of_long_paths(spark, monkeypatch, task_edges, most):
    tables = []
    monkeypatch.setattr(graph, "TASK_EDGES", task_edges)
    monkeypatch.setattr(graph, "written", lambda df, name, write=graph.written: tables.append(name) or write(df, name))
    ids = np.random.default_rng(3).permutation(400).tolist()
    paths = [ids[:150], ids[150:390], ids[390:392]]
    edges = [(a, b) for path in paths for a, b in zip(path[:-1], path[1:], strict=True)]
    edges += [(ids[150], k) for k in ids[200:300]] + [(7, 7), edges[0], edges[0][::-1], (None, 3)]
    got = graph.components(spark.createDataFrame(edges, "u long, v long").repartition(8)).collect()
    assert sorted(map(tuple, got)) == sorted((i, min(path)) for path in paths for i in path)
    # Edges that fit one task are reduced there: no rounds of shuffles.
    assert len(tables) <= most and (most == 2 or len(tables) > 4)


# --- packing ---------------------------------------------------------------


def test_pack_round_trip(edge_docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    want = defaultdict(list)
    for r in edge_docs.collect():
        want[r.doc_id].append(tok.encode(r.text or "", add_special_tokens=False).ids + [1])
    pieces = packing.pack(edge_docs, length=64).collect()
    at = 0
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.sequence_id * 64 + p.offset == at and p.offset + len(p.ids) // 4 <= 64
        at += len(p.ids) // 4
    assert at == sum(len(x) for v in want.values() for x in v)
    for i, lists in want.items():
        mine = [p for p in pieces if p.doc_id == i]
        got = b"".join(p.ids for p in sorted(mine, key=lambda p: (p.sequence_id, p.offset)))
        assert list(struct.unpack(f"<{len(got) // 4}I", got)) == [t for x in lists for t in x]
    assert packing.pack(edge_docs.limit(0)).count() == 0


def test_word_ids_equal_the_tokenizer():
    words = packing.WordIds(packing.default_tokenizer())
    for t in ["It's O'Neil's!! U.S.A.", "x<|endoftext|>y. A", "a\x1cb\u2003c", "ΣΑΣ İstanbul, naïve...", "don't-- you'LL ab.'s $$$a***"]:
        ids = words.tokenizer.encode(t, add_special_tokens=False).ids
        assert words.encode(t) == struct.pack(f"<{len(ids)}I", *ids)


# --- sharding --------------------------------------------------------------


def test_sharding_laws(spark, edge_docs):
    docs = spark.range(6000).selectExpr("id AS doc_id", "concat('t', id) AS text")
    rows = sharding.assign(docs, sharding.Topology.regular(24)).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 24)
        assert r.text_crc32 == zlib.crc32(f"t{r.doc_id}".encode()) and r.size == len(f"t{r.doc_id}") + 8
    assert sorted(slots) == list(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(150 < len(s) < 350 for s in slots.values())
    assert 120 < sum(r.grown_shard == 24 for r in rows) < 400
    edge = sharding.assign(edge_docs, sharding.Topology.regular(24)).collect()
    assert len(edge) == 11 and {r["size"] for r in edge if r.doc_id in (3, 4)} == {8}
    assert sharding.assign(edge_docs.limit(0), sharding.Topology.regular(24)).count() == 0


def test_weights_move_only_their_subtree(spark):
    plain = sharding.Topology.regular(24)
    regions = list(plain.regions)
    racks = list(regions[1])
    racks[2] = tuple((s, 3.0) for s, _ in racks[2])
    heavier = sharding.Topology((regions[0], tuple([racks[0], racks[1], racks[2]])))
    keys = spark.range(3000).selectExpr("cast(id AS string) AS k")
    from pyspark.sql import functions as F

    moved = keys.select(
        sharding.shard_of(F.col("k"), plain).alias("a"), sharding.shard_of(F.col("k"), heavier).alias("b")
    ).filter("a != b").collect()
    # Into region 1, or inside it into the heavier rack.
    assert moved and all(r.b >= 12 for r in moved)
    assert all(r.b >= 20 for r in moved if r.a >= 12)


# --- fingerprints ----------------------------------------------------------


def test_fingerprints_equal_brute_force(small):
    docs, texts = small
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(docs).collect()}
    ids = sorted(texts)
    errors = []
    for k, i in enumerate(ids):
        t, after = texts[i], texts[ids[(k + 1) % len(ids)]]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        assert got[i].edited == edited
        a, b = shingle_set(t, 5), shingle_set(edited, 5)
        errors.append(got[i].near_edited - len(a & b) / len(a | b))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08
    assert {len(r.fingerprint) for r in got.values()} <= {0, 128}


@pytest.mark.parametrize("fan", [2, 256])
def test_stretches_agree_with_one_order(spark, monkeypatch, fan):
    monkeypatch.setattr(fingerprints, "STRETCH", 3)
    monkeypatch.setattr(fingerprints, "FAN", fan)
    ids = [-9 * 10**18, 9 * 10**18, 2**62, *(i * i for i in range(40))]
    docs = spark.createDataFrame([(i, f"text number {i} here") for i in ids], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.next_text for r in fingerprints.with_successor(docs).collect()}
    ids.sort()
    assert got == {i: f"text number {n} here" for i, n in zip(ids, ids[1:] + ids[:1], strict=True)}


def test_stretches_are_even(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "STRETCH", 20)
    ids = [2**62, -(2**62), *range(400), *[7] * 300, *[None] * 300]
    docs = spark.createDataFrame([(i, f"text {k}") for k, i in enumerate(ids)], "doc_id long, text string")
    rows = docs.selectExpr("*", "xxhash64(text) AS tie").withColumn("s", fingerprints.stretch_of(*fingerprints.cuts_of(docs)))
    assert max(r["count"] for r in rows.groupBy("s").count().collect()) <= 60
    # Each row follows the one before in (id, hash) order; rows without an id end with an empty text.
    follows = sorted(r.next_text for r in fingerprints.with_successor(docs).collect())
    texts = [f"text {k}" for k in range(len(ids))]
    known = [(r.doc_id, r.tie, r.text) for r in rows.collect()]
    first_null = min((t, x) for i, t, x in known if i is None)[1]
    assert follows == sorted(x if x != first_null else "" for x in texts)


def brute_fingerprint(hashes):
    """By the definition: least hash a bin, an empty bin takes that of the first filled one in its order."""
    least = {}
    for h in hashes:
        b = (h % 2**64) >> (64 - fingerprints.BIN_BITS)
        least[b] = min(h, least.get(b, h))
    out = ""
    for i, f in enumerate(fingerprints.FACTORS):
        b = min(least, key=lambda j: ((j - i) * f) % fingerprints.BINS)
        out += f"{least[b] % 2**fingerprints.BITS:x}"
    return out


def test_fingerprints_equal_brute_force_digit_by_digit(spark, small):
    docs, texts = small
    got = {r.doc_id: r.fingerprint for r in fingerprints.with_fingerprint(docs, "text", "fingerprint").collect()}
    for i in sorted(texts)[:12]:
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[i].translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})))
        if len(words) < 5:
            continue
        hashed = spark.createDataFrame([(words,)], "w array<string>").selectExpr("transform(w, x -> xxhash64(x)) AS w")
        runs = "transform(sequence(0, size(w) - 5), i -> xxhash64(w[i], w[i+1], w[i+2], w[i+3], w[i+4]))"
        assert got[i] == brute_fingerprint(hashed.selectExpr(f"{runs} AS s").first()["s"])


def test_fingerprint_edges(edge_docs):
    got = fingerprints.edited_fingerprints(edge_docs).collect()
    assert len(got) == 11
    by = {r.doc_id: r for r in got}
    assert by[1].fingerprint == by[2].fingerprint and by[3].fingerprint == by[4].fingerprint == ""
    assert by[1].near_next == 1.0 and by[3].near_next == 1.0 and by[6].near_next == 1.0 and by[2].near_next == 0.0
    assert fingerprints.edited_fingerprints(edge_docs.limit(0)).count() == 0


# --- decontamination -------------------------------------------------------


def test_leaks(spark, edge_docs):
    items = spark.createDataFrame(
        [
            (1, "A train leaves Boston at 3 pm and travels to Denver at 60 km per hour until Boston is far behind it"),
            (2, "what is two"),
            (3, ""),
            (4, None),
            (None, "one two"),
        ],
        "item_id long, text string",
    )
    other = "A train leaves Bern at 5 pm and travels to New York at 75 km per hour until Bern is far behind it"
    docs = spark.createDataFrame(
        [
            (1, "Well. " + other + " ok?"),
            (2, "So what is two?"),
            (3, "A train leaves Bern at 5 pm and then something else happens"),
            (4, "A train leaves Boston at 3 pm and travels to Denver at 60 km per hour until Boston is far behind it"),
            (5, "A train leaves Bern at 5 pm and travels to Rome at 7 km per hour until Oslo is far. At 9 pm and travels to Kyiv at 8 km per hour until Lima is far behind it"),
        ],
        "doc_id long, text string",
    )
    got = {(r.doc_id, r.item_id): r.kind for r in decontamination.leaks(docs, items).collect()}
    assert got == {(1, 1): "reparameterised", (2, 2): "exact", (4, 1): "exact"}
    assert decontamination.leaks(docs, items.limit(0)).count() == 0
    assert decontamination.leaks(docs.limit(0), items).count() == 0
    assert decontamination.leaks(edge_docs, items).count() == 0


def test_leaks_are_judged_by_place(spark):
    ask = "A train leaves {} at {} pm and travels to {} at {} km per hour until {} is far behind it"
    one, two = ask.format("Bern", 5, "Rome", 75, "Bern"), ask.format("Oslo", 9, "Kyiv", 80, "Oslo")
    exact = ask.format("Boston", 3, "Denver", 60, "Boston")
    box = "the red box holds {} coins and the red box holds {} coins and the green cup is empty"
    items = spark.createDataFrame([(1, exact), (2, box.format(3, 5))], "item_id long, text string")
    docs = spark.createDataFrame(
        [
            (1, f"{exact}. {one}."),
            (2, f"{one}. {two}."),
            (3, "So " + box.format(3, 5)),
            (4, "So " + box.format(8, 9)),
            (5, f"{one.replace('and travels', 'and then travels')}. Next. {two}."),
        ],
        "doc_id long, text string",
    )
    got = {(r.doc_id, r.item_id): r.kind for r in decontamination.leaks(docs, items).collect()}
    assert got == {(1, 1): "exact", (2, 1): "reparameterised", (3, 2): "exact", (4, 2): "reparameterised", (5, 1): "reparameterised"}


SHORT_ITEMS = [
    "What is 12 times 7?",
    "Tom has 3 kg, Ann has 5 kg, Bob has 7 kg, Eve has 9 kg",
    "What is the capital of France",
    "Is 3 km 3000 m?",
    "Anna met Paul and Paul met Rita and Rita met Omar near Oslo",
    "12 15 18 21 24 27 30 33 36 39 42",
    "The answer",
]


def test_leaks_of_items_with_few_literals(spark):
    import re

    texts = [f"{a} {t} {b}" for t in SHORT_ITEMS for a, b in (("", ""), ("tell me", "now"), ("So,", "Yes."))]
    texts += [t.upper() for t in SHORT_ITEMS] + ["What is 13 times 7?", "Tom has 4 kg", "What is the capital of Spain", "the answers", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame(list(enumerate(SHORT_ITEMS)), "item_id long, text string")
    plain = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    want = {(i, k) for i, t in enumerate(texts) for k, q in enumerate(SHORT_ITEMS) if plain(q) in plain(t)}
    rows = decontamination.leaks(docs, items).collect()
    assert len({(r.doc_id, r.item_id) for r in rows}) == len(rows)
    assert {(r.doc_id, r.item_id) for r in rows if r.kind == "exact"} == want
    # "What is the capital of Spain" asks item 2 with another name.
    assert {(r.doc_id, r.item_id) for r in rows} - want == {(30, 2)} and texts[30].endswith("Spain")


def test_leaks_of_texts_with_long_runs(spark):
    """A run of names or a list of numbers is read in a loop: with a stack frame a word, it ended the JVM."""
    item = "a miller walks from the old mill to the river and back with 12 apples in his blue basket every day"
    runs = ["See " + "Word " * 20_000, "1" + ",2" * 20_000, "1" + ".2" * 20_000]
    docs = spark.createDataFrame([*enumerate(f"{r} and {item}" for r in runs), (9, runs[0])], "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {(r.doc_id, r.kind) for r in decontamination.leaks(docs, items).collect()}
    assert got == {(i, "exact") for i in range(len(runs))}
    named = spark.createDataFrame([("by Tom Lee, 1,200.5 km",)], "t string").select(decontamination._words("t").alias("w"))
    assert named.first().w == ["by", "‹tom_lee›", "‹1,200.5›", "‹~km›"]


def test_leaks_equal_brute_force(spark, small):
    import re

    docs, texts = small
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    plain = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    want = {(i, b.item_id) for i, t in texts.items() for b in bench.collect() if plain(b.text) in plain(t)}
    got = {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, bench).collect()}
    assert got == want


# --- classifiers -----------------------------------------------------------

QUICK = Training(rows=(200, 200), steps=4000)


def test_unseen_misspellings_score_high():
    f = Features(words=str.split, normal=str.lower, padding=2, distinct=True)
    rng = np.random.default_rng(0)
    clean = [f"w{rng.integers(0, 400)}" for _ in range(4000)]
    texts, labels = [], []
    for k in range(300):
        words = clean[k * 10 : k * 10 + 10]
        labels.append(k % 2)
        texts.append(" ".join(words + (["dreadful", "awfully"] if k % 2 else [])))
    known = {}
    model = fit([f.bag(t, known) for t in texts], np.array(labels), f, Training(steps=6000))
    assert model.score("w1 w2 w3 w4 dreadfull awfuly", {}) > 0.5 > model.score("w1 w2 w3 w4 w5 w6", {})


def test_bag_weights_sum_to_the_share_of_words():
    f = Features(words=str.split, normal=str, padding=6)
    ids, w = f.bag("a b b", {})
    assert len(ids) == len(set(ids.tolist())) and w.sum() == pytest.approx(3 / 9)
    assert [len(x) for x in f.bag("", {})] == [0, 0]


def test_training_holds_its_bags_once(spark, monkeypatch):
    rng = random.Random(5)
    texts = {i: " ".join("%08x" % rng.getrandbits(32) for _ in range(1500)) if i % 9 else "" for i in range(45)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in texts], "doc_id bigint, label int")
    f = Features(words=str.split, normal=str)
    seen = {}

    def held(bags, labels, features, t):
        memory = tracemalloc.get_traced_memory()[1] + pa.total_allocated_bytes() - before
        seen.update(bags=[(i.copy(), w.copy()) for i, w in bags], labels=labels.tolist(), memory=memory)
        return fit(bags[:0], labels[:0], features, t)

    monkeypatch.setattr(subword, "fit", held)
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    try:
        subword.train(docs, labels, f, QUICK)
    finally:
        tracemalloc.stop()
    assert seen["labels"] == [i % 2 for i in texts]
    for (ids, weights), text in zip(seen["bags"], texts.values(), strict=True):
        a, b = f.bag(text, {})
        assert np.array_equal(ids, a) and np.array_equal(weights, b)
    assert seen["memory"] < 1.7 * sum(i.nbytes + w.nbytes for i, w in seen["bags"])


@pytest.mark.parametrize("judge, label, mod, rest", [(toxicity.toxicity, "toxic", 5, 0), (quality.quality, "quality", 3, 1)])
def test_classifier_contract(spark, edge_docs, small, judge, label, mod, rest):
    docs, texts = small
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    got = judge(docs, labels, QUICK).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % mod == rest)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    edge = judge(edge_docs, labels, QUICK).collect()
    assert len(edge) == 11 and all(r.held_out is not None and 0 <= r.score <= 1 for r in edge)
    assert len({r.score for r in edge if r.doc_id in (3, 4, 5)}) == 1
    assert judge(edge_docs.limit(0), labels, QUICK).count() == 0
    assert {r.score for r in judge(edge_docs, labels.limit(0), QUICK).collect()} == {0.5}


def test_held_out_labels_are_never_learnt(spark, small):
    docs, _ = small
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(doc_id AS string)) % 3 = 1 THEN 1 - quality ELSE quality END AS quality")
    a = {r.doc_id: r.score for r in quality.quality(docs, labels, QUICK).collect()}
    b = {r.doc_id: r.score for r in quality.quality(docs, flipped, QUICK).collect()}
    assert a == b


def test_quality_on_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    got = quality.quality_query(spark, d).filter("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.95


def test_edited_sha_is_of_the_whole_text(small):
    docs, texts = small
    got = fingerprints.edited_fingerprints(docs).selectExpr("doc_id", "sha2(encode(text, 'UTF-8'), 256) AS h").collect()
    assert all(r.h == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in got)
