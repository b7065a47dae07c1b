"""The registered queries against their SQL, and the pipeline against its operators."""

import duckdb
import pytest
from conftest import SF_SMALL
from edge_rows import edge_documents

import corpus_pipeline
from stratum.llm import decontamination, minhash, packing
from stratum.llm.queries import QUERIES, oracle_sql


@pytest.fixture(scope="module")
def edge_docs(spark):
    return edge_documents(spark)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    rel = con.sql(oracle_sql()[name])
    df = QUERIES[name](spark, SF_SMALL)
    assert sorted(df.columns) == sorted(rel.columns)
    df = df.select(*rel.columns)
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, rel.fetchall()))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    before, kept = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF_SMALL)
        rows = after.collect()
        assert after.columns == list(corpus_pipeline.COLUMNS)
        kept.append({r.doc_id for r in rows})
        before = spark.createDataFrame(rows, docs.schema)
    for a, b in zip([{r.doc_id for r in docs.collect()}, *kept], kept):
        assert b <= a
    assert minhash.near_duplicates(before, 5).filter("NOT kept").count() == 0
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    assert decontamination.leaks(before, bench).count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SF_SMALL)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == kept[-1]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_dedup", "decontamination", "packing"]
    assert packed.columns == packing.pack(before).columns


def test_pipeline_edges(spark, edge_docs):
    docs = edge_docs.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "cast(length(text) AS bigint) AS n_chars", "n")
    for name, stage in corpus_pipeline.STAGES:
        for part in (docs, docs.limit(0)):
            rows = stage(spark, part, SF_SMALL).collect()
            if name == "near_dedup" and part is docs:
                ids = [r.doc_id for r in rows]
                assert sorted(i for i in ids if i) == [1, 3, 4, 5, 6, 8, 10] and ids.count(None) == 1


def staged(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


def test_near_dedup_keeps_every_text(spark):
    a, b, c = ("the quick brown fox jumps over the lazy dog %d times" % k * 3 for k in (1, 22, 333))
    docs = staged(spark, [(1, a), (2, a), (2, b), (3, c), (3, c), (4, None), (4, ""), (None, a), (5, b)])
    rows = [(r.doc_id, r.text) for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, SF_SMALL).collect()]
    assert {t for _, t in rows} == {a, b, c, None, ""}
    named = [r for r in rows if r[0] is not None]
    assert sorted(named, key=repr) == sorted({*named}, key=repr)
    assert sum(t == a for _, t in named) == 1 and sum(t == b for _, t in named) == 1


@pytest.mark.parametrize("stage", ["toxicity", "quality"])
def test_nothing_learnt_drops_nothing(spark, stage):
    docs = staged(spark, [(10**12 + i, t) for i, t in enumerate(["a b c", None, "", "x " * 5000])] + [(None, "y")])
    kept = dict(corpus_pipeline.STAGES)[stage](spark, docs, SF_SMALL)
    assert kept.count() == 5


def test_stages_decide_edge_rows(spark, edge_docs):
    """Null, empty, long and repeated rows in every filtering stage; none has a reason to go but a near copy."""
    docs = edge_docs.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "cast(length(text) AS bigint) AS n_chars")
    stages = dict(corpus_pipeline.STAGES)
    assert stages["decontamination"](spark, docs, SF_SMALL).exceptAll(docs).count() == 0
    assert stages["decontamination"](spark, docs, SF_SMALL).count() == docs.count()
    kept = stages["toxicity"](spark, docs, SF_SMALL)
    assert kept.exceptAll(docs).count() == 0
    pieces = stages["packing"](spark, docs, SF_SMALL).groupBy("doc_id").count().collect()
    assert len(pieces) == docs.select("doc_id").distinct().count()
