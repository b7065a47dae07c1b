"""Keyed upsert, versioned snapshots, time travel, diffs, pipeline run."""

import os

import pytest
from pyspark.sql import functions as F

from stratum.operators.upsert import DuplicateKeyError, keyed_upsert, upsert_changes
from stratum.plans.pipeline import quality_report_json, read_published, run_pipeline, table_registry, validation_report
from stratum.sinks import snapshots

KPI = "region string, gross_revenue_usd double, accepted_orders bigint, completed_orders bigint, pipeline_orders bigint, distinct_customers bigint"
TARGET = KPI + ", loaded_at timestamp_ntz"


def target(spark):
    import datetime as dt

    t0 = dt.datetime(2026, 1, 1)
    return spark.createDataFrame(
        [("KR-SEOUL", 1.0, 1, 1, 0, 1, t0), ("US-WEST", 2.0, 2, 1, 1, 2, t0), ("OLD", 9.0, 9, 9, 0, 9, t0)], TARGET
    )


def source(spark):
    return spark.createDataFrame(
        [("KR-SEOUL", 440.9, 2, 1, 1, 2), ("US-WEST", 510.35, 3, 1, 1, 3), ("JP-TOKYO", 510.25, 1, 1, 0, 1)], KPI
    )


def stamp():
    return F.lit("2026-02-02 00:00:00").cast("timestamp_ntz")


def test_upsert_updates_inserts_keeps(spark):
    out = {r.region: r for r in keyed_upsert(target(spark), source(spark), ["region"], stamp=stamp()).collect()}
    assert set(out) == {"KR-SEOUL", "US-WEST", "JP-TOKYO", "OLD"}
    assert out["KR-SEOUL"].gross_revenue_usd == 440.9
    assert out["OLD"].gross_revenue_usd == 9.0  # never deleted
    assert str(out["OLD"].loaded_at) == "2026-01-01 00:00:00"
    assert str(out["JP-TOKYO"].loaded_at) == "2026-02-02 00:00:00"


def test_upsert_twice_is_once(spark):
    once = keyed_upsert(target(spark), source(spark), ["region"], stamp=stamp())
    twice = keyed_upsert(once, source(spark), ["region"], stamp=stamp())
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_upsert_refuses_duplicate_keys(spark):
    dup = source(spark).unionByName(source(spark).limit(1))
    with pytest.raises(DuplicateKeyError):
        keyed_upsert(target(spark), dup, ["region"])


def test_upsert_null_key_never_matches(spark):
    src = spark.createDataFrame([(None, 1.0, 1, 1, 1, 1)], KPI)
    tgt = keyed_upsert(spark.createDataFrame([], TARGET), src, ["region"], stamp=stamp())
    again = keyed_upsert(tgt, src, ["region"], stamp=stamp())
    assert again.count() == 2  # as MERGE: a NULL key inserts each time


def test_upsert_empty_source_changes_nothing(spark):
    out = keyed_upsert(target(spark), spark.createDataFrame([], KPI), ["region"], stamp=stamp())
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, target(spark).collect()))


def test_upsert_changes(spark):
    got = {r.region: r.change for r in upsert_changes(target(spark), source(spark), ["region"]).collect()}
    assert got == {"KR-SEOUL": "update", "US-WEST": "update", "JP-TOKYO": "insert"}


def test_versions_and_time_travel(spark, scratch):
    assert snapshots.latest_version(spark, scratch, "gold") is None
    for i in range(3):
        v = snapshots.write_snapshot(spark.range(i + 1), scratch, "gold")
        assert v == i
    assert snapshots.latest_version(spark, scratch, "gold") == 2
    assert snapshots.read_layer(spark, scratch, "GOLD").count() == 3
    assert snapshots.read_layer(spark, scratch, "gold", version=0).count() == 1
    with pytest.raises(FileNotFoundError):
        snapshots.read_layer(spark, scratch, "gold", version=7)
    with pytest.raises(FileNotFoundError):
        snapshots.read_layer(spark, scratch, "nope")


def test_uncommitted_version_is_invisible(spark, scratch):
    snapshots.write_snapshot(spark.range(2), scratch, "t")
    # data written without a log row (a crashed run) is never read
    spark.range(5).write.parquet(os.path.join(scratch, "t", "data", "v=1"))
    assert snapshots.latest_version(spark, scratch, "t") == 0
    assert snapshots.read_layer(spark, scratch, "t").count() == 2
    assert snapshots.write_snapshot(spark.range(7), scratch, "t") == 1
    assert snapshots.read_layer(spark, scratch, "t").count() == 7


def test_snapshot_diff(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    new = spark.createDataFrame([("a", 1), ("b", 5), ("d", 4)], "k string, v int")
    got = {r.k: r.change for r in snapshots.snapshot_diff(old, new, ["k"]).collect()}
    assert got == {"b": "changed", "c": "removed", "d": "added"}


def test_pipeline_run_publishes_layers(spark, fixture_source, scratch):
    res = run_pipeline(fixture_source, scratch, ingested_at="2026-03-16 14:14:28")
    assert res.metrics["silver_rows"] == 8 and res.metrics["rejected_rows"] == 4
    assert read_published(spark, scratch, "bronze").count() == 12
    assert read_published(spark, scratch, "Silver").count() == 8
    assert read_published(spark, scratch, "rejected").count() == 4
    assert read_published(spark, scratch, "gold").count() == 5
    assert {r.status for r in validation_report(spark, scratch).collect()} == {"pass"}
    assert '"qualityPassRatePct": 66.67' in quality_report_json(res)
    res2 = run_pipeline(fixture_source, scratch, ingested_at="2026-03-17 00:00:00")
    assert res2.versions == {"bronze": 1, "staged": 1, "gold": 1}
    assert read_published(spark, scratch, "gold", version=0).count() == 5
    with pytest.raises(KeyError):
        read_published(spark, scratch, "platinum")
    reg = {r.table_name: (r.version, r.rows) for r in table_registry(spark, scratch).collect()}
    assert reg == {"bronze": (1, 12), "staged": (1, 12), "gold": (1, 5)}


def test_pipeline_keeps_malformed_records(spark, scratch):
    from conftest import FIXTURES
    from stratum.sources.orders import read_order_csv_quarantined

    p = os.path.join(scratch, "in.csv")
    with open(os.path.join(FIXTURES, "source_orders.csv")) as src, open(p, "w") as out:
        out.write(src.read())
        out.write("O-2000,C-1,KR-SEOUL,web,completed,n/a,USD,2026-03-14T13:00:00Z\n")
    rows, bad = read_order_csv_quarantined(spark, p)
    res = run_pipeline(rows, os.path.join(scratch, "lake"), malformed=bad)
    assert res.versions["malformed"] == 0 and res.metrics["bronze_rows"] == 12
    assert read_published(spark, os.path.join(scratch, "lake"), "malformed").count() == 1


def test_published_layers_equal_the_queries(spark, scratch):
    from conftest import SF_SMALL
    from stratum.plans import catalog
    from stratum.sources.orders import order_source

    root = os.path.join(scratch, "lake")
    res = run_pipeline(order_source(spark, SF_SMALL), root, ingested_at=catalog.RUN_TS)
    gold_q = catalog.gold_region_kpis(spark, SF_SMALL)
    gold_p = read_published(spark, root, "gold")
    assert gold_p.exceptAll(gold_q).count() == 0 and gold_q.exceptAll(gold_p).count() == 0
    silver_q = catalog.silver_orders(spark, SF_SMALL)
    silver_p = catalog.presentable(read_published(spark, root, "silver"))
    assert silver_p.columns == silver_q.columns
    assert silver_p.exceptAll(silver_q).count() == 0 and silver_q.exceptAll(silver_p).count() == 0
    metrics = catalog.run_metrics(spark, SF_SMALL).first().asDict()
    assert res.metrics == metrics
    exp = [r.asDict() for r in catalog.expectations_report(spark, SF_SMALL).collect()]
    assert res.expectations == exp
    assert res.reasons == [r.rejection_reason for r in catalog.rejection_reasons(spark, SF_SMALL).collect()]


def test_command_line_run_writes_reports(spark, scratch):
    import json

    from conftest import FIXTURES
    from stratum.__main__ import main

    out = os.path.join(scratch, "lake")
    assert main(["run", "--csv", os.path.join(FIXTURES, "source_orders.csv"), "--out", out]) == 0
    q = json.load(open(os.path.join(out, "reports", "quality-report.json"), encoding="utf-8"))
    assert q["summary"] == {"acceptedRows": 8, "failedRows": 4, "qualityPassRatePct": 66.67}
    assert [e["failed"] for e in q["expectations"]] == [1, 1, 1, 1]
    assert [r["rejection_reason"] for r in q["rejectedPreview"]] == [
        "stale_duplicate", "missing_customer", "missing_region", "non_positive_amount"
    ]
    gold = json.load(open(os.path.join(out, "reports", "gold-preview.json"), encoding="utf-8"))
    assert [r["region"] for r in gold["rows"]] == ["DE-BERLIN", "JP-TOKYO", "KR-BUSAN", "KR-SEOUL", "US-WEST"]
    bronze = json.load(open(os.path.join(out, "reports", "bronze-preview.json"), encoding="utf-8"))
    assert len(bronze["rows"]) == 5 and bronze["rows"][0]["order_ts"] == "2026-03-14T09:00:00"
    summary = json.load(open(os.path.join(out, "reports", "run-summary.json"), encoding="utf-8"))
    assert summary["summary"]["goldRows"] == 5 and len(summary["tables"]) == 3
    # reports for the latest version can be rewritten without a run
    assert main(["reports", "--out", out, "--reports", os.path.join(scratch, "again")]) == 0
    q2 = json.load(open(os.path.join(scratch, "again", "quality-report.json"), encoding="utf-8"))
    assert q2["summary"] == q["summary"]
