"""The twelve-row order fixture and its known answers."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import FIXTURES
from stratum.functions.rules import load_rules
from stratum.operators import checks, medallion, reports

RUN_TS = "2026-03-16 14:14:28"


@pytest.fixture(scope="module")
def bronze(fixture_source):
    return medallion.bronze(fixture_source, RUN_TS)


@pytest.fixture(scope="module")
def staged(bronze):
    return medallion.stage(bronze)


def test_layer_counts(bronze, staged):
    silver, rejected = medallion.split(staged)
    gold = medallion.gold(medallion.silver(bronze))
    assert bronze.count() == 12
    assert silver.count() == 8
    assert rejected.count() == 4
    assert gold.count() == 5
    m = reports.run_metrics(staged).first()
    assert (m.source_rows, m.bronze_rows, m.silver_rows, m.rejected_rows, m.gold_rows) == (12, 12, 8, 4, 5)
    assert m.quality_pass_rate_pct == 66.67


def test_expectations(staged):
    got = {r.name: (r.passed, r.failed) for r in reports.expectations(staged).collect()}
    assert got == {
        "customer_present": (11, 1),
        "region_present": (11, 1),
        "positive_amount": (11, 1),
        "latest_order_record": (8, 1),
    }


def test_rejected_rows(staged):
    rejected = medallion.split(staged)[1]
    rows = {(r.order_id, r.rejection_reason, r.order_ts) for r in rejected.collect()}
    assert rows == {
        ("O-1002", "stale_duplicate", dt.datetime(2026, 3, 14, 9, 20)),
        ("O-1008", "missing_customer", dt.datetime(2026, 3, 14, 11, 0)),
        ("O-1009", "missing_region", dt.datetime(2026, 3, 14, 11, 12)),
        ("O-1010", "non_positive_amount", dt.datetime(2026, 3, 14, 11, 20)),
    }


def test_gold_values(bronze):
    gold = medallion.gold(medallion.silver(bronze))
    got = {
        r.region: (r.gross_revenue_usd, r.accepted_orders, r.completed_orders, r.pipeline_orders, r.distinct_customers)
        for r in gold.collect()
    }
    assert got == {
        "DE-BERLIN": (410.75, 1, 1, 0, 1),
        "JP-TOKYO": (510.25, 1, 1, 0, 1),
        "KR-BUSAN": (220.0, 1, 1, 0, 1),
        "KR-SEOUL": (440.9, 2, 1, 1, 2),
        "US-WEST": (510.35, 3, 1, 1, 3),
    }


def test_silver_equals_staged_split(bronze, staged):
    fast = medallion.silver(bronze)
    slow = medallion.silver_columns(medallion.split(staged)[0])
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect()))


def test_timestamps_stay_utc(bronze):
    first = bronze.filter(F.col("order_id") == "O-1001").first()
    assert first.order_ts == dt.datetime(2026, 3, 14, 9, 0)
    assert first.ingested_at == dt.datetime(2026, 3, 16, 14, 14, 28)


def test_blank_to_null_only_for_customer_and_region(bronze):
    row = bronze.filter(F.col("order_id") == "O-1008").first()
    assert row.customer_id is None
    row = bronze.filter(F.col("order_id") == "O-1009").first()
    assert row.region is None


def test_previews_and_reasons(bronze, staged):
    reasons = [r.rejection_reason for r in reports.rejection_reasons(staged).collect()]
    assert reasons == ["missing_customer", "missing_region", "non_positive_amount", "stale_duplicate"]
    prev = reports.preview(bronze, ["order_id", "source_rank"], 5).collect()
    assert [r.order_id for r in prev] == ["O-1001", "O-1002", "O-1002", "O-1003", "O-1004"]
    # ties on order_id are broken by arrival order
    assert prev[1].order_ts < prev[2].order_ts
    gold_prev = reports.preview(medallion.gold(medallion.silver(bronze)), ["region"], 10).collect()
    assert [r.region for r in gold_prev] == ["DE-BERLIN", "JP-TOKYO", "KR-BUSAN", "KR-SEOUL", "US-WEST"]


def test_pipeline_summary_reports_true_counts(staged):
    s = reports.pipeline_summary(staged).first()
    assert (s.bronze_rows, s.silver_rows, s.gold_rows, s.rejected_rows) == (12, 8, 5, 4)
    assert s.total_expectations == 4
    assert s.expectations_met == 0  # every rule rejects one row in the fixture


def test_validation_cases(bronze, staged):
    silver = medallion.silver(bronze)
    assert [r.violations for r in checks.validation_cases(silver, bronze).collect()] == [0, 0, 0, 0]
    # A broken silver is seen: all of bronze, and a stale version beside the newest.
    everything = checks.validation_cases(bronze, bronze).collect()
    assert [r.status for r in everything] == ["fail"] * 4 and [r.violations for r in everything][:3] == [1, 1, 1]
    stale = staged.filter("rejection_reason = 'stale_duplicate'").select(*bronze.columns)
    kept = checks.validation_cases(silver.select(*bronze.columns).unionAll(stale), bronze).collect()
    assert [r.status for r in kept] == ["pass", "pass", "pass", "fail"]


def test_cases_from_config(spark, bronze, scratch):
    p = os.path.join(scratch, "cases.json")
    with open(p, "w", encoding="utf-8") as fh:
        fh.write('[{"id": "A", "focus": "f", "assertion": "a", "check": "customer_present"}, {"id": "B", "focus": "g", "assertion": "b", "expected_status": "fail", "check": "region_present"}]')
    cases = checks.load_cases(spark, p)
    rows = checks.validation_cases(medallion.silver(bronze), bronze, cases=cases).collect()
    assert [(r.case_id, r.focus, r.expected_status, r.status) for r in rows] == [("A", "f", "pass", "pass"), ("B", "g", "fail", "pass")]


def test_reconciliation(bronze, staged):
    silver, rejected = medallion.silver(bronze), medallion.split(staged)[1]
    gold = medallion.gold(silver)
    assert all(r.ok for r in checks.reconciliation(bronze, silver, rejected, gold).collect())

    def failing(*layers):
        return {r.check_name for r in checks.reconciliation(*layers).collect() if not r.ok}

    lost = silver.filter("order_id != 'ord-0001'").limit(silver.count() - 1)
    assert "gold_accepted_equals_silver" in failing(bronze, lost, rejected, gold)
    assert "one_silver_row_per_key" in failing(bronze, silver.unionAll(silver), rejected, gold)
    assert "bronze_equals_silver_plus_rejected" in failing(bronze, silver, rejected.limit(1), gold)


def test_rules_from_json_config(spark, bronze):
    rules = load_rules(spark, os.path.join(FIXTURES, "quality_rules.json"))
    assert [r.label for r in rules] == ["missing_customer", "missing_region", "non_positive_amount", "stale_duplicate"]
    field_rules = tuple(r for r in rules if r.fails is not None)
    spec = medallion.StageSpec(rules=field_rules)
    assert medallion.silver(bronze, spec).count() == 8


def test_preview_records_render_json_values(bronze):
    recs = reports.records(reports.preview(bronze, ["order_id", "source_rank"], 2))
    assert recs[0]["order_ts"] == "2026-03-14T09:00:00"
    assert recs[0]["amount"] == 180.5 and isinstance(recs[0]["amount"], float)
    assert len(recs) == 2
