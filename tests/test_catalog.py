"""Catalog sinks, identifier safety, bounded read, export gating, inventory."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import FIXTURES, SF_SMALL
from stratum.operators import medallion
from stratum.sinks import catalog
from stratum.sources import inventory


@pytest.mark.parametrize(
    "bad",
    ["", "1abc", "a-b", "a b", "a;DROP TABLE x", "x`y", "a" * 256, "sch.tbl", None],
)
def test_identifier_refused(bad):
    with pytest.raises(ValueError):
        catalog.validated_identifier("table", bad)


def test_identifier_quoting():
    assert catalog.validated_identifier("t", "gold_$1") == "gold_$1"
    assert catalog.quote_identifier("a`b") == "`a``b`"


def test_create_upsert_and_bounded_read(spark, fixture_source):
    name = catalog.ensure_gold_table(spark, "kpi_db", "region_kpis")
    catalog.ensure_gold_table(spark, "kpi_db", "region_kpis")  # idempotent
    gold = medallion.gold(medallion.silver(medallion.bronze(fixture_source)))
    assert catalog.upsert_into_table(spark, name, gold, ["region"]) == 5
    # a region that disappears keeps its row; a new value updates in place
    changed = gold.filter(F.col("region") != "DE-BERLIN").withColumn("accepted_orders", F.lit(99).cast("bigint"))
    assert catalog.upsert_into_table(spark, name, changed, ["region"]) == 4
    rows = {r.region: r.accepted_orders for r in spark.table(name).collect()}
    assert rows["DE-BERLIN"] == 1 and rows["US-WEST"] == 99 and len(rows) == 5
    assert catalog.upsert_into_table(spark, name, gold.limit(0), ["region"]) == 0
    assert [r.region for r in catalog.bounded_read(spark, name, limit=2).collect()] == ["DE-BERLIN", "JP-TOKYO"]
    assert catalog.bounded_read(spark, name, limit=0).count() == 1
    assert catalog.bounded_read(spark, name, limit=5000).count() == 5


def test_injection_travels_as_a_value(spark):
    name = catalog.ensure_gold_table(spark, "kpi_db", "inj")
    evil = "x'); DROP TABLE kpi_db.inj; --"
    src = spark.createDataFrame([(evil, 1.0, 1, 1, 0, 1)], "region string, gross_revenue_usd double, accepted_orders bigint, completed_orders bigint, pipeline_orders bigint, distinct_customers bigint")
    assert catalog.upsert_into_table(spark, name, src, ["region"]) == 1
    assert spark.table(name).first().region == evil


def test_export_is_gated(spark):
    df = spark.range(3)
    assert catalog.export_jdbc(df, None, "t") is False
    assert catalog.export_jdbc(df, "", "t") is False
    assert catalog.export_jdbc(df.limit(0), "jdbc:nothing://x", "t") is False
    assert catalog.export_jdbc(df, "jdbc:nothing://x", "t") is False  # failure, not an exception


def test_file_inventory_and_preview(spark, scratch):
    files = {"orders": os.path.join(FIXTURES, "source_orders.csv"), "absent": os.path.join(scratch, "nope.csv")}
    got = {r.source: (r.present, r.row_count) for r in inventory.file_inventory(spark, files).collect()}
    assert got == {"orders": (True, 12), "absent": (False, 0)}
    assert inventory.file_rows(spark, files["absent"]) == 0
    prev = inventory.csv_preview(spark, files["orders"], 2)
    assert [p["order_id"] for p in prev] == ["O-1001", "O-1002"]
    assert inventory.csv_preview(spark, files["absent"]) == []
    # NULLs are dropped from a JSON rendering
    row = inventory.preview_json(spark.createDataFrame([("a", None)], "x string, y string")).first()
    assert row.record == '{"x":"a"}'


def test_source_inventory_counts(spark):
    got = {r.source: r.row_count for r in inventory.source_inventory(spark, SF_SMALL).collect()}
    assert got["region"] == 5 and got["nation"] == 25 and len(got) == 14


def test_json_report_writer(spark, scratch):
    p = os.path.join(scratch, "deep", "dir", "report.json")
    catalog.write_json_report(spark, p, {"a": 2})
    catalog.write_json_report(spark, "file://" + p, {"a": 1})
    assert open(p, encoding="utf-8").read() == '{\n  "a": 1\n}'


def test_merge_statement():
    got = catalog.merge_statement(["db", "gold"], ["db", "gold_staging"], ["region"], ["region", "n", "loaded_at"])
    assert got.splitlines() == [
        "MERGE INTO db.gold AS t USING db.gold_staging AS s ON t.region = s.region",
        "WHEN MATCHED THEN UPDATE SET n = s.n, loaded_at = s.loaded_at",
        "WHEN NOT MATCHED THEN INSERT (region, n, loaded_at) VALUES (s.region, s.n, s.loaded_at)",
    ]
    with pytest.raises(ValueError):
        catalog.merge_statement(["db", "gold; drop"], ["s"], ["region"], ["n"])
    with pytest.raises(ValueError):
        catalog.merge_statement(["gold"], ["s"], ["region"], ["n = 1"])


def test_pack_summary(spark, scratch):
    files = {
        "source_row_count": (os.path.join(FIXTURES, "source_orders.csv"), "csv"),
        "quality_rule_count": (os.path.join(FIXTURES, "quality_rules.json"), "json"),
        "external_file_count": (os.path.join(scratch, "none.csv"), "csv"),
    }
    got = {r.metric: r.value for r in inventory.pack_summary(spark, files).collect()}
    assert got == {"source_row_count": 12, "quality_rule_count": 4, "external_file_count": 0}


def test_dirty_order_source_has_every_violation(spark):
    from stratum.sources.orders import order_source

    src = order_source(spark, SF_SMALL)
    c = src.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("customer_id").isNull()).alias("no_customer"),
        F.count_if(F.col("region").isNull()).alias("no_region"),
        F.count_if(F.col("amount") <= 0).alias("non_positive"),
        F.count_distinct("order_id").alias("orders"),
        F.count_if(F.col("currency") != "USD").alias("not_usd"),
        F.count_if(~F.col("order_id").startswith("O-")).alias("bad_prefix"),
        F.count_distinct("source_rank").alias("ranks"),
    ).first()
    assert c.rows == c.ranks == 1500  # one row per order row, unique rank
    assert c.no_customer > 0 and c.no_region > 0 and c.non_positive > 0
    assert c.orders < c.rows  # revisions: some orders have two versions
    assert c.not_usd == 0 and c.bad_prefix == 0


def test_records_are_json(spark):
    import datetime as dt
    from decimal import Decimal

    from stratum.operators.reports import records

    rows = [(dt.datetime(2026, 3, 14, 9, 0), Decimal("1.50"), "x", None), (dt.datetime(2026, 3, 14, 9, 0, 0, 5000), None, "", 3)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, d decimal(18,2), s string, n int")
    assert records(df) == [
        {"t": "2026-03-14T09:00:00", "d": 1.5, "s": "x", "n": None},
        {"t": "2026-03-14T09:00:00.005", "d": None, "s": "", "n": 3},
    ]


def test_rules_round_trip_and_named_sources(spark, scratch):
    from stratum.functions.rules import ORDER_RULES, LATEST_RULE, load_rules, rules_to_json
    from stratum.sources.tables import data_files, register_views

    p = os.path.join(scratch, "rules.json")
    with open(p, "w", encoding="utf-8") as fh:
        fh.write(rules_to_json([*ORDER_RULES, LATEST_RULE]))
    back = load_rules(spark, p)
    assert [(r.name, r.label, r.fails) for r in back] == [(r.name, r.label, r.fails) for r in (*ORDER_RULES, LATEST_RULE)]
    files = data_files(SF_SMALL)
    assert set(files) >= {"orders", "lineitem", "events"} and files["orders"].endswith("orders.parquet")
    register_views(spark, SF_SMALL, ("region",))
    assert spark.sql("SELECT count(*) AS n FROM region").first().n == 5


def test_custom_rule_predicate_survives_config(spark, scratch):
    from stratum.functions.rules import Rule, load_rules, rules_to_json

    custom = [Rule("small_amount", "too_small", "amount < 10", description="tiny orders")]
    p = os.path.join(scratch, "custom.json")
    with open(p, "w", encoding="utf-8") as fh:
        fh.write(rules_to_json(custom))
    (back,) = load_rules(spark, p)
    assert (back.name, back.label, back.fails, back.description) == ("small_amount", "too_small", "amount < 10", "tiny orders")
