"""Edge rows the contract must get right (masking, NULLs, NaN, ties, skew)."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.operators import medallion, reports

SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("amount", T.DecimalType(18, 2)),
        T.StructField("currency", T.StringType()),
        T.StructField("order_ts", T.TimestampNTZType()),
        T.StructField("source_rank", T.LongType()),
    ]
)


def ts(h, m=0):
    return dt.datetime(2026, 3, 14, h, m)


def rows(*specs):
    """(order_id, customer, region, amount, ts, rank) -> full source rows."""
    out = []
    for oid, cust, reg, amt, t, rank in specs:
        amount = None if amt is None else Decimal(str(amt))
        out.append((oid, cust, reg, "web", "completed", amount, "USD", t, rank))
    return out


def staged_of(spark, specs):
    src = spark.createDataFrame(rows(*specs), SCHEMA)
    b = medallion.bronze(src, "2026-01-01 00:00:00")
    return b, medallion.stage(b)


def reasons(staged):
    return {(r.order_id, r.source_rank): r.rejection_reason for r in staged.collect()}


def test_masking_newest_invalid_hides_older_valid(spark):
    b, st = staged_of(
        spark,
        [
            ("A", "C1", "R1", 10, ts(9), 1),  # older, valid
            ("A", None, "R1", 10, ts(10), 2),  # newest, fails a rule
        ],
    )
    assert reasons(st) == {("A", 1): "stale_duplicate", ("A", 2): "missing_customer"}
    assert medallion.silver(b).count() == 0
    masked = reports.masked_keys(st).collect()
    assert [(m.order_id, m.newest_issue, m.valid_older_versions) for m in masked] == [("A", "missing_customer", 1)]


def test_null_and_nan_amounts_pass(spark):
    src = spark.createDataFrame(rows(("A", "C", "R", None, ts(9), 1)), SCHEMA)
    b = medallion.bronze(src)
    st = medallion.stage(b)
    assert reasons(st) == {("A", 1): None}
    exp = {r.name: (r.passed, r.failed) for r in reports.expectations(st).collect()}
    assert exp["positive_amount"] == (0, 0)
    # NaN: compared as larger than any number in Spark, so it passes too
    nan_src = spark.createDataFrame([("B", "C", "R", float("nan"))], "order_id string, customer_id string, region string, amount double")
    from stratum.functions.rules import ORDER_RULES, first_match

    assert nan_src.select(first_match(ORDER_RULES).alias("x")).first().x is None


def test_first_match_wins(spark):
    _, st = staged_of(spark, [("A", None, None, -5, ts(9), 1)])
    assert reasons(st) == {("A", 1): "missing_customer"}


def test_equal_ts_tie_broken_by_rank(spark):
    b, st = staged_of(spark, [("A", "C1", "R", 1, ts(9), 5), ("A", "C2", "R", 2, ts(9), 7)])
    assert reasons(st) == {("A", 5): "stale_duplicate", ("A", 7): None}
    assert medallion.silver(b).first().customer_id == "C2"


def test_null_and_empty_order_ids_are_separate_groups(spark):
    b, st = staged_of(
        spark,
        [
            (None, "C", "R", 1, ts(9), 1),
            (None, "C", "R", 1, ts(10), 2),
            ("", "C", "R", 1, ts(8), 3),
            ("", "C", "R", 1, ts(7), 4),
        ],
    )
    assert reasons(st) == {(None, 1): "stale_duplicate", (None, 2): None, ("", 3): None, ("", 4): "stale_duplicate"}
    assert medallion.silver(b).count() == 2


def test_null_ts_sorts_last(spark):
    b, st = staged_of(spark, [("A", "C", "R", 1, None, 9), ("A", "C", "R", 1, ts(9), 1)])
    assert reasons(st) == {("A", 9): "stale_duplicate", ("A", 1): None}


def test_unparsable_ts_becomes_null(spark, scratch):
    import os

    from stratum.sources.orders import read_order_csv

    p = os.path.join(scratch, "o.csv")
    with open(p, "w") as fh:
        fh.write("order_id,customer_id,region,channel,status,amount,currency,order_ts\n")
        fh.write("A,C,R,web,completed,1.00,USD,not-a-time\n")
        fh.write("A,C,R,web,completed,2.00,USD,2026-03-14T09:00:00Z\n")
    src = read_order_csv(spark, p)
    st = medallion.stage(medallion.bronze(src))
    got = {r.amount: r.rejection_reason for r in st.collect()}
    assert got == {Decimal("1.00"): "stale_duplicate", Decimal("2.00"): None}


def test_empty_input(spark):
    src = spark.createDataFrame([], SCHEMA)
    b = medallion.bronze(src)
    st = medallion.stage(b)
    m = reports.run_metrics(st).first()
    assert (m.bronze_rows, m.silver_rows, m.gold_rows) == (0, 0, 0)
    assert m.quality_pass_rate_pct is None
    assert medallion.gold(medallion.silver(b)).count() == 0


def test_more_than_ten_regions(spark):
    specs = [(f"O{i}", f"C{i}", f"R{i:02d}", 1, ts(9), i) for i in range(14)]
    b, _ = staged_of(spark, specs)
    gold = medallion.gold(medallion.silver(b))
    assert gold.count() == 14
    assert reports.preview(gold, ["region"], 10).count() == 10


def test_same_result_for_any_partitioning(spark):
    rnd = random.Random(7)
    specs = []
    for i in range(400):
        oid = f"O{rnd.randrange(120)}"
        cust = None if rnd.random() < 0.05 else f"C{rnd.randrange(50)}"
        reg = None if rnd.random() < 0.05 else f"R{rnd.randrange(4)}"
        amt = rnd.choice([-3, 0, 5, 10.5, 20])
        t = None if rnd.random() < 0.05 else ts(rnd.randrange(24), rnd.randrange(60))
        specs.append((oid, cust, reg, amt, t, i))
    src = spark.createDataFrame(rows(*specs), SCHEMA)
    results = []
    for n in (1, 2, 8):
        b = medallion.bronze(src.repartition(n), "2026-01-01 00:00:00")
        st = medallion.stage(b)
        results.append(
            (
                sorted(reasons(st).items(), key=repr),
                sorted(map(tuple, medallion.gold(medallion.silver(b)).collect()), key=repr),
            )
        )
    assert results[0] == results[1] == results[2]


def brute_force(specs):
    """Pure-Python reading of the contract, for comparison."""
    by_key = {}
    for s in specs:
        by_key.setdefault(s[0], []).append(s)
    out = {}
    for key, versions in by_key.items():
        newest = max(versions, key=lambda s: (s[4] is not None, s[4] or dt.datetime.min, s[5]))
        for oid, cust, reg, amt, t, rank in versions:
            if cust is None:
                r = "missing_customer"
            elif reg is None:
                r = "missing_region"
            elif amt is not None and amt <= 0:
                r = "non_positive_amount"
            elif rank != newest[5]:
                r = "stale_duplicate"
            else:
                r = None
            out[(oid, rank)] = r
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    specs = []
    for i in range(300):
        oid = None if rnd.random() < 0.02 else f"O{rnd.randrange(80)}"
        cust = None if rnd.random() < 0.1 else f"C{rnd.randrange(30)}"
        reg = None if rnd.random() < 0.1 else f"R{rnd.randrange(3)}"
        amt = None if rnd.random() < 0.05 else rnd.choice([-1, 0, 3, 7.25])
        t = None if rnd.random() < 0.1 else ts(rnd.randrange(3), rnd.randrange(2))
        specs.append((oid, cust, reg, amt, t, rnd.randrange(10**9) * 1000 + i))
    _, st = staged_of(spark, specs)
    assert reasons(st) == brute_force(specs)


def test_hot_key_holding_a_third_of_rows(spark):
    """One key with a third of all rows: results stay whole and exact."""
    hot = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("K"), F.col("id").cast("string"))).alias("order_id"),
        F.lit("C").alias("customer_id"),
        F.lit("R").alias("region"),
        F.lit("web").alias("channel"),
        F.lit("completed").alias("status"),
        F.lit(1).cast("decimal(18,2)").alias("amount"),
        F.lit("USD").alias("currency"),
        F.lit("2026-03-14 09:00:00").cast("timestamp_ntz").alias("order_ts"),
        F.col("id").alias("source_rank"),
    )
    b = medallion.bronze(hot.repartition(8), "2026-01-01 00:00:00")
    st = medallion.stage(b)
    m = reports.run_metrics(st).first()
    assert m.bronze_rows == 30000
    assert m.silver_rows == 20000 + 1
    newest_hot = medallion.silver(b).filter(F.col("order_id") == "HOT").first()
    assert newest_hot.source_rank == 29997


def test_csv_rank_column_is_used(spark, scratch):
    import os

    from stratum.sources.orders import read_order_csv

    p = os.path.join(scratch, "ranked.csv")
    with open(p, "w") as fh:
        fh.write("order_id,customer_id,region,channel,status,amount,currency,order_ts,seq\n")
        fh.write("A,C,R,web,completed,1.00,USD,2026-03-14T09:00:00Z,20\n")
        fh.write("A,C,R,web,completed,2.00,USD,2026-03-14T09:00:00Z,10\n")
    src = read_order_csv(spark, p, rank_column="seq")
    silver = medallion.silver(medallion.bronze(src)).collect()
    assert [(r.source_rank, r.amount) for r in silver] == [(20, Decimal("1.00"))]


def test_version_rank_matches_row_number_with_a_hot_key(spark):
    from pyspark.sql import Window

    from stratum.operators.dedup import version_rank

    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT"))
        .when(F.col("id") % 101 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("K"), (F.col("id") % 3000).cast("string")))
        .alias("order_id"),
        F.when(F.col("id") % 7 == 0, F.lit(None).cast("timestamp_ntz"))
        .otherwise((F.col("id") % 500).cast("timestamp").cast("timestamp_ntz"))
        .alias("order_ts"),
        F.col("id").alias("source_rank"),
    )
    got = version_rank(df, ["order_id"], ["order_ts", "source_rank"], partitions=11)
    w = Window.partitionBy("order_id").orderBy(F.col("order_ts").desc_nulls_last(), F.col("source_rank").desc())
    want = df.withColumn("row_rank", F.row_number().over(w).cast("int"))
    assert got.count() == 20000
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    again = version_rank(df, ["order_id"], ["order_ts", "source_rank"])
    assert again.exceptAll(want).count() == 0 and want.exceptAll(again).count() == 0


def test_malformed_records_are_quarantined(spark, scratch):
    import os

    from stratum.sources.orders import read_order_csv, read_order_csv_quarantined

    p = os.path.join(scratch, "dirty.csv")
    with open(p, "w") as fh:
        fh.write("order_id,customer_id,region,channel,status,amount,currency,order_ts\n")
        fh.write("A,C,R,web,completed,1.00,USD,2026-03-14T09:00:00Z\n")
        fh.write("B,C,R,web,completed,lots,USD,2026-03-14T09:00:00Z\n")
        fh.write("C,C,R,web,completed,2.00,USD,2026-03-14T09:00:00Z,extra,fields\n")
        fh.write("D,,R,web,completed,3.00,USD,2026-03-14T09:00:00Z\n")
    rows, bad = read_order_csv_quarantined(spark, p)
    assert sorted(r.order_id for r in rows.collect()) == ["A", "D"]
    got = {r.raw_record.split(",")[0]: r.rejection_reason for r in bad.collect()}
    assert got == {"B": "malformed_record", "C": "malformed_record"}
    # the default scan keeps the contract: a malformed amount stops the run
    with pytest.raises(Exception):
        read_order_csv(spark, p).collect()


def test_hot_null_order_id(spark):
    hot = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("K"), F.col("id").cast("string"))).alias("order_id"),
        F.lit("C").alias("customer_id"),
        F.lit("R").alias("region"),
        F.lit("web").alias("channel"),
        F.lit("completed").alias("status"),
        F.lit(1).cast("decimal(18,2)").alias("amount"),
        F.lit("USD").alias("currency"),
        F.lit("2026-03-14 09:00:00").cast("timestamp_ntz").alias("order_ts"),
        F.col("id").alias("source_rank"),
    )
    b = medallion.bronze(hot.repartition(8), "2026-01-01 00:00:00")
    m = reports.run_metrics(medallion.stage(b)).first()
    assert (m.bronze_rows, m.silver_rows, m.rejected_rows) == (30000, 20001, 9999)
    newest_null = medallion.silver(b).filter(F.col("order_id").isNull()).first()
    assert newest_null.source_rank == 29997


def test_masked_keys_two_ways_agree(spark):
    from stratum.functions.rules import ORDER_RULES, first_match

    rnd = random.Random(11)
    specs = []
    for i in range(400):
        oid = None if rnd.random() < 0.03 else f"O{rnd.randrange(60)}"
        cust = None if rnd.random() < 0.2 else f"C{rnd.randrange(30)}"
        t = None if rnd.random() < 0.1 else ts(rnd.randrange(5), rnd.randrange(3))
        specs.append((oid, cust, "R", rnd.choice([-1, 4]), t, i))
    b, st = staged_of(spark, specs)
    labelled = b.withColumn("quality_issue", first_match(ORDER_RULES))
    one = sorted(map(tuple, reports.masked_keys(st).collect()), key=repr)
    two = sorted(map(tuple, reports.masked_keys_from_labelled(labelled).collect()), key=repr)
    assert one == two and len(one) > 0


def test_reason_summary_equals_staged_group_by(spark):
    from stratum.functions.rules import ORDER_RULES, first_match

    rnd = random.Random(5)
    specs = []
    for i in range(500):
        oid = None if rnd.random() < 0.03 else f"O{rnd.randrange(90)}"
        cust = None if rnd.random() < 0.15 else f"C{rnd.randrange(30)}"
        reg = None if rnd.random() < 0.1 else "R"
        t = None if rnd.random() < 0.1 else ts(rnd.randrange(5), rnd.randrange(3))
        specs.append((oid, cust, reg, rnd.choice([-2, 3, 7.5]), t, i))
    b, st = staged_of(spark, specs)
    want = sorted(
        map(tuple, st.groupBy("rejection_reason").agg(F.count(F.lit(1)).alias("rows"), F.sum("amount").alias("amount")).collect()),
        key=repr,
    )
    labelled = b.withColumn("quality_issue", first_match(ORDER_RULES))
    got = reports.reason_summary_from_labelled(labelled, ORDER_RULES, ["order_id"], ["order_ts", "source_rank"], ["amount"])
    assert sorted(map(tuple, got.collect()), key=repr) == want


def _orders_csv(folder, lines):
    import os

    p = os.path.join(folder, "orders.csv")
    with open(p, "w", encoding="utf-8") as fh:
        fh.write("order_id,customer_id,region,channel,status,amount,currency,order_ts\n" + "\n".join(lines) + "\n")
    return p


def test_blank_cells_in_every_column(spark, scratch):
    from stratum.sources.orders import read_order_csv, read_order_csv_quarantined

    full = ["A", "C", "R", "web", "completed", "1.00", "USD", "2026-03-14T09:00:00Z"]
    lines = []
    for i in range(8):
        row = list(full)
        row[i] = ""
        lines.append(",".join(row))
    p = _orders_csv(scratch, [x for i, x in enumerate(lines) if i != 5])
    rows, bad = read_order_csv_quarantined(spark, p)
    for df in (read_order_csv(spark, p), rows):
        got = [tuple(r)[:8] for r in df.orderBy("source_rank").collect()]
        assert [g[0] for g in got][0] == "" and got[1][1] is None and got[2][2] is None
        assert got[3][3] == "" and got[4][4] == "" and got[5][6] == "" and got[6][7] is None
        assert all(x is not None for i, g in enumerate(got) for k, x in enumerate(g) if k not in (1, 2, 7))
    assert bad.count() == 0
    blank = _orders_csv(scratch, lines)
    rows, bad = read_order_csv_quarantined(spark, blank)
    assert rows.count() == 7 and [r.rejection_reason for r in bad.collect()] == ["malformed_record"]
    with pytest.raises(Exception, match="amount is not a number"):
        read_order_csv(spark, blank).collect()
    assert read_order_csv(spark, blank, strict_amount=False).filter("amount IS NULL").count() == 1


def test_bronze_keeps_amounts(spark, scratch):
    from stratum.sources.orders import read_order_csv

    p = _orders_csv(scratch, [f"O{i},C,R,web,completed,{a},USD,2026-03-14T09:00:00Z" for i, a in enumerate(["0.004", "180.555"])])
    bronze = medallion.bronze(read_order_csv(spark, p))
    assert [float(r.amount) for r in bronze.orderBy("order_id").collect()] == [0.004, 180.555]
    assert medallion.silver(bronze).count() == 2
    assert medallion.gold(medallion.silver(bronze)).first().gross_revenue_usd == 180.56


def test_every_reason_is_reported(spark, scratch):
    from stratum.functions.rules import Rule
    from stratum.operators import reports
    from stratum.plans.pipeline import run_pipeline

    many = tuple(Rule(f"r{i}", f"reason_{i:02d}", f"order_id = 'O{i}'") for i in range(12))
    rows = [(f"O{i}", "C", "R", "web", "completed", Decimal(1), "USD", None, i) for i in range(14)]
    src = spark.createDataFrame(
        rows,
        "order_id string, customer_id string, region string, channel string, status string, amount decimal(18,2), "
        "currency string, order_ts timestamp_ntz, source_rank long",
    )
    spec = medallion.StageSpec(rules=many)
    want = [r.label for r in many]
    assert run_pipeline(src, scratch, spec).reasons == want
    staged = medallion.stage(medallion.bronze(src), spec)
    assert [r[0] for r in reports.rejection_reasons(staged).collect()] == want


def test_empty_source_makes_empty_layers(spark, scratch):
    from stratum.plans.pipeline import read_published, run_pipeline

    src = spark.createDataFrame(
        [],
        "order_id string, customer_id string, region string, channel string, status string, amount decimal(18,2), "
        "currency string, order_ts timestamp_ntz, source_rank long",
    )
    res = run_pipeline(src, scratch)
    assert res.metrics["bronze_rows"] == 0 and res.metrics["quality_pass_rate_pct"] is None and res.reasons == []
    for layer in ("bronze", "silver", "rejected", "gold"):
        assert read_published(spark, scratch, layer).count() == 0


def test_off_contract_writes_are_refused(spark, scratch):
    from stratum.operators.contracts import CONTRACTS
    from stratum.sinks import snapshots

    gold = spark.createDataFrame([(None, 1.0, 1, 1, 1, 1)], "region string, gross_revenue_usd double, accepted_orders long, "
                                 "completed_orders long, pipeline_orders long, distinct_customers long")  # fmt: skip
    contract = CONTRACTS["gold_region_kpis"]
    for df in (gold, gold.drop("region"), gold.withColumn("more", F.lit(1)), gold.withColumn("accepted_orders", F.lit("x"))):
        with pytest.raises(snapshots.ContractError):
            snapshots.write_snapshot(df, scratch, "gold", contract=contract)
    assert snapshots.latest_version(spark, scratch, "gold") is None
    assert snapshots.write_snapshot(gold.fillna("R"), scratch, "gold", contract=contract) == 0


def test_racing_writers_do_not_overwrite_each_other(spark, scratch):
    from stratum.sinks import snapshots

    a = snapshots.write_version(spark.range(3), scratch, "t", 0)
    b = snapshots.write_version(spark.range(5), scratch, "t", 0)
    snapshots.commit(spark, scratch, [a])
    snapshots.commit(spark, scratch, [b])
    assert snapshots.read_written(spark, scratch, a).count() == 3 and snapshots.read_written(spark, scratch, b).count() == 5


def test_a_broken_commit_log_is_not_taken_for_an_empty_one(spark, scratch):
    import os

    from stratum.sinks import snapshots

    snapshots.write_snapshot(spark.range(3), scratch, "t")
    for f in os.listdir(os.path.join(scratch, "log")):
        if f.endswith(".parquet"):
            with open(os.path.join(scratch, "log", f), "wb") as fh:
                fh.write(b"not parquet")
    with pytest.raises(Exception):
        snapshots.write_snapshot(spark.range(3), scratch, "t")


def test_compaction_of_an_empty_base_keeps_later_batches(spark, scratch):
    from stratum.streaming import ingest

    schema = (
        "order_id string, customer_id string, region string, channel string, status string, amount decimal(18,2), "
        "currency string, order_ts timestamp_ntz, source_rank long"
    )
    ingest.append_changes(medallion.bronze(spark.createDataFrame([], schema)), scratch, 0)
    ingest.compact(spark, scratch)
    row = [("O1", "C", "R", "web", "completed", Decimal(1), "USD", None, 1)]
    ingest.append_changes(medallion.bronze(spark.createDataFrame(row, schema)), scratch, 1)
    assert ingest.streamed_silver(spark, scratch).count() == 1
    ingest.compact(spark, scratch)
    assert ingest.streamed_silver(spark, scratch).count() == 1


def test_reports_plan_no_sort_aggregate(spark):
    from conftest import SF_SMALL
    from stratum.plans import catalog

    for q in (catalog.expectations_report, catalog.masked_orders, catalog.lineitem_rejections, catalog.run_metrics):
        plan = q(spark, SF_SMALL)._jdf.queryExecution().toString()
        assert "SortAggregate" not in plan, q.__name__
