"""Ranks, changes, contents, buckets and contracts across versions against brute force."""

import datetime as dt
import glob
import os
import random
import re
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.operators import checks, incremental, medallion
from stratum.operators.contracts import BROKEN_LABEL, CONTRACTS, divert_broken, schema_changes, version_changes
from stratum.operators.dedup import version_rank
from stratum.plans import catalog as plans
from stratum.plans import pipeline
from stratum.sinks import buckets, snapshots
from stratum.sinks import catalog as catalog_sink
from stratum.sources.orders import order_source
from stratum.sources.tables import TABLE_SCHEMAS


def same_rows(a, b):
    return a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


# --- exact ranks -----------------------------------------------------------


def test_one_hot_day_is_ranked_in_many_tasks(spark):
    df = spark.range(0, 40_000).select(
        F.when(F.col("id") % 4 > 0, F.lit("HOT")).when(F.col("id") % 8 == 0, F.lit(None)).otherwise(F.lit("B")).alias("order_id"),
        F.when(F.col("id") % 3 > 0, F.lit("2026-03-14 09:00:00").cast("timestamp_ntz")).alias("order_ts"),
        ((F.col("id") * 7919) % 40_000).alias("source_rank"),
    )
    got = version_rank(df, ["order_id"], ["order_ts", "source_rank"], partitions=16)
    w = Window.partitionBy("order_id").orderBy(F.col("order_ts").desc_nulls_last(), F.col("source_rank").desc())
    assert same_rows(got, df.withColumn("row_rank", F.row_number().over(w)))
    spread = got.filter("order_id = 'HOT'").select(F.floor(F.col("row_rank") / 2500).alias("k")).distinct().count()
    assert spread > 10
    assert version_rank(df.limit(0), ["order_id"], ["order_ts", "source_rank"]).count() == 0


# --- contents --------------------------------------------------------------


def test_content_differences_equal_brute_force(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.choice(["", None, "x"])) for _ in range(400)]
    other = rows[:380] + [("a", 1, "new"), (None, None, None), (None, None, None)]
    schema = "k string, n int, t string"
    left, right = spark.createDataFrame(rows, schema), spark.createDataFrame(other, schema)
    key = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)
    want = set()
    for r in {*rows, *other}:
        more = rows.count(r) - other.count(r)
        if more:
            want.add((*r, "lost" if more > 0 else "foreign", abs(more)))
    for n in (1, 7, 4096):
        assert {tuple(r) for r in checks.content_differences(left, right, ["k", "n", "t"], n).collect()} == want
    assert key(rows[0]) and checks.content_differences(left, left.repartition(5), ["k", "n", "t"]).count() == 0
    assert checks.content_differences(left.limit(0), left.limit(0), ["k"]).count() == 0


def test_nulls_do_not_trade_places_in_fingerprints(spark):
    left = spark.createDataFrame([("a", None), (None, "b")], "x string, y string")
    right = spark.createDataFrame([(None, "a"), ("b", None)], "x string, y string")
    assert checks.content_differences(left, right, ["x", "y"]).count() == 4


def test_a_foreign_silver_key_is_named(spark, fixture_source):
    bronze = medallion.bronze(fixture_source, "2026-01-01 00:00:00")
    silver, rejected = medallion.silver(bronze), medallion.rejected(bronze)
    swapped = silver.withColumn("order_id", F.when(F.col("order_id") == "O-1001", F.lit("O-9999")).otherwise(F.col("order_id")))
    gold = medallion.gold(silver)
    ok = {r.check_name: r.ok for r in checks.reconciliation(bronze, silver, rejected, gold).collect()}
    assert all(ok.values())
    bad = {r.check_name: r.ok for r in checks.reconciliation(bronze, swapped, rejected, gold).collect()}
    assert [k for k, v in bad.items() if not v] == ["silver_keys_are_in_bronze"]
    columns = ["order_id", "source_rank"]
    found = checks.content_differences(bronze, swapped.select(*columns).unionAll(rejected.select(*columns)), columns).collect()
    assert sorted((r.order_id, r.side, r.copies) for r in found) == [("O-1001", "lost", 1), ("O-9999", "foreign", 1)]


# --- cases as data ---------------------------------------------------------


def test_cases_in_any_order_and_number(spark, fixture_source, scratch):
    bronze = medallion.bronze(fixture_source, "2026-01-01 00:00:00")
    path = os.path.join(scratch, "cases.json")
    with open(path, "w") as f:
        f.write(
            '[{"case_id": "Z-VAL-04", "focus": "f4", "assertion": "a4", "expected_status": "pass"},'
            '{"id": "big", "focus": "f", "assertion": "a", "violation": "amount > 200", "expected_status": "fail"},'
            '{"id": "own", "focus": "f", "assertion": "a", "check": "region_present"},'
            '{"case_id": "VAL-01", "focus": "f1", "assertion": "a1"}]'
        )
    cases = checks.load_cases(spark, path)
    rows = bronze.collect()
    newest = {}
    for r in rows:
        at = (r.order_ts, r.source_rank)
        newest[r.order_id] = max(newest.get(r.order_id, at), at)
    stale = sum((r.order_ts, r.source_rank) != newest[r.order_id] for r in rows)
    want = {
        "Z-VAL-04": stale + len(rows) - len(newest),
        "big": sum(r.amount is not None and r.amount > 200 for r in rows),
        "own": sum(r.region is None for r in rows),
        "VAL-01": sum(r.customer_id is None for r in rows),
    }
    got = checks.validation_cases(bronze, bronze, cases=cases).collect()
    assert {r.case_id: r.violations for r in got} == want and min(want.values()) > 0
    assert [r.case_id for r in got] == ["Z-VAL-04", "big", "own", "VAL-01"]
    with pytest.raises(ValueError, match="no known check"):
        checks.validation_cases(bronze, bronze, cases=[checks.Case("X", "f", "a")])
    only = checks.validation_cases(bronze, bronze, cases=[checks.Case("X", "f", "a", violation="amount < 0")]).collect()
    assert [r.violations for r in only] == [sum(r.amount is not None and r.amount < 0 for r in rows)]


# --- gold from changes -----------------------------------------------------

SILVER = "order_id string, customer_id string, region string, status string, amount decimal(18,2), order_ts timestamp_ntz"


def silver_version(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        region = rng.choice(["N", "S", None, f"R{seed}"])
        customer = rng.choice([None, *[f"C{k}" for k in range(20)]])
        status = rng.choice(["completed", "processing", "cancelled"])
        amount = rng.choice([None, *[rng.randrange(1, 9999)] * 5])
        rows.append((f"O{i}", customer, region, status, amount and __import__("decimal").Decimal(amount) / 100, None))
    return spark.createDataFrame(rows, SILVER)


def test_gold_from_changes_equals_a_recompute(spark):
    versions = [silver_version(spark, k) for k in range(3)] + [silver_version(spark, 0).limit(0)]
    state = incremental.gold_state(versions[0])
    for old, new in zip(versions, versions[1:]):
        state = incremental.apply_changes(state, incremental.signed_changes(old, new))
        assert same_rows(incremental.gold_of(state), medallion.gold(new))
    assert incremental.signed_changes(versions[0], versions[0]).count() == 0


def order_tables(spark, top):
    """Small tables with two loads of orders, an order without a customer, a customer without a nation, a nation without a region."""
    schemas = {n: TABLE_SCHEMAS[n] for n in ("region", "nation", "customer", "orders")}
    at = lambda y, d: dt.datetime(y, 1 + d % 12, 1 + d % 28)
    rows = {
        "region": [(0, "NORTH"), (1, "SOUTH")],
        "nation": [(k, f"N{k}", 9 if k == 6 else k % 2) for k in range(7)],
        "customer": [(k, f"C{k}", None if k == 5 else k % 8, 1.5, "X") for k in range(60)],
        "orders": [(k, k % 67, "FPO"[k % 3], 10.25 * (k % 90), at(1996 + k % 4, k), "1-URGENT") for k in range(1, 900)],
    }
    for name, schema in schemas.items():
        spark.createDataFrame(rows[name], schema).write.parquet(os.path.join(top, f"{name}.parquet"))
    return rows


def test_gold_from_changes_reads_written_versions_and_frees_its_shuffles(spark, scratch):
    order_tables(spark, scratch)
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {f for f in disk.getAllFiles().mkString("|").split("|") if re.search(r"/shuffle_\d+_\d+_\d+[.]data$", f)}
    before = shuffled()
    got = plans.gold_from_changes(spark, scratch)
    for _ in range(100):  # files go in the background
        if shuffled() <= before:
            break
        time.sleep(0.2)
    assert shuffled() <= before
    # What is left to the caller reads states, not orders.
    assert "o_orderkey" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert spark.conf.get(plans.FREE_SHUFFLES) == "false"
    bronze = medallion.bronze(order_source(spark, scratch), plans.RUN_TS)
    cut = F.lit(plans.EARLIER_LOAD_BEFORE).cast("timestamp_ntz")
    want = {"now": bronze, "earlier": bronze.filter(F.col("order_ts") < cut)}
    for layer, rows in want.items():
        assert same_rows(got.filter(F.col("layer") == layer).drop("layer"), medallion.gold(medallion.silver(rows)))
    assert got.count() == 4


def test_regions_are_looked_up_without_a_shuffle_by_nation(spark, scratch):
    rows = order_tables(spark, scratch)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        source = order_source(spark, scratch)
        plan = source._jdf.queryExecution().executedPlan().toString()
        got = {r.source_rank: r.region for r in source.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    names, regions = dict(rows["region"]), {n: r for n, _, r in rows["nation"]}
    nations = {c: n for c, _, n, *_ in rows["customer"]}
    assert got == {k: None if k % 23 == 0 else names.get(regions.get(nations.get(c))) for k, c, *_ in rows["orders"]}
    assert None in {names.get(regions.get(nations.get(c))) for _, c, *_ in rows["orders"]}


def test_sketches_keep_their_bound(spark):
    n = 30_000
    df = spark.range(n).select(
        F.concat(F.lit("C"), (F.col("id") % 20_000).cast("string")).alias("customer_id"),
        F.when(F.col("id") % 3 == 0, F.lit("N")).otherwise(F.lit("S")).alias("region"),
        F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz").alias("order_ts"),
    )
    df = df.unionAll(df.limit(5).withColumn("customer_id", F.lit(None).cast("string")))
    sketches = incremental.customer_sketches(df)
    assert sketches.count() > 2000
    exact = {r.region: r.c for r in df.groupBy("region").agg(F.count_distinct("customer_id").alias("c")).collect()}
    for r in incremental.approx_customers(sketches, "region").collect():
        assert abs(r.approx_customers - exact[r.region]) <= incremental.SKETCH_BOUND * exact[r.region]
    assert abs(incremental.approx_customers(sketches).first()[0] - 20_000) <= incremental.SKETCH_BOUND * 20_000


# --- bucketed upsert -------------------------------------------------------


def files_of(path):
    return {os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_upsert_leaves_other_buckets_alone(spark, scratch):
    path = os.path.join(scratch, "table")
    table = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    buckets.write_bucketed(table, path, ["k"], 8)
    before = files_of(path)
    source = spark.createDataFrame([(5, -1), (2000, -2)], "k long, v long")
    touched = buckets.upsert_bucketed(spark, path, source, ["k"], 8)
    assert 1 <= len(touched) <= 2
    want = {k: 2 * k for k in range(1000)} | {5: -1, 2000: -2}
    rows = buckets.read_bucketed(spark, path).collect()
    assert len(rows) == len(want) and {r.k: r.v for r in rows} == want
    kept = {f for f in before if not any(f"/bucket={b}/" in f for b in touched)}
    assert kept and kept <= files_of(path) and not (before - kept) & files_of(path)
    assert buckets.upsert_bucketed(spark, path, source.limit(0), ["k"], 8) == []
    with pytest.raises(Exception, match="not unique"):
        buckets.upsert_bucketed(spark, path, source.unionAll(source), ["k"], 8)


# --- contracts across versions ---------------------------------------------


def test_each_kind_of_change_is_classified(spark, scratch):
    def schema(**cols):
        return T.StructType([T.StructField(n, T._parse_datatype_string(t), null) for n, (t, null) in cols.items()])

    old = schema(a=("int", True), b=("bigint", True), c=("string", False), d=("decimal(10,2)", True), e=("date", True), f=("int", True))
    new = schema(a=("bigint", True), b=("int", True), c=("string", True), d=("decimal(12,2)", True), e=("string", True), g=("int", True), h=("int", False))
    assert schema_changes(old, new) == [
        ("a", "widened", True),
        ("b", "narrowed", False),
        ("c", "optional", False),
        ("d", "widened", True),
        ("e", "retyped", False),
        ("g", "added_nullable", True),
        ("h", "added_required", False),
        ("f", "dropped", False),
    ]
    assert schema_changes(old, old) == []
    root = os.path.join(scratch, "log")
    snapshots.write_snapshot(spark.createDataFrame([(1, "x")], "a int, b string"), root, "t")
    snapshots.write_snapshot(spark.createDataFrame([(1,)], "a bigint"), root, "t")
    got = [tuple(r) for r in version_changes(spark, snapshots.commit_log(spark, root)).collect()]
    assert got == [("t", 1, "a", "widened", True), ("t", 1, "b", "dropped", False)]


def test_broken_rows_are_diverted_before_the_commit(spark, fixture_source, scratch):
    lax = medallion.StageSpec(rules=tuple(r for r in medallion.ORDER_SPEC.rules if r.name == "positive_amount"))
    root = os.path.join(scratch, "lake")
    pipeline.run_pipeline(fixture_source, root, lax, ingested_at="2026-01-01 00:00:00")
    silver = pipeline.read_published(spark, root, "silver")
    assert silver.filter("customer_id IS NULL OR region IS NULL").count() == 0 and silver.count() == 8
    rejected = pipeline.read_published(spark, root, "rejected")
    assert rejected.filter(F.col("rejection_reason") == BROKEN_LABEL).count() == 2
    staged = medallion.stage(medallion.bronze(fixture_source, "2026-01-01 00:00:00"))
    assert divert_broken(staged, CONTRACTS["silver_orders"]).filter(F.col("rejection_reason") == BROKEN_LABEL).count() == 0
    with pytest.raises(snapshots.ContractError):
        snapshots.write_snapshot(staged.withColumn("layer", F.lit(None).cast("string")), root, "staged", contract=CONTRACTS["staged_orders"])


# --- outside folders and configuration -------------------------------------


def test_version_of_a_delta_folder(spark, scratch):
    table = os.path.join(scratch, "outside")
    assert snapshots.latest_delta_version(spark, table) is None
    log = os.path.join(table, "_delta_log")
    os.makedirs(log)
    assert snapshots.latest_delta_version(spark, table) is None
    for name in ("00000000000000000000.json", "00000000000000000009.json", "00000000000000000010.json", "x.json", "00000000000000000011.crc"):
        with open(os.path.join(log, name), "w") as f:
            f.write("{}")
    assert snapshots.latest_delta_version(spark, table) == 10


def test_export_targets_from_config(spark, scratch):
    path = os.path.join(scratch, "targets.json")
    with open(path, "w") as f:
        f.write('[{"name": "warehouse", "activation": "URL", "role": "KPIs"}, {"name": "files"}]')
    got = catalog_sink.load_targets(spark, path)
    assert [(t.name, t.activation, t.role) for t in got] == [("warehouse", "URL", "KPIs"), ("files", "", "")]
    with open(path, "w") as f:
        f.write('[{"name": null, "role": "x"}]')
    with pytest.raises(ValueError, match="no name"):
        catalog_sink.load_targets(spark, path)


def test_a_large_bucket_is_cut_into_tasks(spark, scratch):
    """A bucket is not one task's sort: above the advisory size it is written by several."""
    path = os.path.join(scratch, "large-bucket")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    table = spark.range(0, 400_000, 1, 8).selectExpr("id AS k", "hash(id) AS v")
    spark.conf.set(key, "200k")
    try:
        buckets.write_bucketed(table, path, ["k"], 2)
        for b in (0, 1):
            assert len(glob.glob(os.path.join(path, f"bucket={b}", "*.parquet"))) > 1
        source = spark.range(399_990, 400_010).selectExpr("id AS k", "-1 AS v")
        assert buckets.upsert_bucketed(spark, path, source, ["k"], 2) == [0, 1]
    finally:
        spark.conf.set(key, before)
    found = buckets.read_bucketed(spark, path)
    assert found.count() == 400_010 and found.filter("v = -1 AND k >= 399990").count() == 20
