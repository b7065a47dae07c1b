"""Plan shape of the registered queries: what a large cluster would run."""

from types import SimpleNamespace

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from stratum import session


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_text(fn(spark, SF_SMALL)) for name, fn in E.queries().items()}


def test_no_cartesian_or_nested_loop_joins(plans):
    for name, p in plans.items():
        assert "CartesianProduct" not in p, name
        assert "BroadcastNestedLoopJoin" not in p, name


def test_no_python_in_the_hot_path(plans):
    for name, p in plans.items():
        assert "BatchEvalPython" not in p, name
        assert "ArrowEvalPython" not in p, name


def test_newest_version_is_limited_map_side(plans):
    for name in ("silver_orders", "gold_region_kpis", "lineitem_latest"):
        assert "WindowGroupLimit" in plans[name] and "Partial" in plans[name], name


def _scan_columns(plan: str, table: str) -> list[list[str]]:
    import re

    out = []
    for m in re.finditer(r"FileScan parquet \[([^\]]*)\][^\n]*?/" + table + r"\.parquet", plan):
        out.append([c.split("#")[0] for c in m.group(1).split(",")])
    return out


def test_scans_are_pruned(spark):
    p = plan_text(E.queries()["daily_event_counts"](spark, SF_SMALL))
    assert _scan_columns(p, "events") == [["ts", "event_type"]]
    assert "In(event_type" in p  # the allow-list reaches the scan as a pushed filter
    docs = plan_text(E.queries()["document_label_gate"](spark, SF_SMALL))
    assert _scan_columns(docs, "documents") == [["doc_id", "lang", "n_chars"]]  # no text read
    gold = plan_text(E.queries()["gold_region_kpis"](spark, SF_SMALL))
    for cols in _scan_columns(gold, "orders"):
        assert len(cols) < 6  # the priority column is not needed for gold


def test_gold_plan_has_no_full_window(plans):
    # every Window in gold's plan sits on top of a group limit
    p = plans["gold_region_kpis"]
    assert p.count("WindowGroupLimit") >= 2


def _final_plan(df) -> str:
    df.collect()  # runs this DataFrame's own adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def small_skew_thresholds(spark):
    keys = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_key_is_split_when_flagging_versions(spark, small_skew_thresholds):
    from pyspark.sql import functions as F

    from stratum.operators import dedup

    df = spark.range(0, 300000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("K"), (F.col("id") % 50000).cast("string"))).alias("order_id"),
        (F.col("id") % 1000).cast("timestamp").cast("timestamp_ntz").alias("order_ts"),
        F.col("id").alias("source_rank"),
    )
    out = dedup.flag_latest(df, ["order_id"], ["order_ts", "source_rank"])
    assert "SortMergeJoin(skew=true)" in _final_plan(out)


def test_hot_link_target_is_split(spark, small_skew_thresholds):
    from pyspark.sql import functions as F

    from stratum.operators.joins import join_unique_side

    rows = spark.range(0, 300000).select(
        F.when(F.col("id") % 3 == 0, F.lit("/")).otherwise(F.concat(F.lit("/p"), (F.col("id") % 40000).cast("string"))).alias("t"),
        F.col("id"),
    )
    known = rows.select(F.col("t").alias("k")).distinct()
    out = join_unique_side(rows, known, "t", "k", "left")
    assert "SortMergeJoin(skew=true)" in _final_plan(out)
    assert out.count() == 300000




def test_task_sizes_are_bounds():
    """A larger task size of the submitter is lowered, a smaller one and other settings stay."""

    class Conf(dict):
        set = dict.__setitem__
        contains = dict.__contains__

    advisory, split, factor = (
        "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor"
    )
    given = Conf({advisory: "128MB", split: "1000000b", factor: "9"})
    now = Conf(given)
    context = SimpleNamespace(getConf=lambda: given, master="local[2]")
    session.apply_conf(SimpleNamespace(conf=now, sparkContext=context))
    assert (now[advisory], now[split], now[factor]) == ("16m", "1000000b", "9")
    assert [session._size(x) for x in ("7", "2k", "3MB", "1gb", "4 m")] == [7, 2048, 3 << 20, 1 << 30, 4 << 20]
