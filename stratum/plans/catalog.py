"""The registered queries: each takes ``(spark, sf_dir)`` and returns a lazy
DataFrame over the data directory's tables.

Every query reads whole tables; previews and the bounded read keep their
``LIMIT`` because the limit is what they report.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions.rules import Rule, first_match
from stratum.operators import checks, corpus, dedup, incremental, medallion, reports
from stratum.operators.contracts import CONTRACTS, contract_violations, divert_broken
from stratum.operators.incremental import GoldState
from stratum.operators.medallion import StageSpec
from stratum.operators.upsert import keyed_upsert
from stratum.plans.pipeline import run_pipeline, table_registry
from stratum.session import ensure_checkpoint_dir
from stratum.sinks import buckets
from stratum.sinks.snapshots import snapshot_diff
from stratum.sources.inventory import file_inventory, source_inventory, source_preview
from stratum.sources.orders import CSV_SCHEMA, order_source, order_versions, read_order_csv
from stratum.sources.tables import read_table

# Fixed parameters of the registered queries (results must be repeatable).
RUN_TS = "2026-01-01 00:00:00"
PREVIOUS_RUN_TS = "2025-12-31 00:00:00"
# An earlier load holds the orders dated before this day.
EARLIER_LOAD_BEFORE = "1998-01-01 00:00:00"
BOUNDED_READ_LIMIT = 4
# The earlier load had a region that has no orders today, and lacked one.
CLOSED_REGION, NEW_REGION = "AFRICA", "EUROPE"

Query = Callable[[SparkSession, str], DataFrame]


def presentable(df: DataFrame) -> DataFrame:
    """Money travels as DECIMAL inside the plan; outputs show it as DOUBLE."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# --- the order medallion -----------------------------------------------------

def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.bronze(order_source(spark, sf_dir), RUN_TS)


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Version columns come straight from orders: the newest-version side of
    # staging then needs no dimension joins.
    return medallion.stage(_bronze(spark, sf_dir), versions=order_versions(spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.silver(_bronze(spark, sf_dir))


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.gold(_silver(spark, sf_dir))


def bronze_orders(spark, sf_dir):
    return presentable(_bronze(spark, sf_dir))


def silver_orders(spark, sf_dir):
    return presentable(_silver(spark, sf_dir))


def rejected_orders(spark, sf_dir):
    return presentable(medallion.split(_staged(spark, sf_dir))[1])


def gold_region_kpis(spark, sf_dir):
    return _gold(spark, sf_dir)


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(spark, sf_dir).withColumn("quality_issue", first_match(medallion.ORDER_SPEC.rules))


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every report number from labelled bronze, without staging the rows."""
    return reports.labelled_counts(_labelled(spark, sf_dir))


def expectations_report(spark, sf_dir):
    return reports.expectations_from_counts_df(_counts(spark, sf_dir))


def run_metrics(spark, sf_dir):
    return reports.run_metrics_from_counts_df(_counts(spark, sf_dir))


def rejection_reasons(spark, sf_dir):
    return reports.reasons_from_counts_df(_counts(spark, sf_dir))


def rejected_preview(spark, sf_dir):
    rej = medallion.split(_staged(spark, sf_dir))[1]
    return presentable(
        reports.preview(
            rej,
            ["order_id", "source_rank"],
            10,
            ["order_id", "customer_id", "region", "amount", "rejection_reason"],
        )
    )


def bronze_preview(spark, sf_dir):
    return presentable(reports.preview(_bronze(spark, sf_dir), ["order_id", "source_rank"], 5))


def silver_preview(spark, sf_dir):
    return presentable(
        reports.preview(
            _silver(spark, sf_dir),
            ["order_id"],
            5,
            ["order_id", "customer_id", "region", "status", "amount", "currency"],
        )
    )


def gold_preview(spark, sf_dir):
    return reports.preview(_gold(spark, sf_dir), ["region"], 10)


def pipeline_summary(spark, sf_dir):
    """Layer counts, expectations met, and gold's rows as a list (A-10)."""
    return reports.with_kpi_list(reports.pipeline_summary_from_counts_df(_counts(spark, sf_dir)), _gold(spark, sf_dir))


def _earlier_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of the earlier load: orders dated before the cut-off."""
    b = _bronze(spark, sf_dir).filter(F.col("order_ts") < F.lit(EARLIER_LOAD_BEFORE).cast("timestamp_ntz"))
    gold = medallion.gold(medallion.silver(b)).filter(F.col("region") != NEW_REGION)
    return gold.withColumn("loaded_at", F.lit(PREVIOUS_RUN_TS).cast("timestamp_ntz"))


def gold_upsert(spark, sf_dir):
    """Today's gold upserted into the table the earlier load published: one
    region is kept from it, one is new, the others are updated."""
    # Gold is a GROUP BY region result, unique on region by construction, so
    # the duplicate-key check (an extra job over the source) is not needed.
    return keyed_upsert(
        _earlier_gold(spark, sf_dir),
        _gold(spark, sf_dir).filter(F.col("region") != CLOSED_REGION),
        ["region"],
        stamp=F.lit(RUN_TS).cast("timestamp_ntz"),
        check_unique=False,
    )


def gold_bounded_read(spark, sf_dir):
    """``ORDER BY region LIMIT n`` over the published table (S-11, T-4)."""
    table = gold_upsert(spark, sf_dir)
    n = max(1, min(BOUNDED_READ_LIMIT, 1000))
    return reports.preview(
        table,
        ["region"],
        n,
        [
            "region",
            "gross_revenue_usd",
            "accepted_orders",
            "completed_orders",
            "pipeline_orders",
            "distinct_customers",
            "loaded_at",
        ],
    )


def order_version_ranks(spark, sf_dir):
    """Every source row's exact version rank within its order (W-2), hot
    orders included (range partitioned, see dedup.version_rank)."""
    return dedup.version_rank(order_versions(spark, sf_dir), ["order_id"], ["order_ts", "source_rank"])


def masked_orders(spark, sf_dir):
    return reports.masked_keys_from_labelled(_labelled(spark, sf_dir))


def rejection_impact(spark, sf_dir):
    return reports.rejection_impact(_staged(spark, sf_dir))


def _each_layer(checked: dict[str, DataFrame]) -> DataFrame:
    parts = [df.withColumn("layer", F.lit(name)) for name, df in checked.items()]
    return reduce(DataFrame.unionAll, parts)


def layer_reconciliation(spark, sf_dir):
    """The layers as they are, and with bronze taken for silver, which must
    not reconcile.  Silver and rejected come from plans of their own."""
    bronze, gold = _bronze(spark, sf_dir), _gold(spark, sf_dir)
    rejected = medallion.rejected(bronze, versions=order_versions(spark, sf_dir))
    return _each_layer(
        {
            "silver": checks.reconciliation(bronze, medallion.silver(bronze), rejected, gold),
            "bronze": checks.reconciliation(bronze, bronze, rejected, gold),
        }
    )


def validation_cases(spark, sf_dir):
    """The cases over silver, where all pass, and over bronze, where the rows
    that silver must not hold are counted."""
    bronze = _bronze(spark, sf_dir)
    return _each_layer(
        {
            "silver": checks.validation_cases(medallion.silver(bronze), bronze),
            "bronze": checks.validation_cases(bronze, bronze),
        }
    )


# Cases as data: another order than the built-in one, and a case with a predicate of its own.
CASE_LIST = (
    *reversed(checks.CASES),
    checks.Case("LARGE-01", "large cancellations", "No cancelled order of over 300000 is published.", "fail",
                violation="status = 'cancelled' AND amount > 300000"),
)


def case_list(spark, sf_dir):
    """Validation cases bound by id and predicate, over silver (D-5)."""
    bronze = _bronze(spark, sf_dir)
    return checks.validation_cases(medallion.silver(bronze), bronze, cases=CASE_LIST)


CONTENT_COLUMNS = ("order_id", "customer_id", "region", "amount", "order_ts", "source_rank")


def content_reconciliation(spark, sf_dir):
    """Bronze against silver and rejected, row by row: once as they are, which
    names nothing, and once against a damaged copy in which some rows are
    lost, some doubled, some have another amount and some another key (D-7)."""
    bronze = _bronze(spark, sf_dir).select(*CONTENT_COLUMNS)
    staged = _staged(spark, sf_dir)
    layers = reduce(DataFrame.unionAll, [part.select(*CONTENT_COLUMNS) for part in medallion.split(staged)])
    rank = F.col("source_rank")
    damaged = layers.filter(rank % 997 != 3).withColumns(
        {
            "amount": F.when(rank % 991 == 5, F.col("amount") + 1).otherwise(F.col("amount")).cast("decimal(18,2)"),
            "order_id": F.when(rank % 977 == 11, F.concat(F.lit("X"), "order_id")).otherwise(F.col("order_id")),
        }
    )
    damaged = damaged.unionAll(damaged.filter(rank % 983 == 7))
    compared = {"published": layers, "damaged": damaged}
    return presentable(_each_layer({k: checks.content_differences(bronze, df, CONTENT_COLUMNS) for k, df in compared.items()}))


def contract_quarantine(spark, sf_dir):
    """Rows a layer and reason when only the amount rule is applied: what then
    breaks silver's NOT NULL promises is diverted to quarantine (D-3)."""
    lax = StageSpec(rules=tuple(r for r in medallion.ORDER_SPEC.rules if r.name == "positive_amount"))
    staged = medallion.stage(_bronze(spark, sf_dir), lax, versions=order_versions(spark, sf_dir))
    diverted = divert_broken(staged, CONTRACTS["silver_orders"])
    return diverted.groupBy("layer", "rejection_reason").agg(F.count(F.lit(1)).alias("rows"))


def _earlier_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = F.lit(EARLIER_LOAD_BEFORE).cast("timestamp_ntz")
    return medallion.silver(_bronze(spark, sf_dir).filter(F.col("order_ts") < cut))


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: The shuffle files of a query go when it ends, not when the driver happens to collect its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, for plans that read it several times.

    The shuffle files that made it are given back at once: the write is a query
    of its own, so nothing else can read them."""
    path, before = _scratch(spark, name), spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def _written_state(spark: SparkSession, state: GoldState, name: str) -> GoldState:
    return GoldState(_written(spark, state.kpis, f"{name}-kpis"), _written(spark, state.pairs, f"{name}-pairs"))


def gold_from_changes(spark, sf_dir):
    """Today's gold from the earlier load's state and the rows that changed
    since (D-4), and the earlier gold by taking the same changes back.

    Each version is read several times, by its state and by two comparisons;
    so versions, changes and states are written, each made by shuffles of its own."""
    versions = {"earlier": _earlier_silver(spark, sf_dir), "now": _silver(spark, sf_dir)}
    silver = {k: _written(spark, df.select(*incremental.COLUMNS), f"silver-{k}") for k, df in versions.items()}
    gold = {}
    for old, new in (("earlier", "now"), ("now", "earlier")):
        changes = _written(spark, incremental.signed_changes(silver[old], silver[new]), f"changes-to-{new}")
        state = incremental.apply_changes(incremental.gold_state(silver[old]), changes)
        gold[new] = incremental.gold_of(_written_state(spark, state, f"state-{new}"))
    return _each_layer(gold)


def approx_region_customers(spark, sf_dir):
    """Distinct customers a region, exactly and from daily sketches rolled up
    (A-6): whether the estimate keeps its stated bound."""
    silver = _silver(spark, sf_dir)
    exact = silver.groupBy("region").agg(F.count_distinct("customer_id").alias("customers"))
    approx = incremental.approx_customers(incremental.customer_sketches(silver), "region")
    error = F.abs(F.col("approx_customers") - F.col("customers"))
    within = error <= F.ceil(F.col("customers") * incremental.SKETCH_BOUND)
    return exact.join(approx, "region").select("region", "customers", within.alias("within_bound"))


def published_tables(spark, sf_dir):
    """The table registry after a run of the whole pipeline (A-11, K-1, S-9)."""
    root = _scratch(spark, "published")
    run_pipeline(order_source(spark, sf_dir), root, ingested_at=RUN_TS)
    return table_registry(spark, root).select("table_name", F.col("version").cast("bigint").alias("version"), "rows", "contract")


UPSERT_BUCKETS = 16
UPSERT_SINCE = "1998-07-01 00:00:00"
UPSERT_KEYS_BELOW = 50


def bucketed_upsert(spark, sf_dir):
    """An order table in key buckets, its late orders and a few new keys
    upserted (K-4): only the buckets that hold them are rewritten."""
    path = _scratch(spark, "bucketed")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    buckets.write_bucketed(orders, path, ["o_orderkey"], UPSERT_BUCKETS)
    late = read_table(spark, sf_dir, "orders").filter(F.col("o_orderdate") >= F.lit(UPSERT_SINCE).cast("timestamp_ntz"))
    changed = late.select("o_orderkey", F.lit("U").alias("o_orderstatus"), (F.col("o_totalprice") + 1).cast("decimal(18,2)").alias("price"))
    new = orders.filter(F.col("o_orderkey") < UPSERT_KEYS_BELOW).select(
        (-1 - F.col("o_orderkey")).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), "price"
    )
    buckets.upsert_bucketed(spark, path, changed.unionAll(new), ["o_orderkey"], UPSERT_BUCKETS)
    return presentable(buckets.read_bucketed(spark, path))


def _order_csv(spark: SparkSession, sf_dir: str) -> str:
    """The orders as CSV files in key order, some with quotes and line feeds in a field."""
    path = _scratch(spark, "orders-csv")
    desk = F.concat(F.lit('desk "'), (F.col("source_rank") % 7).cast("string"), F.lit('",\nfloor 2'))
    source = order_source(spark, sf_dir).withColumn("channel", F.when(F.col("source_rank") % 5 == 0, desk).otherwise(F.col("channel")))
    when = F.date_format("order_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("order_ts")
    cols = [when if f.name == "order_ts" else F.col(f.name).cast("string").alias(f.name) for f in CSV_SCHEMA.fields]
    rows = source.orderBy("source_rank").select(*cols)
    rows.write.option("header", True).option("escape", '"').csv(path)
    return path


def csv_arrival_orders(spark, sf_dir):
    """Orders written to CSV and scanned in splits: fields that span lines are
    whole, and the arrival rank is the order of writing (S-1, P-4)."""
    return presentable(read_order_csv(spark, _order_csv(spark, sf_dir)).select("source_rank", "order_id", "region", "channel", "amount"))


def csv_record_counts(spark, sf_dir):
    """Records of the order files and of a missing one (S-5, S-7)."""
    path = _order_csv(spark, sf_dir)
    return file_inventory(spark, {"orders": path, "absent": f"{path}-absent"})


def gold_contract(spark, sf_dir):
    """Gold's rows checked against its published column contract (D-3), and
    gold of all bronze rows, whose rows without a region break it."""
    everything = medallion.gold(_bronze(spark, sf_dir))
    return _each_layer(
        {
            "gold": contract_violations(_gold(spark, sf_dir), "gold_region_kpis"),
            "bronze": contract_violations(everything, "gold_region_kpis"),
        }
    )


def silver_contract(spark, sf_dir):
    """Silver's rows checked against its column contract (D-3), and bronze
    rows against the same, which have NULLs and lack columns."""
    bronze = _bronze(spark, sf_dir)
    return _each_layer(
        {
            "silver": contract_violations(medallion.silver(bronze), "silver_orders"),
            "bronze": contract_violations(bronze, "silver_orders"),
        }
    )


def silver_snapshot_diff(spark, sf_dir):
    """Silver of the earlier load against silver now: keys added, removed
    or changed (D-4)."""
    b = _bronze(spark, sf_dir)
    earlier = b.filter(F.col("order_ts") < F.lit(EARLIER_LOAD_BEFORE).cast("timestamp_ntz"))
    compare = ["customer_id", "region", "channel", "status", "amount", "currency", "order_ts", "source_rank"]
    return snapshot_diff(medallion.silver(earlier), medallion.silver(b), ["order_id"], compare)


# --- sources -------------------------------------------------------------------

def source_inventory_q(spark, sf_dir):
    return source_inventory(spark, sf_dir)


def source_preview_q(spark, sf_dir):
    return source_preview(read_table(spark, sf_dir, "orders"), ["o_orderkey"], 2)


# --- the same operators on other tables --------------------------------------

LINEITEM_SPEC = StageSpec(
    rules=(
        Rule("bulk_quantity", "bulk_quantity", "l_quantity > 45"),
        Rule("discount_in_range", "discount_out_of_range", "l_discount < 0 OR l_discount > 0.08"),
    ),
    keys=("l_orderkey", "l_linenumber"),
    version=("l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity"),
)


def lineitem_latest(spark, sf_dir):
    """Newest version of each (order, line), if it passes the line rules."""
    return medallion.silver(read_table(spark, sf_dir, "lineitem"), LINEITEM_SPEC).drop(
        "quality_issue", "row_rank", "rejection_reason"
    )


def lineitem_rejections(spark, sf_dir):
    """Rows and quantity per rejection reason of the line items, without
    staging every row."""
    lines = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_discount",
        # quantities are whole numbers: summed exactly as DECIMAL
        F.col("l_quantity").cast("decimal(18,2)").alias("l_quantity"),
    )
    labelled = lines.withColumn("quality_issue", first_match(LINEITEM_SPEC.rules))
    summary = reports.reason_summary_from_labelled(
        labelled, LINEITEM_SPEC.rules, LINEITEM_SPEC.keys, LINEITEM_SPEC.version, ["l_quantity"]
    )
    return summary.select("rejection_reason", "rows", F.col("l_quantity").cast("double").alias("quantity"))


CUSTOMER_RULES = (Rule("positive_balance", "non_positive_balance", "c_acctbal <= 0"),)


def customer_balance_gate(spark, sf_dir):
    cust = read_table(spark, sf_dir, "customer").select("c_mktsegment", "c_acctbal")
    labelled = checks.label_rows(cust, CUSTOMER_RULES)
    accepted = F.col("rejection_reason").isNull()
    return labelled.groupBy("c_mktsegment").agg(
        F.count_if(accepted).alias("accepted_customers"),
        F.count_if(~accepted).alias("rejected_customers"),
        F.sum(F.when(accepted, F.col("c_acctbal").cast("decimal(18,2)"))).cast("double").alias("accepted_balance"),
    )


DOCUMENT_RULES = (
    Rule("labelled", "missing_label", "NOT _labelled"),
    Rule("not_toxic", "toxic", "toxic = 1"),
    Rule("quality", "low_quality", "quality = 0"),
)


def document_label_gate(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic", F.lit(True).alias("_labelled"))
    joined = docs.join(labels, "doc_id", "left").withColumn("_labelled", F.coalesce("_labelled", F.lit(False)))
    labelled = checks.label_rows(joined, DOCUMENT_RULES)
    return labelled.groupBy("lang", "rejection_reason").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("n_chars").cast("bigint").alias("chars")
    )


def orders_without_lines(spark, sf_dir):
    """Orders with no line item (a completeness rule, anti join).  Line keys
    are de-duplicated map side before they are shuffled."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    line_keys = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return orders.join(line_keys, "o_orderkey", "left_anti")


# Terms that the scan reports: insults, licence notices and secrets.
BANNED_TERMS = ("idiot", "worthless", "pathetic", "disgusting", "licensed under", "general public license", "token =")


def banned_term_scan(spark, sf_dir):
    docs = corpus.term_hits(
        read_table(spark, sf_dir, "documents").select(
            F.lit("documents").alias("source"), F.col("doc_id").alias("record_id"), F.lit(None).cast("bigint").alias("turn"), "text"
        ),
        ["source", "record_id", "turn"],
        "text",
        BANNED_TERMS,
    )
    convs = corpus.term_hits(
        read_table(spark, sf_dir, "conversations").select(
            F.lit("conversations").alias("source"), F.col("conv_id").alias("record_id"), "turn", "text"
        ),
        ["source", "record_id", "turn"],
        "text",
        BANNED_TERMS,
    )
    return docs.unionByName(convs)


def benchmark_phrases(spark, sf_dir):
    """Every two neighbouring words of the benchmark items, in lower case."""
    words = F.split(F.lower("text"), " ")
    at = F.sequence(F.lit(1), F.size("w") - 1)
    pairs = F.transform(at, lambda i: F.concat_ws(" ", F.element_at("w", i), F.element_at("w", i + 1)))
    items = read_table(spark, sf_dir, "benchmark").select(words.alias("w")).filter(F.size("w") > 1)
    return items.select(F.explode(pairs).alias("term"))


def phrase_scan(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return corpus.indexed_term_hits(docs, ["doc_id"], "text", benchmark_phrases(spark, sf_dir))


def link_audit(spark, sf_dir):
    return corpus.link_audit(read_table(spark, sf_dir, "pages"))


# Contract of an event's props document: key k present, an integer 0..89.
EVENT_PROPS = corpus.JsonContract(required=("k",), bounds={"k": (0, 89)})
# Contract of an order document: head.status, three lines at least, each with
# a discount, a total in bounds.
ORDER_DOCUMENT = corpus.JsonContract(
    required=("key", "head.status"), bounds={"head.total": (0, 400_000)}, lists={"lines": 3}, item_keys={"lines": ("number", "discount")}
)


def json_contract(spark, sf_dir):
    return corpus.json_contract(
        read_table(spark, sf_dir, "events"),
        "props",
        ["event_id", "event_type"],
        EVENT_PROPS,
    )


def order_documents(spark, sf_dir):
    """One JSON document an order, with its lines; a discount of 0 is left out."""
    discount = F.when(F.col("l_discount") > 0, F.col("l_discount")).alias("discount")
    lines = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.struct(F.col("l_linenumber").alias("number"), discount).alias("line")
    )
    # An order has a handful of lines.
    per_order = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    head = F.struct(F.nullif("o_orderstatus", F.lit("P")).alias("status"), F.floor("o_totalprice").alias("total"))
    joined = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
    return joined.select("o_orderkey", F.to_json(F.struct(F.col("o_orderkey").alias("key"), head.alias("head"), "lines")).alias("document"))


def order_document_contract(spark, sf_dir):
    return corpus.json_contract(order_documents(spark, sf_dir), "document", ["o_orderkey"], ORDER_DOCUMENT)


ALLOWED_PAGE_DOMAINS = ("example.com", "example.org")


def url_policy(spark, sf_dir):
    """The policy over all pages; every fiftieth page's url is taken away, so that one without a url is judged too."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", F.when(F.col("page_id") % 50 != 7, F.col("url")).alias("url"))
    return corpus.url_policy(pages, "url", ["page_id"], ALLOWED_PAGE_DOMAINS)


# Event types counted by the daily counters; other types never leave the scan.
ALLOWED_EVENT_TYPES = ("view", "click", "signup", "purchase")


def daily_event_counts(spark, sf_dir):
    """Daily counters; the day is shown as ISO text (yyyy-MM-dd)."""
    counts = corpus.daily_counts(read_table(spark, sf_dir, "events"), ALLOWED_EVENT_TYPES)
    return counts.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


QUERIES: dict[str, Query] = {
    "gold_region_kpis": gold_region_kpis,
    "bronze_orders": bronze_orders,
    "silver_orders": silver_orders,
    "rejected_orders": rejected_orders,
    "expectations_report": expectations_report,
    "run_metrics": run_metrics,
    "rejection_reasons": rejection_reasons,
    "rejected_preview": rejected_preview,
    "bronze_preview": bronze_preview,
    "silver_preview": silver_preview,
    "gold_preview": gold_preview,
    "pipeline_summary": pipeline_summary,
    "gold_upsert": gold_upsert,
    "gold_bounded_read": gold_bounded_read,
    "masked_orders": masked_orders,
    "order_version_ranks": order_version_ranks,
    "rejection_impact": rejection_impact,
    "layer_reconciliation": layer_reconciliation,
    "validation_cases": validation_cases,
    "gold_contract": gold_contract,
    "silver_contract": silver_contract,
    "snapshot_diff": silver_snapshot_diff,
    "source_inventory": source_inventory_q,
    "source_preview": source_preview_q,
    "lineitem_latest": lineitem_latest,
    "lineitem_rejections": lineitem_rejections,
    "customer_balance_gate": customer_balance_gate,
    "document_label_gate": document_label_gate,
    "orders_without_lines": orders_without_lines,
    "daily_event_counts": daily_event_counts,
    "banned_term_scan": banned_term_scan,
    "phrase_scan": phrase_scan,
    "link_audit": link_audit,
    "json_contract": json_contract,
    "order_document_contract": order_document_contract,
    "url_policy": url_policy,
    "case_list": case_list,
    "content_reconciliation": content_reconciliation,
    "contract_quarantine": contract_quarantine,
    "gold_from_changes": gold_from_changes,
    "approx_region_customers": approx_region_customers,
    "published_tables": published_tables,
    "bucketed_upsert": bucketed_upsert,
    "csv_arrival_orders": csv_arrival_orders,
    "csv_record_counts": csv_record_counts,
}
