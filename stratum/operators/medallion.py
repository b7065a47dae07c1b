"""Bronze -> staged -> silver / rejected -> gold, as DataFrame functions.

* ``bronze`` keeps every source row and stamps the run time (P-3, P-6).
* ``stage`` labels each row with the first failing rule (P-7), flags whether
  it is its order's newest version (W-1/W-2), and sets the rejection reason
  with field issues ahead of staleness (P-8).  Versions are compared over all
  bronze rows, failures included, so a newest version that fails a rule
  still masks an older valid one (the order leaves silver).
* ``split`` gives the two disjoint halves (F-1, F-2, U-2).
* ``silver`` computes accepted rows straight from bronze - the newest version
  per key, limited map side before its one shuffle - and equals
  ``split(stage(...))[0]`` without staging the rejected rows.
* ``gold`` aggregates silver into one KPI row per region (A-1..A-6).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions.rules import LATEST_RULE, ORDER_RULES, Rule, first_match, reason_precedence
from stratum.operators.dedup import flag_latest, latest_per_key

BRONZE_COLUMNS = (
    "order_id",
    "customer_id",
    "region",
    "channel",
    "status",
    "amount",
    "currency",
    "order_ts",
    "ingested_at",
    "source_rank",
)
ORDER_KEYS = ("order_id",)
# Newest first: order_ts DESC NULLS LAST, then source_rank DESC.
ORDER_VERSION = ("order_ts", "source_rank")


@dataclass(frozen=True)
class StageSpec:
    """What makes a row valid and which version of a key is current."""

    rules: tuple[Rule, ...] = ORDER_RULES
    keys: tuple[str, ...] = ORDER_KEYS
    version: tuple[str, ...] = ORDER_VERSION
    stale_label: str = LATEST_RULE.label


ORDER_SPEC = StageSpec()


def run_timestamp(value: str | _dt.datetime | None = None) -> str:
    """The run's ingest time, fixed once per run (to whole seconds, UTC)."""
    if value is None:
        value = _dt.datetime.now(_dt.timezone.utc).replace(microsecond=0, tzinfo=None)
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    return value


def bronze(source: DataFrame, ingested_at: str | _dt.datetime | None = None) -> DataFrame:
    """Every source row, with the constant run time attached."""
    stamp = F.lit(run_timestamp(ingested_at)).cast("timestamp_ntz")
    return source.withColumn("ingested_at", stamp).select(*BRONZE_COLUMNS)


def stage(bronze_df: DataFrame, spec: StageSpec = ORDER_SPEC, versions: DataFrame | None = None) -> DataFrame:
    """Bronze rows with ``quality_issue``, ``is_latest`` and ``rejection_reason``.

    ``versions`` optionally gives the key and version columns of every bronze
    row from a cheaper plan (see ``flag_latest``)."""
    labelled = bronze_df.withColumn("quality_issue", first_match(spec.rules))
    flagged = flag_latest(labelled, spec.keys, spec.version, versions=versions)
    return flagged.withColumn(
        "rejection_reason",
        reason_precedence(F.col("quality_issue"), F.col("is_latest"), spec.stale_label),
    )


def split(staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): complementary filters on the reason."""
    accepted = staged.filter(F.col("rejection_reason").isNull())
    rejected = staged.filter(F.col("rejection_reason").isNotNull())
    return accepted, rejected


def silver_columns(df: DataFrame) -> DataFrame:
    """Silver's stored shape: bronze columns plus the three helper columns.
    ``row_rank`` is the version rank, always 1 for an accepted row."""
    cols = [c for c in df.columns if c not in ("quality_issue", "is_latest", "rejection_reason")]
    return df.select(
        *cols,
        F.col("quality_issue"),
        F.lit(1).alias("row_rank"),
        F.lit(None).cast("string").alias("rejection_reason"),
    )


def silver(bronze_df: DataFrame, spec: StageSpec = ORDER_SPEC) -> DataFrame:
    """Accepted rows: the newest version of each key, if it breaks no rule.

    ``row_number() ... = 1`` keeps the newest version per key (a partial
    group limit runs before the shuffle), then a filter drops keys whose
    newest version fails.  No join back to bronze is needed for this side.
    """
    labelled = bronze_df.withColumn("quality_issue", first_match(spec.rules))
    newest = latest_per_key(labelled, spec.keys, spec.version)
    return silver_columns(newest.filter(F.col("quality_issue").isNull()))


def rejected(bronze_df: DataFrame, spec: StageSpec = ORDER_SPEC, versions: DataFrame | None = None) -> DataFrame:
    """Rejected rows with their reason (the persisted quarantine table, D-1)."""
    return split(stage(bronze_df, spec, versions))[1]


# Gold KPIs, as SQL aggregate text so that the same definitions serve the
# DataFrame plan and the report catalogue.  Fixed values: the contract's
# column names and meaning; money is summed exactly as DECIMAL(18,2) and only
# the final value is a DOUBLE.
REGION_KPIS: tuple[tuple[str, str], ...] = (
    ("gross_revenue_usd", "CAST(round(sum(amount), 2) AS DOUBLE)"),
    ("accepted_orders", "CAST(count(*) AS BIGINT)"),
    ("completed_orders", "CAST(count_if(status = 'completed') AS BIGINT)"),
    ("pipeline_orders", "CAST(count_if(status = 'processing') AS BIGINT)"),
    ("distinct_customers", "CAST(count(DISTINCT customer_id) AS BIGINT)"),
)
GOLD_KEYS = ("region",)


def aggregate(
    df: DataFrame,
    keys: Sequence[str] = GOLD_KEYS,
    kpis: Sequence[tuple[str, str]] = REGION_KPIS,
) -> DataFrame:
    """One row per key with the named KPI aggregates (hash aggregate with a
    partial, map-side step; a distinct count adds one (key, value) shuffle)."""
    return df.groupBy(*keys).agg(*[F.expr(sql).alias(name) for name, sql in kpis])


def gold(silver_df: DataFrame) -> DataFrame:
    """Region KPI table; sorted only when previewed."""
    return aggregate(silver_df)
