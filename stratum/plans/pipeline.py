"""The whole medallion run as a few Spark jobs.

1. bronze is written as a new version (job 1);
2. the staged rows are computed once from the written bronze and written
   once, partitioned by layer: ``layer=silver`` is the silver table and
   ``layer=rejected`` the quarantine table (job 2);
3. gold is aggregated from the silver partition and written (job 3);
4. the three versions are committed together by one log append, so readers
   see the whole run or none of it;
5. every report number comes from one aggregate over the written staged
   rows (job 4).

Writing a layer and reading it back cuts the lineage, so a lost executor
only recomputes work since the last written table.  Output paths come from
the caller and should be on shared storage.
"""

from __future__ import annotations

import datetime as _dt
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators import checks, medallion, reports
from stratum.operators.contracts import CONTRACTS, divert_broken, schema_faults
from stratum.operators.medallion import ORDER_SPEC, StageSpec
from stratum.sinks import snapshots

STAGED = "staged"


@dataclass
class RunResult:
    versions: dict[str, int]
    metrics: dict
    expectations: list[dict]
    reasons: list[str]


def read_published(spark: SparkSession, root: str, layer: str, version: int | None = None) -> DataFrame:
    """A published layer by name: bronze and gold are tables of their own,
    silver and rejected are the two partitions of the staged table."""
    name = layer.lower()
    if name in ("silver", "rejected"):
        staged = snapshots.read_layer(spark, root, STAGED, version)
        part = staged.filter(F.col("layer") == name).drop("layer")
        # silver in its contract shape (row_rank = 1); rejected keeps is_latest
        return medallion.silver_columns(part) if name == "silver" else part
    if name in ("bronze", "gold", STAGED, "malformed"):
        return snapshots.read_layer(spark, root, name, version)
    raise KeyError(f"unknown layer {layer!r}")


def run_pipeline(
    source: DataFrame,
    root: str,
    spec: StageSpec = ORDER_SPEC,
    ingested_at: str | _dt.datetime | None = None,
    malformed: DataFrame | None = None,
) -> RunResult:
    spark = source.sparkSession
    committed = snapshots.latest_versions(spark, root)
    done: dict[str, snapshots.Written] = {}

    def publish(df: DataFrame, table: str, contract: str | None = None, **how) -> DataFrame:
        version = committed.get(table, -1) + 1
        done[table] = snapshots.write_version(
            df, root, table, version, contract=CONTRACTS[contract] if contract else None, **how
        )
        return snapshots.read_written(spark, root, done[table])

    bronze = publish(medallion.bronze(source, ingested_at), "bronze", "bronze_orders")

    # Rows that no rule rejects but that break silver's promises are quarantined, not committed.
    staged = divert_broken(medallion.stage(bronze, spec), CONTRACTS["silver_orders"])
    staged = publish(staged, STAGED, "staged_orders", partition_by=["layer"])

    silver = medallion.silver_columns(staged.filter(F.col("layer") == "silver").drop("layer"))
    if faults := schema_faults(silver, CONTRACTS["silver_orders"]):
        raise snapshots.ContractError(f"silver breaks its contract: {'; '.join(faults)}")
    # Gold has one row per region: one output file, gathered by a shuffle of
    # those few rows so the aggregation upstream keeps its parallelism.
    publish(medallion.gold(silver).repartition(1), "gold", "gold_region_kpis")
    if malformed is not None:
        # Records the source scan could not read (see
        # read_order_csv_quarantined) are kept with the run that met them.
        publish(malformed, "malformed")

    # The run's versions become visible together, with one log append.
    snapshots.commit(spark, root, list(done.values()))

    # One aggregate over the written staged rows gives every report number.
    counts = reports.staged_counts(staged, spec.rules, with_reasons=True).first().asDict()
    return RunResult(
        {t: w.version for t, w in done.items()},
        reports.metrics_from_counts(counts, len(done)),
        reports.expectations_from_counts(counts, spec.rules),
        counts["reasons"],
    )


# What each published table promises (shown in the table registry).
TABLE_CONTRACTS = {
    "bronze": "every source row, with ingest time and source rank",
    "staged": "every bronze row with its quality issue, version flag and one rejection reason; "
    "partition layer=silver is the accepted table, layer=rejected the quarantine",
    "gold": "one KPI row per region from accepted rows only",
    "malformed": "records that the source scan could not read, with the run that met them",
}
# Names the shape of the published quality report.
REPORT_SCHEMA = "stratum-quality-report-v1"


def table_registry(spark: SparkSession, root: str) -> DataFrame:
    """Per published table: latest version, its rows, when it was written
    and its contract (A-11).  Reads only the small commit logs."""
    parts = []
    for name, contract in TABLE_CONTRACTS.items():
        log = snapshots.table_versions(spark, root, name)
        parts.append(
            log.groupBy("table_name")
            .agg(F.max_by(F.struct("version", "rows", "written_at"), "version").alias("v"))
            .select(
                "table_name",
                F.col("v.version").alias("version"),
                F.col("v.rows").alias("rows"),
                F.col("v.written_at").alias("written_at"),
                F.lit(contract).alias("contract"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def quality_report_json(result: RunResult) -> str:
    """JSON rendering of the quality report (K-9, P-10)."""
    return json.dumps(
        {
            "schema": REPORT_SCHEMA,
            "summary": {
                "acceptedRows": result.metrics["silver_rows"],
                "failedRows": result.metrics["rejected_rows"],
                "qualityPassRatePct": result.metrics["quality_pass_rate_pct"],
            },
            "expectations": result.expectations,
            "rejectedReasons": result.reasons,
        },
        indent=2,
    )


def validation_report(spark: SparkSession, root: str) -> DataFrame:
    """Validation cases over the latest published silver, against bronze."""
    return checks.validation_cases(read_published(spark, root, "silver"), read_published(spark, root, "bronze"))
