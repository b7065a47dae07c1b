"""Command line: run the medallion pipeline and write its report documents.

    python -m stratum run --csv orders.csv --out /lake [--reports /lake/reports]
    python -m stratum run --sf-dir /root/testdata/sf0.1 --out /lake
    python -m stratum reports --out /lake [--version N]

``run`` publishes bronze, staged (silver + rejected) and gold as one new
version under ``--out`` and writes JSON reports next to it: the quality
report (summary, expectations, rejected preview), bronze/silver/gold
previews and a run summary with the table registry.  Only preview rows and
counts reach the driver.  ``--quarantine`` keeps malformed CSV records as
their own table instead of stopping the run.
"""

from __future__ import annotations

import argparse
import os
import sys

from stratum.operators import medallion, reports
from stratum.plans import pipeline
from stratum.session import build_session
from stratum.sinks.catalog import write_json_report
from stratum.sources.orders import order_source, read_order_csv, read_order_csv_quarantined

PREVIEW_SIZES = {"bronze": 5, "silver": 5, "gold": 10, "rejected": 10}
PREVIEW_ORDER = {
    "bronze": ["order_id", "source_rank"],
    "silver": ["order_id"],
    "gold": ["region"],
    "rejected": ["order_id", "source_rank"],
}
PREVIEW_COLUMNS = {
    "silver": ["order_id", "customer_id", "region", "status", "amount", "currency"],
    "rejected": ["order_id", "customer_id", "region", "amount", "rejection_reason"],
}


def _preview(spark, root: str, layer: str, version: int | None) -> list[dict]:
    df = pipeline.read_published(spark, root, layer, version)
    cols = PREVIEW_COLUMNS.get(layer)
    return reports.records(reports.preview(df, PREVIEW_ORDER[layer], PREVIEW_SIZES[layer], cols))


def write_reports(
    spark, root: str, out_dir: str, result: pipeline.RunResult | None = None, version: int | None = None
) -> None:
    """Write the report documents for the given run, the given version of all
    layers, or the latest one."""
    staged_version = result.versions["staged"] if result else version
    if result is None:
        counts = reports.staged_counts(
            pipeline.read_published(spark, root, pipeline.STAGED, version), with_reasons=True
        ).first().asDict()
        metrics = reports.metrics_from_counts(counts, pipeline.table_registry(spark, root).count())
        expectations = reports.expectations_from_counts(counts)
        reasons = counts["reasons"]
    else:
        metrics, expectations, reasons = result.metrics, result.expectations, result.reasons
    generated = medallion.run_timestamp()
    write_json_report(
        spark,
        os.path.join(out_dir, "quality-report.json"),
        {
            "schema": pipeline.REPORT_SCHEMA,
            "generatedAt": generated,
            "summary": {
                "acceptedRows": metrics["silver_rows"],
                "failedRows": metrics["rejected_rows"],
                "qualityPassRatePct": metrics["quality_pass_rate_pct"],
            },
            "expectations": expectations,
            "rejectedReasons": reasons,
            "rejectedPreview": _preview(spark, root, "rejected", staged_version),
        },
    )
    versions = result.versions if result else {}
    for layer in ("bronze", "silver", "gold"):
        shown = versions.get(pipeline.STAGED if layer == "silver" else layer, version)
        write_json_report(
            spark,
            os.path.join(out_dir, f"{layer}-preview.json"),
            {"layer": layer, "rows": _preview(spark, root, layer, shown)},
        )
    write_json_report(
        spark,
        os.path.join(out_dir, "run-summary.json"),
        {
            "schema": "stratum-run-summary-v1",
            "generatedAt": generated,
            "summary": {
                "sourceRows": metrics["source_rows"],
                "bronzeRows": metrics["bronze_rows"],
                "silverAcceptedRows": metrics["silver_rows"],
                "silverRejectedRows": metrics["rejected_rows"],
                "goldRows": metrics["gold_rows"],
                "tables": metrics["tables"],
                "qualityPassRatePct": metrics["quality_pass_rate_pct"],
            },
            "kpis": [name for name, _ in medallion.REGION_KPIS],
            "tables": reports.records(pipeline.table_registry(spark, root)),
        },
    )


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m stratum")
    sub = ap.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="run the pipeline and write reports")
    src = run.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv", help="order CSV file or folder")
    src.add_argument("--sf-dir", help="folder of the TPC-H-like parquet tables")
    run.add_argument("--out", required=True, help="root folder of the published tables")
    run.add_argument("--reports", help="folder for the JSON reports (default: <out>/reports)")
    run.add_argument("--quarantine", action="store_true", help="keep malformed CSV records instead of failing")
    rep = sub.add_parser("reports", help="write reports for the latest published version")
    rep.add_argument("--out", required=True)
    rep.add_argument("--reports")
    rep.add_argument("--version", type=int, help="the version of the layers (default: the latest)")
    ap.add_argument("--master", help="Spark master (default: the submitter's)")
    args = ap.parse_args(argv)

    spark = build_session(args.master, app_name="stratum")
    report_dir = args.reports or os.path.join(args.out, "reports")
    if args.command == "run":
        malformed = None
        if args.csv and args.quarantine:
            source, malformed = read_order_csv_quarantined(spark, args.csv)
        elif args.csv:
            source = read_order_csv(spark, args.csv)
        else:
            source = order_source(spark, args.sf_dir)
        result = pipeline.run_pipeline(source, args.out, malformed=malformed)
        write_reports(spark, args.out, report_dir, result)
    else:
        write_reports(spark, args.out, report_dir, version=args.version)
    print(os.path.join(report_dir, "quality-report.json"))
    return 0


if __name__ == "__main__":
    sys.exit(main())
