"""Column contracts of the published tables, checked on the data (D-3)."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The published column contracts (name, Spark type, nullable).
CONTRACTS: dict[str, tuple[tuple[str, str, bool], ...]] = {
    "gold_region_kpis": (
        ("region", "string", False),
        ("gross_revenue_usd", "double", False),
        ("accepted_orders", "bigint", False),
        ("completed_orders", "bigint", False),
        ("pipeline_orders", "bigint", False),
        ("distinct_customers", "bigint", False),
    ),
    "silver_orders": (
        ("order_id", "string", True),
        ("customer_id", "string", False),
        ("region", "string", False),
        ("channel", "string", True),
        ("status", "string", True),
        ("amount", "decimal(18,2)", True),
        ("currency", "string", True),
        ("order_ts", "timestamp_ntz", True),
        ("ingested_at", "timestamp_ntz", False),
        ("source_rank", "bigint", False),
        ("quality_issue", "string", True),
        ("row_rank", "int", False),
        ("rejection_reason", "string", True),
    ),
    "bronze_orders": (
        ("order_id", "string", True),
        ("customer_id", "string", True),
        ("region", "string", True),
        ("channel", "string", True),
        ("status", "string", True),
        ("amount", "decimal(18,2)", True),
        ("currency", "string", True),
        ("order_ts", "timestamp_ntz", True),
        ("ingested_at", "timestamp_ntz", False),
        ("source_rank", "bigint", False),
    ),
    "staged_orders": (
        ("order_id", "string", True),
        ("customer_id", "string", True),
        ("region", "string", True),
        ("channel", "string", True),
        ("status", "string", True),
        ("amount", "decimal(18,2)", True),
        ("currency", "string", True),
        ("order_ts", "timestamp_ntz", True),
        ("ingested_at", "timestamp_ntz", False),
        ("source_rank", "bigint", False),
        ("quality_issue", "string", True),
        ("is_latest", "boolean", False),
        ("rejection_reason", "string", True),
        ("layer", "string", False),
    ),
}

#: Reason of rows that no rule rejects but that break a NOT NULL promise.
BROKEN_LABEL = "contract_violation"


def breaks(contract: Sequence[tuple[str, str, bool]], columns: Sequence[str]) -> Column:
    """Whether a row is NULL where the contract promises a value, of the columns that are there."""
    broken = F.lit(False)
    for name, _, nullable in contract:
        if not nullable and name in columns:
            broken = broken | F.col(name).isNull()
    return broken


def divert_broken(staged: DataFrame, contract: Sequence[tuple[str, str, bool]]) -> DataFrame:
    """Staged rows with ``layer``: accepted rows that break ``contract`` are
    rejected with a reason of their own, before anything is written."""
    reason = F.when(
        F.col("rejection_reason").isNull() & breaks(contract, [c for c in staged.columns if c != "rejection_reason"]),
        F.lit(BROKEN_LABEL),
    ).otherwise(F.col("rejection_reason"))
    diverted = staged.withColumn("rejection_reason", reason)
    return diverted.withColumn("layer", F.when(F.col("rejection_reason").isNull(), F.lit("silver")).otherwise(F.lit("rejected")))


#: Types in order of width: each holds every value of those before it.
_WIDER = (("tinyint", "smallint", "int", "bigint", "decimal(20,0)"), ("float", "double"), ("date", "timestamp_ntz"))


def _type_change(old: T.DataType, new: T.DataType) -> str | None:
    a, b = old.simpleString(), new.simpleString()
    if a == b:
        return None
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        whole, more = new.precision - new.scale - (old.precision - old.scale), new.scale - old.scale
        return "widened" if whole >= 0 and more >= 0 else "narrowed" if whole <= 0 and more <= 0 else "retyped"
    for chain in _WIDER:
        if a in chain and b in chain:
            return "widened" if chain.index(a) < chain.index(b) else "narrowed"
    return "retyped"


#: Changes that readers of the older schema survive, and writers of the newer can make.
COMPATIBLE = ("added_nullable", "widened", "required")


def schema_changes(old: T.StructType, new: T.StructType) -> list[tuple[str, str, bool]]:
    """``(column, change, compatible)`` between two versions' schemas, in the newer one's order.

    ``added_nullable`` and ``added_required`` columns, ``dropped`` ones,
    ``widened``, ``narrowed`` and otherwise ``retyped`` types; ``optional`` if
    a column may now be NULL, ``required`` if it may no longer be.
    """
    was, now = {f.name: f for f in old.fields}, {f.name: f for f in new.fields}
    found = []
    for name, field in now.items():
        if name not in was:
            found.append((name, "added_nullable" if field.nullable else "added_required"))
            continue
        if change := _type_change(was[name].dataType, field.dataType):
            found.append((name, change))
        if field.nullable != was[name].nullable:
            found.append((name, "optional" if field.nullable else "required"))
    found += [(name, "dropped") for name in was if name not in now]
    return [(name, change, change in COMPATIBLE) for name, change in found]


def version_changes(spark: SparkSession, versions: DataFrame) -> DataFrame:
    """``table_name, version, column_name, change, compatible`` of every two
    neighbouring versions in a commit log (``table_name, version, schema``).
    A log has one row a commit; its schemas are compared on the driver."""
    rows, last = [], {}
    for r in versions.select("table_name", "version", "schema").orderBy("table_name", "version").collect():
        schema = T.StructType.fromJson(json.loads(r.schema))
        if r.table_name in last:
            rows += [(r.table_name, r.version, *c) for c in schema_changes(last[r.table_name], schema)]
        last[r.table_name] = schema
    return spark.createDataFrame(rows, "table_name string, version bigint, column_name string, change string, compatible boolean")


def type_agrees(declared: str, found: str) -> bool:
    """A declared decimal(p,s) promises money: text sources keep more digits."""
    return found == declared or declared.startswith("decimal") and found.startswith("decimal")


def schema_faults(df: DataFrame, contract: Sequence[tuple[str, str, bool]]) -> list[str]:
    """Missing, extra and mistyped columns, without running a job."""
    actual = dict(df.dtypes)
    named = [name for name, _, _ in contract]
    faults = [f"missing column {n}" for n in named if n not in actual]
    faults += [f"extra column {n}" for n in actual if n not in named]
    faults += [f"{n} is {actual[n]}, not {t}" for n, t, _ in contract if n in actual and not type_agrees(t, actual[n])]
    return faults


def contract_violations(
    df: DataFrame,
    table: str,
    contract: Sequence[tuple[str, str, bool]] | None = None,
) -> DataFrame:
    """One row per contract column: declared and actual type, whether they
    agree, and how many rows break a NOT NULL promise (one pass).  A column
    that the contract does not know is a row with no declared type."""
    contract = contract if contract is not None else CONTRACTS[table]
    actual = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, (name, _, nullable) in enumerate(contract):
        if name in actual and not nullable:
            aggs.append(F.count_if(F.col(name).isNull()).alias(f"n{i}"))
        else:
            aggs.append(F.lit(0).cast("bigint").alias(f"n{i}"))
    one = df.agg(*aggs)
    entries = []
    for i, (name, declared, nullable) in enumerate(contract):
        found = actual.get(name, "missing")
        entries.append(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(name).alias("column_name"),
                F.lit(declared).alias("declared_type"),
                F.lit(found).alias("actual_type"),
                F.lit(nullable).alias("nullable"),
                F.lit(type_agrees(declared, found)).alias("type_ok"),
                F.col(f"n{i}").alias("null_violations"),
            )
        )
    for name in [c for c in df.columns if c not in {n for n, _, _ in contract}]:
        entries.append(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(name).alias("column_name"),
                F.lit("none").alias("declared_type"),
                F.lit(actual[name]).alias("actual_type"),
                F.lit(True).alias("nullable"),
                F.lit(False).alias("type_ok"),
                F.lit(0).cast("bigint").alias("null_violations"),
            )
        )
    return one.select(F.inline(F.array(*entries)))
