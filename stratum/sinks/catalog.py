"""Catalog tables: safe identifiers, create-if-missing, keyed upsert into a
table, the bounded read-back and the optional JDBC export (K-3..K-8, S-11).

Identifiers are checked once on the driver; values never enter SQL text.
"""

from __future__ import annotations

import json
import logging
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators.upsert import keyed_upsert
from stratum.session import ensure_checkpoint_dir

log = logging.getLogger(__name__)

# An unquoted identifier is a letter or underscore followed by
# up to 254 letters, digits, underscores or dollar signs.
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_$]{0,254}")

GOLD_DDL_COLUMNS = (
    "region STRING NOT NULL, "
    "gross_revenue_usd DOUBLE NOT NULL, "
    "accepted_orders BIGINT NOT NULL, "
    "completed_orders BIGINT NOT NULL, "
    "pipeline_orders BIGINT NOT NULL, "
    "distinct_customers BIGINT NOT NULL, "
    "loaded_at TIMESTAMP_NTZ"
)
GOLD_COLUMNS = (
    "region",
    "gross_revenue_usd",
    "accepted_orders",
    "completed_orders",
    "pipeline_orders",
    "distinct_customers",
    "loaded_at",
)


def validated_identifier(kind: str, value: str) -> str:
    """``value`` if it is a plain identifier, else ``ValueError``."""
    if not isinstance(value, str) or not IDENTIFIER.fullmatch(value):
        raise ValueError(f"{kind} must be a plain identifier, got {value!r}")
    return value


def quote_identifier(name: str) -> str:
    """Back-tick quote one name part, doubling any back-tick inside it."""
    return "`" + name.replace("`", "``") + "`"


def qualified_name(*parts: str) -> str:
    return ".".join(quote_identifier(validated_identifier("name part", p)) for p in parts)


def ensure_namespace(spark: SparkSession, database: str) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` (K-6)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {qualified_name(database)}")


def ensure_gold_table(spark: SparkSession, database: str, table: str, fmt: str = "parquet") -> str:
    """Create the gold KPI table if it is missing (K-5); return its name."""
    ensure_namespace(spark, database)
    name = qualified_name(database, table)
    validated_identifier("format", fmt)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({GOLD_DDL_COLUMNS}) USING {fmt}")
    return name


def upsert_into_table(spark: SparkSession, table: str, source: DataFrame, keys: Sequence[str]) -> int:
    """Keyed upsert of ``source`` into catalog table ``table`` (K-3, K-4).

    Returns the number of updated plus inserted rows; an empty source writes
    nothing and returns 0.  The source is computed once, into the session's
    shared checkpoint folder; the merged result is checkpointed there too
    before the table is overwritten, so the write never reads the files it
    replaces and a failed one can be repeated from it.
    """
    ensure_checkpoint_dir(spark)
    source = source.checkpoint(eager=True)
    affected = source.count()
    if not affected:
        return 0
    target = spark.table(table)
    stamp = F.current_timestamp().cast("timestamp_ntz")
    merged = keyed_upsert(target, source.select(*[c for c in source.columns if c != "loaded_at"]), keys, stamp=stamp)
    merged.select(*target.columns).checkpoint(eager=True).write.insertInto(table, overwrite=True)
    return affected


@dataclass(frozen=True)
class ExportTarget:
    """Where gold may be exported to, and what switches the export on."""

    name: str
    activation: str
    role: str


def load_targets(spark: SparkSession, path: str) -> tuple[ExportTarget, ...]:
    """Read a JSON array of export targets (S-3), configuration of a handful of
    entries: ``name``, ``activation`` and ``role``.  A record that lacks a name
    is refused."""
    found = [r.asDict() for r in spark.read.option("multiLine", True).json(path).collect()]
    if any(not r.get("name") for r in found):
        raise ValueError(f"an export target of {path} has no name")
    return tuple(ExportTarget(r["name"], r.get("activation") or "", r.get("role") or "") for r in found)


def merge_statement(target: Sequence[str], staging: Sequence[str], keys: Sequence[str], columns: Sequence[str]) -> str:
    """The statement a warehouse runs to merge the staging table that
    ``export_jdbc`` fills into its target (K-8).  ``target`` and ``staging``
    are name parts; every name is checked before it enters the text.  Rows of
    the target whose key is not in the staging table stay as they are."""
    names = {c: validated_identifier("column", c) for c in (*keys, *columns)}
    on = " AND ".join(f"t.{names[k]} = s.{names[k]}" for k in keys)
    rest = [names[c] for c in columns if c not in keys]
    every = [*[names[k] for k in keys], *rest]
    dotted = lambda parts: ".".join(validated_identifier("name part", p) for p in parts)
    lines = [f"MERGE INTO {dotted(target)} AS t USING {dotted(staging)} AS s ON {on}"]
    if rest:
        lines.append("WHEN MATCHED THEN UPDATE SET " + ", ".join(f"{c} = s.{c}" for c in rest))
    lines.append(f"WHEN NOT MATCHED THEN INSERT ({', '.join(every)}) VALUES ({', '.join('s.' + c for c in every)})")
    return "\n".join(lines)


def bounded_read(spark: SparkSession, table: str, limit: int = 20, order_by: str = "region") -> DataFrame:
    """``SELECT <gold columns> ... ORDER BY region LIMIT n`` with ``n`` clamped
    to 1..1000 (S-11, T-4)."""
    n = max(1, min(int(limit), 1000))
    return spark.table(table).select(*GOLD_COLUMNS).orderBy(order_by).limit(n)


def export_jdbc(
    df: DataFrame,
    url: str | None,
    table: str,
    properties: dict[str, str] | None = None,
) -> bool:
    """Optional export to a JDBC database (K-8): ``False`` when not
    configured, when there is nothing to export, or on any failure; it never
    raises.  ``table`` is a staging table: each export replaces its rows, and
    ``merge_statement`` gives the statement that merges it into the target.
    Rows are written by the executors in parallel."""
    if not url:
        return False
    try:
        validated_identifier("table", table.split(".")[-1])
        if df.limit(1).count() == 0:
            return False
        df.write.option("truncate", True).jdbc(url, table, mode="overwrite", properties=properties or {})
        return True
    except Exception:  # noqa: BLE001 - the export must never fail the run
        log.warning("JDBC export to %s failed", table, exc_info=True)
        return False


def write_json_report(spark: SparkSession, path: str, payload: dict) -> None:
    """Write one report document (K-9) to any path that Spark reaches, through
    its file system, as one file that replaces an older one."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(json.dumps(payload, indent=2, ensure_ascii=False).encode()))
    finally:
        out.close()
