"""Quality rules as data, compiled into one first-match ``CASE`` expression.

A rule names the predicate that makes a row *fail*.  Rules are checked in
list order and the first one that is TRUE labels the row (P-7); a predicate
that is NULL (e.g. ``NULL <= 0``) does not fire, exactly like ``WHEN`` does.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    fails: str | Column | None
    layer: str = "silver"
    description: str = ""

    def fail_col(self) -> Column:
        if self.fails is None:
            raise ValueError(f"rule {self.name!r} has no row predicate")
        return F.expr(self.fails) if isinstance(self.fails, str) else self.fails

    def pass_col(self) -> Column:
        # Three-valued NOT: a NULL test is neither passed nor failed.
        return ~self.fail_col()


# The order-contract rules, their labels and descriptions, in
# the order they are applied.  The last one is the deduplication rule; it has
# no row predicate because it depends on the other versions of the order.
ORDER_RULES: tuple[Rule, ...] = (
    Rule(
        "customer_present",
        "missing_customer",
        "customer_id IS NULL",
        description="customer_id must be present before rows graduate into silver.",
    ),
    Rule(
        "region_present",
        "missing_region",
        "region IS NULL",
        description="region is required for downstream territory KPIs.",
    ),
    Rule(
        "positive_amount",
        "non_positive_amount",
        "amount <= 0",
        description="non-positive revenue is isolated into rejected quarantine rows.",
    ),
)
LATEST_RULE = Rule(
    "latest_order_record",
    "stale_duplicate",
    None,
    description="only the latest duplicate order version can move into silver.",
)


def first_match(rules: tuple[Rule, ...] | list[Rule]) -> Column:
    """One CASE expression: label of the first failing rule, else NULL."""
    expr: Column | None = None
    for rule in rules:
        if rule.fails is None:
            continue
        if expr is None:
            expr = F.when(rule.fail_col(), F.lit(rule.label))
        else:
            expr = expr.when(rule.fail_col(), F.lit(rule.label))
    if expr is None:
        return F.lit(None).cast("string")
    return expr.otherwise(F.lit(None).cast("string"))


def reason_precedence(issue: Column, is_latest: Column, stale_label: str = LATEST_RULE.label) -> Column:
    """Field issue first, else the stale-version label, else NULL (P-8)."""
    return F.coalesce(issue, F.when(~is_latest, F.lit(stale_label)))


def rules_from_records(records: list[dict], defaults: tuple[Rule, ...] = ORDER_RULES) -> list[Rule]:
    """Build rules from config records (``name, layer, rule, rejected_label``
    and an optional SQL ``predicate``).  A record without a predicate takes
    the predicate of the built-in rule of the same name."""
    known = {r.name: r for r in (*defaults, LATEST_RULE)}
    out: list[Rule] = []
    for rec in records:
        base = known.get(rec["name"])
        predicate = rec.get("predicate") or (base.fails if base else None)
        out.append(
            Rule(
                name=rec["name"],
                label=rec.get("rejected_label") or (base.label if base else rec["name"]),
                fails=predicate,
                layer=rec.get("layer", "silver"),
                description=rec.get("rule", base.description if base else ""),
            )
        )
    return out


def load_rules(spark: SparkSession, path: str) -> list[Rule]:
    """Read a JSON array of rule records (S-3).  A rule list is configuration
    of a handful of entries, so it is brought to the driver once."""
    df = spark.read.option("multiLine", True).json(path)
    return rules_from_records([row.asDict() for row in df.collect()])


def rules_to_json(rules: list[Rule]) -> str:
    """Rules as a JSON config array; a SQL predicate is kept as ``predicate``
    (Column predicates cannot be written out and are left to the defaults)."""
    return json.dumps(
        [
            {
                "name": r.name,
                "layer": r.layer,
                "rule": r.description,
                "rejected_label": r.label,
                **({"predicate": r.fails} if isinstance(r.fails, str) else {}),
            }
            for r in rules
        ],
        indent=2,
    )
