"""Gold kept up to date from changes alone (D-4, A-1..A-6).

Sums and counts take changes as signed rows: what left a table counts down,
what came counts up.  A distinct count can only fall if it is known how often
each value stands, so the state keeps one counted row a (region, customer)
pair beside the KPI row a region.  A version's gold is made from the state of
the version before and the rows that differ; nothing else is read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.operators.checks import content_differences

COLUMNS = ("region", "customer_id", "status", "amount")
#: The state's additive measures of a row.
_MEASURES = ("revenue", "accepted_orders", "completed_orders", "pipeline_orders", "priced_orders")


@dataclass
class GoldState:
    """``kpis``: a region's additive measures.  ``pairs``: ``region, customer_id, n`` of accepted rows."""

    kpis: DataFrame
    pairs: DataFrame


def signed_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """The rows that gold depends on and that differ between two silver versions, with a signed ``times``."""
    found = content_differences(old, new, COLUMNS)
    times = F.when(F.col("side") == "lost", -F.col("copies")).otherwise(F.col("copies"))
    return found.select(*COLUMNS, times.alias("times"))


def _measures(times: Column) -> list[Column]:
    parts = {
        "revenue": F.coalesce(F.col("amount"), F.lit(0)) * times,
        "accepted_orders": times,
        "completed_orders": F.when(F.col("status") == "completed", times).otherwise(0),
        "pipeline_orders": F.when(F.col("status") == "processing", times).otherwise(0),
        "priced_orders": F.when(F.col("amount").isNotNull(), times).otherwise(0),
    }
    return [F.sum(parts[name]).alias(name) for name in _MEASURES]


def _state(signed: DataFrame) -> GoldState:
    kpis = signed.groupBy("region").agg(*_measures(F.col("times")))
    pairs = signed.groupBy("region", "customer_id").agg(F.sum("times").alias("n"))
    return GoldState(kpis, pairs)


def gold_state(silver: DataFrame) -> GoldState:
    """The state of a silver version, from all its rows."""
    return _state(silver.select(*COLUMNS, F.lit(1).cast("bigint").alias("times")))


def apply_changes(state: GoldState, changes: DataFrame) -> GoldState:
    """The next version's state: signed measures are added to the regions and pairs that they touch.

    Regions and pairs whose rows are all gone leave the state.  Every sum is
    pre-combined, so a region that holds most changes is a row a task.
    """
    new = _state(changes)
    kpis = state.kpis.unionByName(new.kpis).groupBy("region").agg(*[F.sum(m).alias(m) for m in _MEASURES])
    pairs = state.pairs.unionByName(new.pairs).groupBy("region", "customer_id").agg(F.sum("n").alias("n"))
    return GoldState(kpis.filter("accepted_orders > 0"), pairs.filter("n > 0"))


def gold_of(state: GoldState) -> DataFrame:
    """The gold KPI table that a state stands for.

    The pairs' rows and the KPI rows meet in a union, so a region without a
    customer, and one that is NULL, keep their rows.
    """
    customers = state.pairs.groupBy("region").agg(F.count("customer_id").alias("distinct_customers"))
    both = state.kpis.unionByName(customers, allowMissingColumns=True)
    merged = both.groupBy("region").agg(*[F.max(m).alias(m) for m in (*_MEASURES, "distinct_customers")])
    revenue = F.when(F.col("priced_orders") > 0, F.round("revenue", 2).cast("double"))
    return merged.select(
        "region",
        revenue.alias("gross_revenue_usd"),
        *[F.col(m).cast("bigint").alias(m) for m in _MEASURES[1:4]],
        F.coalesce("distinct_customers", F.lit(0)).cast("bigint").alias("distinct_customers"),
    )


#: log2 of a sketch's registers: a relative standard error of 1.04 / sqrt(2^12), 1.6 %.
SKETCH_BITS = 12
#: Four standard errors.
SKETCH_BOUND = 4 * 1.04 / 2 ** (SKETCH_BITS / 2)


def customer_sketches(silver: DataFrame) -> DataFrame:
    """``region, day, customers``: a mergeable sketch of the distinct customers of each region and day (A-6).

    Sketches have a fixed size and are combined before the shuffle; a new day
    adds its own and leaves the others alone.
    """
    day = F.to_date("order_ts").alias("day")
    known = silver.filter(F.col("customer_id").isNotNull())
    return known.groupBy("region", day).agg(F.hll_sketch_agg("customer_id", SKETCH_BITS).alias("customers"))


def approx_customers(sketches: DataFrame, *keys: str) -> DataFrame:
    """``keys, approx_customers``: sketches rolled up, exact to ``SKETCH_BOUND`` with four standard errors."""
    union = F.hll_union_agg("customers")
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(union).alias("approx_customers"))
