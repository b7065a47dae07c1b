"""Contracts as executable checks: validation cases (D-5), layer
reconciliation (D-7) and row gates on other tables.

Each check is one aggregate (or union of aggregates) whose answer is a small
long-form DataFrame; nothing is collected to decide it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.rules import LATEST_RULE, Rule, first_match
from stratum.operators.dedup import latest_per_key

def _count_if(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


# The four validation cases of the order contract, with the
# behaviour each one states; every case expects status 'pass'.
VALIDATION_CASES = (
    ("VAL-01", "null customer handling", "Rows with missing customer_id should stay in rejected quarantine rows."),
    ("VAL-02", "null region handling", "Rows with missing region should not reach gold KPI outputs."),
    ("VAL-03", "non-positive revenue", "Rows with amount <= 0 should be isolated with a quarantine reason."),
    ("VAL-04", "duplicate order resolution", "Only the latest duplicate order version should survive into silver."),
)


#: What each named check counts as violations in silver; the newest-version check needs bronze as well.
LATEST_CHECK = "latest_version"
CHECKS = {
    "customer_present": "customer_id IS NULL",
    "region_present": "region IS NULL",
    "positive_amount": "amount <= 0",
    LATEST_CHECK: None,
}
#: The check of a case that names none, by the end of its id.
CHECK_OF_CASE = dict(zip([c[0] for c in VALIDATION_CASES], CHECKS, strict=True))


@dataclass(frozen=True)
class Case:
    """A validation case: the behaviour it states, and how its violations are found.

    ``violation`` is an SQL predicate that holds for silver rows which break
    the case; ``check`` names one of ``CHECKS``.  A case that gives neither
    takes the check that belongs to its id.
    """

    case_id: str
    focus: str
    assertion: str
    expected_status: str = "pass"
    check: str | None = None
    violation: str | None = None

    def bound(self) -> tuple[str | None, str | None]:
        """``(check, violation)`` with the predicate filled in; unknown cases are refused."""
        if self.violation:
            return None, self.violation
        check = self.check or next((c for end, c in CHECK_OF_CASE.items() if self.case_id.endswith(end)), None)
        if check not in CHECKS:
            raise ValueError(f"case {self.case_id!r} gives no predicate and no known check")
        return check, CHECKS[check]


CASES = tuple(Case(*c) for c in VALIDATION_CASES)


def load_cases(spark: SparkSession, path: str) -> tuple[Case, ...]:
    """Read a JSON array of case records (S-3), configuration of a handful of
    entries: ``id`` (or ``case_id``), ``focus``, ``assertion``, and optionally
    ``expected_status`` (default ``pass``), ``check`` and ``violation``."""
    found = []
    for row in spark.read.option("multiLine", True).json(path).collect():
        r = row.asDict()
        found.append(
            Case(
                r.get("case_id") or r["id"], r["focus"], r["assertion"], r.get("expected_status") or "pass",
                r.get("check"), r.get("violation"),
            )
        )
    return tuple(found)


def _stale_rows(silver: DataFrame, bronze: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row, ``stale``: silver rows that are not their key's newest version in bronze."""
    version = F.struct(*[F.col(c) for c in (*keys, *order)])
    newest = latest_per_key(bronze.select(*keys, *order), keys, order).select(F.xxhash64(version).alias("_nh"), version.alias("_n"))
    kept = silver.select(F.xxhash64(version).alias("_sh"), version.alias("_s"))
    # Joined on a hash beside the values, so both sides are plain exchanges.
    stale = kept.join(newest, (F.col("_sh") == F.col("_nh")) & F.col("_s").eqNullSafe(F.col("_n")), "left_anti")
    return stale.agg(F.count(F.lit(1)).alias("stale"))


def validation_cases(
    silver: DataFrame, bronze: DataFrame, keys: Sequence[str] = ("order_id",), order: Sequence[str] = ("order_ts", "source_rank"),
    cases: Sequence[Case] = CASES,
) -> DataFrame:
    """``(case_id, focus, assertion, violations, expected_status, status)`` of
    a published silver against the bronze rows it was made from.

    Cases are bound by their id, check or predicate, in any order and number.
    Predicates are counted over silver in one aggregate.  The newest-version
    check counts silver rows that are not their key's newest version in
    bronze, plus extra silver rows of a key that has more than one; the newest
    versions are found anew from bronze, and only if a case asks for them.
    """
    bound = [c.bound() for c in cases]
    counts = [_count_if(F.expr(v)).alias(f"v{i}") for i, (_, v) in enumerate(bound) if v]
    latest = any(check == LATEST_CHECK for check, _ in bound)
    if latest:
        counts.append((F.count(F.lit(1)) - F.count_distinct(F.struct(*keys))).alias("extra"))
    both = silver.agg(*counts or [F.count(F.lit(1)).alias("rows")])
    if latest:
        both = both.unionByName(_stale_rows(silver, bronze, keys, order), allowMissingColumns=True)
        both = both.agg(*[F.max(c).alias(c) for c in both.columns])
    entries = []
    for i, (c, (_, violation)) in enumerate(zip(cases, bound, strict=True)):
        found = F.col(f"v{i}") if violation else F.col("extra") + F.col("stale")
        entries.append(
            F.struct(
                F.lit(c.case_id).alias("case_id"),
                F.lit(c.focus).alias("focus"),
                F.lit(c.assertion).alias("assertion"),
                found.cast("bigint").alias("violations"),
                F.lit(c.expected_status).alias("expected_status"),
                F.when(found == 0, F.lit("pass")).otherwise(F.lit("fail")).alias("status"),
            )
        )
    return both.select(F.inline(F.array(*entries)))


def _with_known_keys(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``df``'s rows that ``known`` holds too; NULL keys match each other."""
    key = F.struct(*keys)
    held = known.select(F.xxhash64(key).alias("_kh"), key.alias("_k")).distinct()
    mine = df.select(F.xxhash64(key).alias("_h"), key.alias("_m"))
    return mine.join(held, (F.col("_h") == F.col("_kh")) & F.col("_m").eqNullSafe(F.col("_k")), "left_semi")


#: Hash buckets whose fingerprints are compared first.
FINGERPRINT_BUCKETS = 4096


def _fingerprints(df: DataFrame, columns: Sequence[str], sign: int, buckets: int) -> DataFrame:
    """``bucket, n, h, g``: signed counts and sums of two hashes of the rows, a bucket.

    Sums don't depend on the order or the partitioning of rows, and repeated
    rows count as often as they stand.  NULLs are hashed as such.
    """
    cells = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    hashed = df.select(F.xxhash64(*cells).alias("h"), F.hash(*reversed(cells)).alias("g"))
    wide = [(F.lit(sign) * F.col(c).cast("decimal(20,0)")).alias(c) for c in ("h", "g")]
    return hashed.select(F.pmod("h", F.lit(buckets)).alias("bucket"), F.lit(sign).alias("n"), *wide)


def content_differences(left: DataFrame, right: DataFrame, columns: Sequence[str], buckets: int = FINGERPRINT_BUCKETS) -> DataFrame:
    """``columns``, ``side``, ``copies``: the rows that one side holds more often than the other (D-7).

    ``side`` is ``lost`` for rows that ``left`` has and ``right`` lacks,
    ``foreign`` for the reverse, and ``copies`` says how many more.  Both sides
    are first compared by order-independent fingerprints, one row a hash
    bucket; only rows of buckets that differ, none if the sides agree, are
    shuffled and compared in full.
    """
    columns = list(columns)
    sums = _fingerprints(left, columns, 1, buckets).unionAll(_fingerprints(right, columns, -1, buckets))
    sums = sums.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("h").alias("h"), F.sum("g").alias("g"))
    differing = sums.filter("n != 0 OR h != 0 OR g != 0").select("bucket")
    cells = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    bucket = F.pmod(F.xxhash64(*cells), F.lit(buckets)).alias("bucket")
    both = left.select(*columns, bucket, F.lit(1).alias("_sign")).unionAll(right.select(*columns, bucket, F.lit(-1).alias("_sign")))
    # As many rows as buckets at most, so a broadcast is safe at every size.
    rows = both.join(F.broadcast(differing), "bucket", "left_semi")
    found = rows.groupBy(*columns).agg(F.sum("_sign").alias("_more")).filter("_more != 0")
    side = F.when(F.col("_more") > 0, F.lit("lost")).otherwise(F.lit("foreign"))
    return found.select(*columns, side.alias("side"), F.abs("_more").alias("copies"))


def reconciliation(
    bronze: DataFrame, silver: DataFrame, rejected: DataFrame, gold: DataFrame, keys: Sequence[str] = ("order_id",)
) -> DataFrame:
    """``(check_name, expected, actual, ok)`` for the layer invariants.

    The four layers are counted each from its own plan or published table, so
    rows lost or doubled between them show, and silver's keys are looked up in
    bronze.  Every layer gives one row of counts; the rows meet in a union.
    What differs row by row is named by ``content_differences``.
    """
    one = F.count(F.lit(1))
    parts = [
        bronze.agg(one.alias("bronze")),
        silver.agg(one.alias("silver"), F.count_distinct(F.struct(*keys)).alias("silver_keys")),
        rejected.agg(one.alias("rejected"), _count_if(F.col("rejection_reason") == LATEST_RULE.label).alias("stale")),
        gold.agg(F.coalesce(F.sum("accepted_orders"), F.lit(0)).cast("bigint").alias("gold_accepted")),
        _with_known_keys(silver, bronze, keys).agg(one.alias("known")),
    ]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    t = both.agg(*[F.max(c).alias(c) for c in both.columns])

    def check(name: str, expected: Column, actual: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check_name"),
            expected.cast("bigint").alias("expected"),
            actual.cast("bigint").alias("actual"),
            (expected == actual).alias("ok"),
        )

    c = F.col
    return t.select(
        F.inline(
            F.array(
                check("bronze_equals_silver_plus_rejected", c("bronze"), c("silver") + c("rejected")),
                check("gold_accepted_equals_silver", c("silver"), c("gold_accepted")),
                check("one_silver_row_per_key", c("silver"), c("silver_keys")),
                check("silver_keys_are_in_bronze", c("silver"), c("known")),
            )
        )
    )


def label_rows(df: DataFrame, rules: Sequence[Rule], column: str = "rejection_reason") -> DataFrame:
    """Attach the first failing rule's label (NULL = accepted) to each row."""
    return df.withColumn(column, first_match(list(rules)))
