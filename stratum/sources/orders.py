"""Order sources: the CSV order scan (S-1) and the dirty-orders view.

The driver's TPC-H-like ``orders`` table is clean, so the quality rules would
never fire on it.  ``order_source`` derives, deterministically and for every
order row, a source with revisions, missing customers and regions and
negative amounts from ``orders ⋈ customer ⋈ nation ⋈ region``.  No row is
dropped: the derivation only rewrites values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.sources.records import HEADER, csv_records
from stratum.sources.tables import read_table

MONEY = T.DecimalType(18, 2)
# Amounts of text files keep their digits (twelve decimals); only gold rounds.
RAW_MONEY = T.DecimalType(38, 12)

# Column order of every order source.
SOURCE_COLUMNS = (
    "order_id",
    "customer_id",
    "region",
    "channel",
    "status",
    "amount",
    "currency",
    "order_ts",
    "source_rank",
)

# The derivation of the dirty-orders view.  Every tenth order
# key becomes a revision of the key before it; customer, region and amount
# are spoiled on keys divisible by these numbers.
REVISION_EVERY = 10
NULL_CUSTOMER_EVERY = 17
NULL_REGION_EVERY = 23
NEGATIVE_AMOUNT_EVERY = 29
STATUS_NAMES = {"F": "completed", "P": "processing", "O": "cancelled"}
FIELD_PRIORITIES = ("1-URGENT", "2-HIGH")
PARTNER_PRIORITIES = ("3-MEDIUM",)


def with_regions(spark: SparkSession, sf_dir: str, customers: DataFrame) -> DataFrame:
    """``customers``, rows with a ``c_nationkey``, with their region's ``r_name``.

    No hint: the planner broadcasts what is small enough by its size.  Nation
    and region are looked up one after the other, as their join has the product
    of their sizes by its estimate, which once shuffled all rows by 25 keys."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nations = customers.join(nation, customers.c_nationkey == nation.n_nationkey, "left")
    return nations.join(region, nation.n_regionkey == region.r_regionkey, "left")


def order_source(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Dirty order rows derived from the TPC-H-like tables (one per order).

    ``orders`` may be given instead of the ``orders`` table, e.g. a
    streaming read of new order files; the dimensions stay static tables.
    """
    if orders is None:
        orders = read_table(spark, sf_dir, "orders")
    orders = orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    # Joins are ordered so each one's build side is as narrow as possible:
    # customer shrinks to (custkey, nationkey), nation and region to 25 and 5 rows.
    # Customer gets no hint: the planner broadcasts it only while its size
    # estimate is under spark.sql.autoBroadcastJoinThreshold, otherwise it
    # plans a shuffled join (and AQE re-plans from run-time sizes).
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = with_regions(spark, sf_dir, orders.join(customer, orders.o_custkey == customer.c_custkey, "left"))
    key = F.col("o_orderkey")
    amount = F.col("o_totalprice").cast(MONEY)
    status = F.col("o_orderstatus")
    status_name = F.when(status == "F", F.lit(STATUS_NAMES["F"])).when(
        status == "P", F.lit(STATUS_NAMES["P"])
    ).when(status == "O", F.lit(STATUS_NAMES["O"]))
    priority = F.col("o_orderpriority")
    channel = (
        F.when(priority.isin(*FIELD_PRIORITIES), F.lit("field"))
        .when(priority.isin(*PARTNER_PRIORITIES), F.lit("partner"))
        .otherwise(F.lit("web"))
    )
    return joined.select(
        _order_id(key).alias("order_id"),
        F.when(key % NULL_CUSTOMER_EVERY == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("C-"), F.col("o_custkey").cast("string")))
        .alias("customer_id"),
        F.when(key % NULL_REGION_EVERY == 0, F.lit(None).cast("string"))
        .otherwise(F.col("r_name"))
        .alias("region"),
        channel.alias("channel"),
        status_name.alias("status"),
        F.when(key % NEGATIVE_AMOUNT_EVERY == 0, -amount).otherwise(amount).cast(MONEY).alias("amount"),
        F.lit("USD").alias("currency"),
        *_version_columns(key),
    )


def _order_id(key):
    revised = F.when((key % REVISION_EVERY == 0) & (key > 0), key - 1).otherwise(key)
    return F.concat(F.lit("O-"), revised.cast("string"))


def _version_columns(key):
    return [
        F.col("o_orderdate").cast("timestamp_ntz").alias("order_ts"),
        key.cast("bigint").alias("source_rank"),
    ]


def order_versions(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """``(order_id, order_ts, source_rank)`` of every source row, read from
    ``orders`` alone.  The dimension lookups of ``order_source`` neither add
    nor drop rows (customer and nation keys are unique), so these are exactly
    the version columns of the source; computing versions from them spares
    the newest-version side the joins."""
    if orders is None:
        orders = read_table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    return orders.select(_order_id(key).alias("order_id"), *_version_columns(key))


# Schema of the CSV order envelope: every field is read as text first so that
# blank handling and casts follow the contract rather than the CSV reader.
CSV_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("amount", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("order_ts", T.StringType()),
    ]
)

# Only these columns turn blank into NULL (P-1); other blanks stay ''.
BLANK_TO_NULL = ("customer_id", "region")

MALFORMED_LABEL = "malformed_record"
ARRIVAL = "_arrival"


def _csv_rows(spark: SparkSession, path: str, rank_column: str | None, corrupt: str | None) -> DataFrame:
    """The records' fields, by place, with the arrival rank of the record scan unless ``rank_column`` holds one."""
    fields = list(CSV_SCHEMA.fields)
    if rank_column:
        fields.append(T.StructField(rank_column, T.LongType()))
    options = {"escape": '"', "mode": "PERMISSIVE" if corrupt else "FAILFAST"}
    if corrupt:
        fields.append(T.StructField(corrupt, T.StringType()))
        options["columnNameOfCorruptRecord"] = corrupt
    records = csv_records(spark, path).filter(F.col("record_no") > HEADER)
    schema = T.StructType(fields).simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    return records.select(F.from_csv("record", schema, options).alias("r"), F.col("source_rank").alias(ARRIVAL)).select("r.*", ARRIVAL)


def _order_columns(amount: Column, rank_column: str | None) -> list[Column]:
    """The order-source shape from text columns.  The reader turns every blank
    into NULL, so blanks are put back where the contract keeps them."""
    rank = F.col(rank_column or ARRIVAL)
    special = {
        "amount": amount,
        "order_ts": F.try_to_timestamp(F.col("order_ts")).cast("timestamp_ntz"),
        "source_rank": rank.cast("bigint"),
    }
    special |= {c: F.nullif(F.col(c), F.lit("")) for c in BLANK_TO_NULL}
    return [special.get(c, F.coalesce(F.col(c), F.lit(""))).alias(c) for c in SOURCE_COLUMNS]


def read_order_csv(
    spark: SparkSession,
    path: str,
    strict_amount: bool = True,
    rank_column: str | None = None,
) -> DataFrame:
    """Scan CSV order files (header, UTF-8) into the order-source shape.

    ``strict_amount`` keeps the contract that an amount that is blank or no
    number stops the run; with ``False`` it becomes NULL and passes the amount
rule, as a NULL amount does.  ``source_rank`` is the arrival order: a
    sequence column of the file when ``rank_column`` names one, else the place
    of the record among those of all files, in the order of their names
    (``records.csv_records``).  Both stay the same under any re-split.
    Records may span lines inside quotes; files are read in splits all the same.
    """
    raw = _csv_rows(spark, path, rank_column, None)
    number = F.col("amount").try_cast(RAW_MONEY)
    if strict_amount:
        stop = F.raise_error(F.concat(F.lit("amount is not a number: "), F.coalesce("amount", F.lit("(blank)"))))
        number = F.when(number.isNull(), stop.cast(RAW_MONEY)).otherwise(number)
    return raw.select(*_order_columns(number, rank_column))


def read_order_csv_quarantined(
    spark: SparkSession,
    path: str,
    rank_column: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """CSV order scan that never stops on a bad record: ``(rows, malformed)``.

    Records the CSV parser cannot read, and records whose amount is blank or
    no number, go to ``malformed`` as ``(raw_record, rejection_reason)`` with
    the reason ``malformed_record``; every other record is an order-source row.
    The file is parsed once per output, deterministically, so the two halves
    always partition the records.
    """
    raw = _csv_rows(spark, path, rank_column, "_corrupt_record")
    amount = F.col("amount").try_cast(RAW_MONEY)
    flagged = raw.withColumn("_bad", F.col("_corrupt_record").isNotNull() | amount.isNull())
    raw_text = F.coalesce(
        F.col("_corrupt_record"),
        F.concat_ws(",", *[F.coalesce(F.col(f.name), F.lit("")) for f in CSV_SCHEMA.fields]),
    )
    malformed = flagged.filter(F.col("_bad")).select(
        raw_text.alias("raw_record"), F.lit(MALFORMED_LABEL).alias("rejection_reason")
    )
    return flagged.filter(~F.col("_bad")).select(*_order_columns(amount, rank_column)), malformed
