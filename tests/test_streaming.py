"""Streaming ingest gives the batch answer; streamed counters match batch."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from stratum.operators import corpus, medallion
from stratum.plans import catalog
from stratum.sources.orders import order_source
from stratum.sources.tables import read_table
from stratum.streaming import ingest


def test_newest_versions_stream_equals_batch(spark, scratch):
    # land the orders table as three files, as if they arrived over time
    landing = os.path.join(scratch, "landing")
    orders = read_table(spark, SF_SMALL, "orders")
    for i in range(3):
        part = orders.filter(F.col("o_orderkey") % 3 == i)
        part.coalesce(1).write.parquet(os.path.join(scratch, f"tmp{i}"))
        os.makedirs(landing, exist_ok=True)
        src = [f for f in os.listdir(os.path.join(scratch, f"tmp{i}")) if f.endswith(".parquet")][0]
        os.link(os.path.join(scratch, f"tmp{i}", src), os.path.join(landing, f"orders-{i}.parquet"))
    stream = ingest.file_stream(spark, landing, "orders", max_files_per_trigger=1)
    rows = order_source(spark, SF_SMALL, orders=stream)
    q = ingest.start_newest_versions(rows, os.path.join(scratch, "out"), os.path.join(scratch, "ckpt"))
    q.awaitTermination(300)
    out = os.path.join(scratch, "out")
    batch = medallion.silver(medallion.bronze(order_source(spark, SF_SMALL))).drop("ingested_at")
    assert len([d for d in os.listdir(os.path.join(out, "changes")) if d.startswith("batch_id=")]) == 3

    def same(streamed):
        streamed = streamed.drop("ingested_at")
        assert streamed.count() == batch.count()
        assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0

    same(ingest.streamed_silver(spark, out))
    # after compaction, reads start from the base version and give the same
    assert ingest.compact(spark, out) == 0
    same(ingest.streamed_silver(spark, out))


def test_daily_counts_stream_matches_batch(spark, scratch):
    events = ingest.file_stream(spark, SF_SMALL, "events")
    counts = ingest.daily_event_counts_stream(events, catalog.ALLOWED_EVENT_TYPES)
    q = (
        counts.writeStream.outputMode("append")
        .format("parquet")
        .option("path", os.path.join(scratch, "daily"))
        .option("checkpointLocation", os.path.join(scratch, "ckpt_daily"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(300)
    got = spark.read.parquet(os.path.join(scratch, "daily"))
    want = corpus.daily_counts(read_table(spark, SF_SMALL, "events"), catalog.ALLOWED_EVENT_TYPES)
    # append mode emits a day once the watermark (newest event time minus the
    # one-day lateness) has passed the day's end; those days equal the batch
    import datetime as dt

    newest = read_table(spark, SF_SMALL, "events").agg(F.max("ts")).first()[0]
    watermark = newest - dt.timedelta(days=1)
    closed = want.filter(F.date_add(F.col("day"), 1).cast("timestamp_ntz") <= F.lit(watermark))
    assert closed.count() > 0
    assert got.exceptAll(closed).count() == 0 and closed.exceptAll(got).count() == 0
