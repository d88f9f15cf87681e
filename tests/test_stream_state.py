"""The newest prices out of a job's state, and counts over more batches than Spark remembers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from assetweave.streaming import quotes as stream
from assetweave.streaming.metrics import counted

SCHEMA = "event_id long, event_type string, ts timestamp, value double"


def batch(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def at(minute):
    return dt.datetime(2024, 1, 2) + dt.timedelta(minutes=minute)


@pytest.fixture
def one_partition(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_latest_from_state(spark, tmp_path, one_partition):
    landed, checkpoint = str(tmp_path / "landed"), str(tmp_path / "checkpoint")

    def run():
        quotes = stream.as_quotes(stream.stream_table(spark, landed, SCHEMA, files_per_batch=1))
        stream.keep_state(stream.latest_prices(quotes), checkpoint).awaitTermination()

    for n in range(10):
        batch(spark, landed, [(n, "abc"[n % 3], at(n), float(n)), (100 + n, "late", at(50 - n), -float(n))])
    run()
    got = {r.asset: (r.ts, r.price) for r in stream.latest_from_state(spark, checkpoint).collect()}
    assert got == {"a": (at(9), 9.0), "b": (at(7), 7.0), "c": (at(8), 8.0), "late": (at(50), 0.0)}
    batch(spark, landed, [(999, "a", at(60), None)])  # the newest price may be missing
    run()
    state = stream.latest_from_state(spark, checkpoint)
    assert state.count() == 4  # one row per asset, not per batch
    assert state.where("asset = 'a'").first().price is None
    earlier = {r.asset: r.price for r in stream.latest_from_state(spark, checkpoint, batch=2).collect()}
    assert earlier == {"a": 0.0, "b": 1.0, "c": 2.0, "late": 0.0}


def test_counts_go_beyond_the_newest_hundred_batches(spark, tmp_path, one_partition):
    landed, out, checkpoint = (str(tmp_path / n) for n in ("landed", "out", "checkpoint"))
    # every second batch brings a row that is late by then
    rows = spark.range(120).select(
        F.col("id").alias("event_id"),
        F.lit("a").alias("event_type"),
        F.when(F.col("id") % 2 == 1, F.lit(at(0))).otherwise(F.lit(at(0)) + F.make_dt_interval(days=F.col("id").cast("int"))).alias("ts"),
        F.lit(1.0).alias("value"),
    )
    rows.repartitionByRange(120, "event_id").write.parquet(landed)
    listener = counted(spark)
    try:
        quotes = stream.as_quotes(stream.stream_table(spark, landed, SCHEMA, files_per_batch=1))
        query = stream.append_to(stream.unique_quotes(quotes, "1 hour"), out, checkpoint)
        query.awaitTermination()
        listener.wait_for(query)
    finally:
        spark.streams.removeListener(listener)
    totals = listener.totals(query)
    kept = spark.read.parquet(out).count()
    assert totals["batches"] > 100 and totals["rows_in"] == 120
    assert kept + totals["dropped"] == 120 and totals["dropped"] > 50
    assert stream.dropped_rows(query) < totals["dropped"]  # what Spark still remembers
    path = str(tmp_path / "batches")
    listener.write(spark, path)
    assert spark.read.parquet(path).agg(F.sum("dropped")).first()[0] == totals["dropped"]
