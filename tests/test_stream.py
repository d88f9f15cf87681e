"""Streams replayed over several files, with duplicates, equal the batch answer."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from assetweave import schemas
from assetweave.operators.merge import dedupe
from assetweave.session import new_path
from assetweave.sources.keyed_table import read_keyed
from assetweave.streaming import quotes as stream

ASSETS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(8)
    start = dt.datetime(2024, 1, 8, 12, 0)
    rows = []
    for i in range(600):
        asset = "a" if rng.random() < 0.6 else rng.choice(ASSETS)
        rows.append((i, start + dt.timedelta(seconds=i * 60 + rng.randint(0, 30)), 1, asset, rng.uniform(1, 9), None))
    return spark.createDataFrame(rows, schemas.EVENTS).cache()


@pytest.fixture(scope="module")
def folder(spark, events):
    """Four files in event order; each repeats some rows of the one before."""
    path = new_path(spark, "events")
    for part in range(4):
        piece = events.where(F.col("event_id").between(part * 150 - 20, part * 150 + 149))
        piece.coalesce(1).write.mode("append").parquet(path)
    return path


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def feed(spark, folder):
    return stream.as_quotes(stream.stream_table(spark, folder, schemas.EVENTS, files_per_batch=1))


def test_snapshots_equal_batch(spark, events, folder):
    path = new_path(spark, "out")
    live = stream.unique_quotes(stream.during_market(feed(spark, folder)), "1 day")
    stream.write_batches(stream.snapshots(live), path, new_path(spark, "cp")).awaitTermination()
    assert spark.read.parquet(path).select("batch").distinct().count() > 1
    got = stream.read_newest(spark, path, ["window_start", "asset"])
    want = stream.snapshots(stream.during_market(stream.as_quotes(events)))
    assert rows(got.select(*want.columns)) == rows(want)


def test_upsert_stream_equals_batch_and_survives_replay(spark, events, folder):
    path, order = new_path(spark, "out"), [F.col("ts").desc(), F.col("event_id").desc()]
    for _ in range(2):  # a second run with a new checkpoint replays every batch
        quotes = feed(spark, folder).withColumn("hour", F.date_trunc("hour", "ts"))
        query = stream.upsert_stream(quotes, path, new_path(spark, "cp"), ["asset", "hour"], order, F.to_date("hour"))
        query.awaitTermination()
    got = read_keyed(spark, path)
    want = dedupe(stream.as_quotes(events).withColumn("hour", F.date_trunc("hour", "ts")), ["asset", "hour"], order)
    assert rows(got.select(*want.columns)) == rows(want)


def test_latest_prices(spark, events, folder):
    path = new_path(spark, "out")
    stream.write_batches(stream.latest_prices(feed(spark, folder)), path, new_path(spark, "cp")).awaitTermination()
    got = stream.read_newest(spark, path, ["asset"])
    want = stream.latest_prices(stream.as_quotes(events))
    assert rows(got.select(*want.columns)) == rows(want)


def test_append_then_restart_adds_nothing(spark, events, folder):
    path, checkpoint = new_path(spark, "out"), new_path(spark, "cp")
    for _ in range(2):
        unique = stream.unique_quotes(feed(spark, folder), "1 day")
        stream.append_to(unique, path, checkpoint).awaitTermination()
    assert spark.read.parquet(path).count() == events.count()


def test_wide_snapshots_become_long_rows(spark):
    landed, path = new_path(spark, "wide"), new_path(spark, "out")
    wide = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), 1.0, None, 3.0)], "ts timestamp, a double, b double, c double"
    )
    wide.write.parquet(landed)
    source = stream.stream_table(spark, landed, wide.schema)
    stream.append_to(stream.long_quotes(source, ASSETS), path, new_path(spark, "cp")).awaitTermination()
    assert {(r.asset, r.price) for r in spark.read.parquet(path).collect()} == {("a", 1.0), ("b", None), ("c", 3.0)}
    assert stream.long_quotes(wide, ASSETS, keep_missing=False).count() == 2


def test_rows_behind_the_watermark_are_counted(spark):
    landed, path = new_path(spark, "landed"), new_path(spark, "out")
    for day in (10, 20, 1):
        rows_ = [(100 * day + i, dt.datetime(2024, 1, day, 12, i), 1, "a", 1.0, None) for i in range(5)]
        spark.createDataFrame(rows_, schemas.EVENTS).coalesce(1).write.mode("append").parquet(landed)
    unique = stream.unique_quotes(feed(spark, landed), "1 day")
    query = stream.append_to(unique, path, new_path(spark, "cp"))
    query.awaitTermination()
    assert (spark.read.parquet(path).count(), stream.dropped_rows(query)) == (10, 5)


def test_upsert_stream_takes_a_trigger(spark, folder):
    path, order = new_path(spark, "out"), [F.col("ts").desc(), F.col("event_id").desc()]
    quotes = feed(spark, folder).withColumn("dt", F.to_date("ts"))
    trigger = {"processingTime": "1 second"}
    query = stream.upsert_stream(quotes, path, new_path(spark, "cp"), ["asset", "dt"], order, F.col("dt"), trigger)
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert read_keyed(spark, path).groupBy("asset", "dt").count().where("count > 1").count() == 0
