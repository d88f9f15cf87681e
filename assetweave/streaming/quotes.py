"""The quote feed as Structured Streaming jobs.

State is bounded: de-duplication by the watermark, snapshots by window and
asset, latest prices by asset. Sinks write one folder per micro-batch, so a
replayed batch replaces its own output and nothing else.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from assetweave.operators.cleaning import market_hours
from assetweave.operators.merge import dedupe
from assetweave.sources.keyed_table import upsert_table

#: fixed value: time between two polls of the feed
INTERVAL = "15 minutes"


def stream_table(
    spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet", files_per_batch: int = 100
) -> DataFrame:
    """Parquet files arriving in a folder."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    return reader.option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def as_quotes(events: DataFrame) -> DataFrame:
    """(event_id, ts, asset, price); event time is a timestamp, as watermarks need it."""
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("asset"),
        F.col("value").alias("price"),
    )


def during_market(quotes: DataFrame) -> DataFrame:
    return quotes.where(market_hours("ts"))


def unique_quotes(quotes: DataFrame, lateness: str) -> DataFrame:
    """Drop repeated deliveries.

    ``lateness`` is how much later than the newest quote another one may come; it
    bounds the state. Quotes later than that are left out, and ``dropped_rows``
    tells how many. A replay of old files needs the span of those files.
    """
    return quotes.withWatermark("ts", lateness).dropDuplicates(["event_id", "ts"])


def quotes_once(quotes: DataFrame, lateness: str) -> DataFrame:
    """Drop repeated deliveries that come within ``lateness`` of each other, which is all that is kept of a quote."""
    return quotes.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["event_id"])


def snapshots(quotes: DataFrame, interval: str = INTERVAL) -> DataFrame:
    """Per interval and asset: the last price and the number of quotes."""
    newest = F.struct("ts", "event_id")
    return (
        quotes.groupBy(F.window("ts", interval).alias("w"), "asset")
        .agg(F.max_by("price", newest).alias("price"), F.count(F.lit(1)).alias("n_quotes"))
        .select(F.col("w.start").alias("window_start"), "asset", "price", "n_quotes")
    )


def long_quotes(wide: DataFrame, assets: list[str], keep_missing: bool = True) -> DataFrame:
    """A wide snapshot (time, one column per asset) as (ts, asset, price) rows."""
    rows = wide.unpivot(["ts"], assets, "asset", "price")
    return rows if keep_missing else rows.where(F.col("price").isNotNull())


def latest_prices(quotes: DataFrame) -> DataFrame:
    """Newest price per asset; one state row per asset."""
    newest = F.struct("ts", "event_id")
    return quotes.groupBy("asset").agg(F.max("ts").alias("ts"), F.max_by("price", newest).alias("price"))


def keep_state(df: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Run a stateful job for its state alone, which ``latest_from_state`` reads; nothing else is written."""
    writer = df.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def latest_from_state(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """``latest_prices`` out of the state of its job, as of the last finished batch (or an earlier one).

    One row per asset is read, whatever number of batches there were.
    """
    reader = spark.read.format("statestore")
    state = (reader if batch is None else reader.option("batchId", batch)).load(checkpoint)
    # the state's columns are the aggregates in their order: newest time, then newest price
    ts, price = state.schema["value"].dataType.names[:2]
    return state.select(F.col("key.asset").alias("asset"), F.col(f"value.{ts}").alias("ts"), F.col(f"value.{price}").alias("price"))


def append_to(
    df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append rows to a parquet folder."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start(path)


def write_batches(
    df: DataFrame, path: str, checkpoint: str, mode: str = "update", trigger: dict | None = None
) -> StreamingQuery:
    """Write every micro-batch to its own folder ``batch=<id>``; a replay overwrites that folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_newest(spark: SparkSession, path: str, keys: list[str], order: list | None = None) -> DataFrame:
    """Upserted view of the batches: per key the row of the latest batch, or the first in ``order``."""
    rows = spark.read.parquet(path)
    return dedupe(rows, keys, order or [F.col("batch").desc()]).drop("batch")


def upsert_stream(
    df: DataFrame,
    table: str,
    checkpoint: str,
    keys: list[str],
    order: list,
    partition: Column,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keyed upsert of arriving rows: every batch goes into the keyed table, which rewrites what it touches.

    A replayed batch changes nothing, as the same row wins again. ``trigger``
    is that of ``writeStream`` (say ``{"processingTime": "15 minutes"}``).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_table(batch, table, keys, order, partition)

    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that came later than the watermark, over the query's progress reports."""
    reports = [p if isinstance(p, dict) else json.loads(p.json) for p in query.recentProgress]
    return sum(state.get("numRowsDroppedByWatermark", 0) for p in reports for state in p.get("stateOperators", []))
