"""A price for every asset and market quarter-hour, also where an asset stays silent.

Quotes are first reduced to one row per asset and interval (map-side sums, so a busy
asset costs no more than its intervals), then a keyed processor walks the clock of
each asset: a timer stands at the end of the next interval that is due, and when the
watermark passes it, that interval's price, or NULL, goes out and the timer moves
on. State is one clock per asset and the prices of intervals that are not yet due; it
is kept in RocksDB and comes back from the checkpoint.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from assetweave.operators.cleaning import market_hours
from assetweave.streaming.quotes import INTERVAL, snapshots

#: fixed value: milliseconds between two polls of the feed
INTERVAL_MS = 15 * 60 * 1000

#: the state store that keyed processors need
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}


class Clock(StatefulProcessor):
    """Rows (asset, start in ms, price, n_quotes) for every interval since an asset's first."""

    def __init__(self, step: int = INTERVAL_MS):
        self.step = step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.due = handle.getValueState("due", "start long")
        self.prices = handle.getMapState("prices", "start long", "price double, n_quotes long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for batch in rows:
            for start, price, n in zip(batch["start_ms"], batch["price"], batch["n_quotes"]):
                self.prices.updateValue((int(start),), (None if pd.isna(price) else float(price), int(n)))
                first = int(start) if first is None else min(first, int(start))
        held = self.due.get() if self.due.exists() else None
        # before an asset's first row went out, an earlier interval may still come in
        if first is not None and (held is None or first < held[0]):
            if held is not None:
                self.handle.deleteTimer(held[0] + self.step)
            self.due.update((first,))
            self.handle.registerTimer(first + self.step)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        start, now, out = self.due.get()[0], timerValues.getCurrentWatermarkInMs(), []
        while start + self.step <= now:
            price, n = None, 0
            if self.prices.containsKey((start,)):
                price, n = self.prices.getValue((start,))
                self.prices.removeKey((start,))
            out.append((key[0], start, price, n))
            start += self.step
        self.due.update((start,))
        self.handle.registerTimer(start + self.step)
        if out:
            frame = pd.DataFrame(out, columns=["asset", "start_ms", "price", "n_quotes"])
            yield frame.astype({"start_ms": "int64", "price": "float64", "n_quotes": "int64"})

    def close(self) -> None:
        pass


def every_interval(quotes: DataFrame, interval: str = INTERVAL, step: int = INTERVAL_MS) -> DataFrame:
    """(window_start, asset, price, n_quotes) of every market interval since an asset's first quote.

    ``quotes`` is a stream with a watermark on ``ts``, which says how late a quote
    may come; an interval's row goes out when the watermark has passed its end.
    ``price`` is NULL and ``n_quotes`` 0 where the asset was silent.
    """
    quotes.sparkSession.conf.set(*next(iter(STATE_STORE.items())))
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    closed = snapshots(quotes, interval).withColumn("start_ms", F.unix_millis("window_start"))
    rows = closed.groupBy("asset").transformWithStateInPandas(
        Clock(step),
        outputStructType="asset string, start_ms long, price double, n_quotes long",
        outputMode="Append",
        timeMode="EventTime",
    )
    known = F.when(F.col("n_quotes") > 0, F.col("price")).alias("price")
    rows = rows.select(F.timestamp_millis("start_ms").alias("window_start"), "asset", known, "n_quotes")
    return rows.where(market_hours("window_start"))
