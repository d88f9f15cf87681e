"""Asset-level tables: metadata with metrics, and the labelled assets that portfolios draw on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetweave.operators.cluster import nearest, risk_label, standardize
from assetweave.operators.market import pe_ratio, with_fundamentals
from assetweave.operators.merge import merge_fields, pending
from assetweave.operators.metrics import asset_metrics, with_returns
from assetweave.functions.indicators import momentum
from assetweave.operators.series import DAILY, Series


def refresh_metadata(
    assets: DataFrame, meta: DataFrame, prices: DataFrame, today: str, fields: list[str]
) -> DataFrame:
    """Compute metrics for those of ``assets`` that lack any of ``fields`` and merge them into the metadata.

    Prices are read once; the list of assets is a table of its own.
    """
    todo = pending(assets, meta, fields)
    metrics = asset_metrics(prices.join(todo, "ticker", "left_semi"), today)
    return merge_fields(meta, metrics, "ticker")


def latest_profile(bars: DataFrame, eps: DataFrame, s: Series = DAILY) -> DataFrame:
    """Per asset: daily volatility over its history, and momentum and P/E of its last bar."""
    moving = with_returns(bars, s).withColumn("momentum", momentum("close", 14, s))
    last = moving.groupBy(*s.by, "category").agg(
        F.stddev_samp("daily_return").alias("daily_volatility"),
        F.max_by("momentum", "dt").alias("momentum"),
        F.max_by("close", "dt").alias("close"),
    )
    return with_fundamentals(last, eps).withColumn("pe_ratio", pe_ratio()).drop("eps")


def labelled_assets(profile: DataFrame, centers: list[float]) -> DataFrame:
    """Risk label per asset from fixed cluster centers on standardised volatility."""
    scaled = standardize(profile.where(F.col("daily_volatility").isNotNull()), ["daily_volatility"])
    clustered = scaled.withColumn("prediction", nearest(["z_daily_volatility"], [[c] for c in centers]))
    return risk_label(clustered, by="daily_volatility").drop("z_daily_volatility")
