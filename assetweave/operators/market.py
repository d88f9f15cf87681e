"""Bars against the market index and company fundamentals: beta, alpha, yield, P/E."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetweave.functions.cleaning import ratio
from assetweave.functions.indicators import daily_return
from assetweave.operators.series import DAILY, Series
from assetweave.session import bounded

#: fixed value: yearly risk-free rate of alpha, spread over the trading days
ALPHA_RISK_FREE = 0.01 / 252
#: days of a century, the most index rows that are broadcast
CALENDAR = 36_525


def with_market(bars: DataFrame, market: DataFrame) -> DataFrame:
    """Inner join with the index on the date, its close as ``close_market``.

    The index must have one row per day; a second one is an error, not more
    bars. With a century of days at most it is broadcast, else joined by size.
    """
    per_day = market.groupBy("dt").agg(F.max("close").alias("close_market"), F.count(F.lit(1)).alias("_n"))
    twice = F.raise_error(F.concat(F.lit("more than one index row on "), F.col("dt").cast("string")))
    index = per_day.select("dt", F.when(F.col("_n") == 1, F.col("close_market")).otherwise(twice).alias("close_market"))
    return bars.join(bounded(index, CALENDAR, "market-index"), "dt")


def with_fundamentals(bars: DataFrame, eps: DataFrame) -> DataFrame:
    """Attach earnings per share; assets without any keep their rows.

    The table has a row per asset and grows with the data, so its size decides
    at run time between broadcast and shuffle.
    """
    return bars.join(eps.select("ticker", "eps"), "ticker", "left")


def with_market_returns(joined: DataFrame, s: Series = DAILY) -> DataFrame:
    return joined.withColumns(
        {"daily_return": daily_return("close", s), "market_return": daily_return("close_market", s)}
    )


def _moments() -> tuple[Column, Column]:
    return F.covar_samp("daily_return", "market_return"), F.var_samp("market_return")


def beta(returns: DataFrame, key: str = "ticker") -> DataFrame:
    """Covariance with the market over the market's variance, whole sample."""
    covariance, variance = _moments()
    return returns.groupBy(key).agg(ratio(covariance, variance).alias("beta"))


def with_beta(returns: DataFrame, s: Series = DAILY) -> DataFrame:
    """Beta on every row; uses the grouping the returns already have."""
    covariance, variance = _moments()
    return returns.withColumn("beta", ratio(covariance.over(s.whole), variance.over(s.whole)))


def alpha(risk_free: float = ALPHA_RISK_FREE) -> Column:
    expected = risk_free + F.col("beta") * (F.col("market_return") - risk_free)
    return F.col("daily_return") - expected


def dividend_yield() -> Column:
    return ratio("dividends", "close")


def pe_ratio() -> Column:
    return ratio("close", "eps")
