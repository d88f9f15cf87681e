"""Per-asset risk metrics: volatility, Sharpe, Sortino, trailing and risk-adjusted returns.

Each is one aggregation over daily returns. ``asset_metrics`` computes all of
them in a single pass: the window for the previous close already places an
asset's rows together, so the aggregation adds no shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetweave.functions.cleaning import ratio
from assetweave.functions.indicators import daily_return
from assetweave.operators.returns import trailing_aggregates, trailing_columns
from assetweave.operators.series import DAILY, Series, in_blocks

#: fixed values: trading days per period, and the yearly risk-free rate
PERIODS = {"daily": 1, "monthly": 21, "quarterly": 63, "annual": 252}
RISK_FREE = 0.02
TRADING_DAYS = 252


def with_returns(prices: DataFrame, s: Series = DAILY) -> DataFrame:
    """Add ``daily_return``, after dropping rows without date or close."""
    known = prices.where(F.col("close").isNotNull() & F.col(s.order[0]).isNotNull())
    return known.withColumn("daily_return", daily_return("close", s))


def quote_returns(quotes: DataFrame, s: Series, block_rows: int | None = None) -> DataFrame:
    """``daily_return`` between consecutive intraday rows, in blocks: assets may be of any size."""
    known = quotes.where(F.col("close").isNotNull() & F.col(s.order[0]).isNotNull())
    size = {"block_rows": block_rows} if block_rows else {}
    return in_blocks(known, s, 1, lambda df, b: df.withColumn("daily_return", daily_return("close", b)), **size)


def _volatility(sd: Column) -> dict[str, Column]:
    return {f"{name}_volatility": sd * math.sqrt(days) for name, days in PERIODS.items()}


def _sd() -> Column:
    return F.stddev_samp("daily_return")


def _excess(risk_free: float) -> Column:
    return F.avg(F.col("daily_return") - risk_free / TRADING_DAYS)


def _downside() -> Column:
    return F.stddev_samp(F.when(F.col("daily_return") < 0, F.col("daily_return")))


def volatility(returns: DataFrame, key: str = "ticker") -> DataFrame:
    """Daily, monthly, quarterly and annual volatility from ``daily_return``."""
    sd = returns.groupBy(key).agg(_sd().alias("_sd"))
    return sd.select(key, *[c.alias(n) for n, c in _volatility(F.col("_sd")).items()])


def sharpe(returns: DataFrame, risk_free: float = RISK_FREE, key: str = "ticker") -> DataFrame:
    """Mean excess daily return over the sample deviation; not annualised."""
    return returns.groupBy(key).agg(ratio(_excess(risk_free), _sd()).alias("sharpe_ratio"))


def sortino(returns: DataFrame, risk_free: float = RISK_FREE, key: str = "ticker") -> DataFrame:
    """As Sharpe, over the sample deviation of negative returns."""
    return returns.groupBy(key).agg(ratio(_excess(risk_free), _downside()).alias("sortino_ratio"))


def risk_adjusted(metrics: DataFrame) -> DataFrame:
    """Year-to-date and one-year return per unit of annual volatility."""
    return metrics.withColumns(
        {
            "risk_adjusted_ytd": ratio("return_ytd", "annual_volatility"),
            "risk_adjusted_1y": ratio("return_1y", "annual_volatility"),
        }
    )


def asset_metrics(prices: DataFrame, today: str, risk_free: float = RISK_FREE, s: Series = DAILY) -> DataFrame:
    """Every metric of this module, one row per asset."""
    aggregates = {
        "_sd": _sd(),
        "_excess": _excess(risk_free),
        "_downside": _downside(),
        **trailing_aggregates(today),
    }
    totals = with_returns(prices, s).groupBy(*s.by).agg(*[c.alias(n) for n, c in aggregates.items()])
    metrics = totals.select(
        *s.by,
        *[c.alias(n) for n, c in trailing_columns().items()],
        *[c.alias(n) for n, c in _volatility(F.col("_sd")).items()],
        ratio("_excess", "_sd").alias("sharpe_ratio"),
        ratio("_excess", "_downside").alias("sortino_ratio"),
    )
    return risk_adjusted(metrics)
