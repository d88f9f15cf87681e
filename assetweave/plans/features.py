"""Feature tables: the basic, advanced and enhanced sets, each one shuffle by asset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetweave.functions.cleaning import ratio
from assetweave.functions.indicators import difference, intraday_return, log_return, momentum
from assetweave.operators.ema import ema_lookback, with_ema, with_steps
from assetweave.operators.market import (
    alpha,
    dividend_yield,
    pe_ratio,
    with_beta,
    with_fundamentals,
    with_market,
    with_market_returns,
)
from assetweave.operators.rolling import bands, gains_and_losses, rsi, with_rolling
from assetweave.operators.series import DAILY, Series
from assetweave.schemas import require_columns

BASIC = [
    "intraday_return",
    "sma_10",
    "sma_50",
    "sma_200",
    "volatility_10",
    "avg_volume_10",
    "avg_volume_50",
    "rsi_14",
]
ADVANCED = [
    "log_return",
    "sma_20",
    "sma_50",
    "sma_100",
    "ema_20",
    "ema_50",
    "upper_band",
    "lower_band",
    "price_volume_ratio",
    "historical_volatility",
    "price_change",
    "momentum_10",
    "momentum_20",
    "intraday_return",
    "volatility_10",
    "avg_volume_50",
    "rsi_14",
]
ENHANCED = ["momentum", "daily_return", "market_return", "beta", "alpha", "dividend_yield", "pe_ratio"]

#: mean gain and loss, the ingredients of RSI
RSI_MEANS = {"_up": ("_gain", 14), "_down": ("_loss", 14)}

#: rows of history each set needs, for the blocked layout
BASIC_LOOKBACK = 200
ADVANCED_LOOKBACK = max(100, ema_lookback(50))


def basic_features(
    bars: DataFrame, s: Series = DAILY, min_periods: int | None = None, complete: bool = True
) -> DataFrame:
    """Intraday return, moving averages, volatility, volume averages, RSI."""
    df = bars.withColumns({"intraday_return": intraday_return(), "change": difference("close", 1, s)})
    means = {
        "sma_10": ("close", 10),
        "sma_50": ("close", 50),
        "sma_200": ("close", 200),
        "avg_volume_10": ("volume", 10),
        "avg_volume_50": ("volume", 50),
        **RSI_MEANS,
    }
    deviations = {"volatility_10": ("intraday_return", 10)}
    df = with_rolling(df.withColumns(gains_and_losses()), means, deviations, s, min_periods)
    df = df.withColumn("rsi_14", rsi()).select(*bars.columns, *BASIC)
    return df.na.drop(subset=BASIC) if complete else df


def advanced_features(bars: DataFrame, s: Series = DAILY, complete: bool = True) -> DataFrame:
    """The wider set with log returns, exponential averages, bands and momentum."""
    df = with_steps(bars, s).withColumns(
        {
            "intraday_return": intraday_return(),
            "log_return": log_return("close", s),
            "change": difference("close", 1, s),
            "price_volume_ratio": ratio("close", "volume"),
            "price_change": F.col("close") - F.col("open"),
            "momentum_10": difference("close", 10, s),
            "momentum_20": difference("close", 20, s),
        }
    )
    means = {
        "sma_20": ("close", 20),
        "sma_50": ("close", 50),
        "sma_100": ("close", 100),
        "avg_volume_50": ("volume", 50),
        **RSI_MEANS,
    }
    deviations = {
        "_deviation": ("close", 20),
        "historical_volatility": ("log_return", 20),
        "volatility_10": ("intraday_return", 10),
    }
    df = with_rolling(df.withColumns(gains_and_losses()), means, deviations, s)
    df = df.withColumns({"rsi_14": rsi(), **bands("sma_20", "_deviation")})
    # the exponential averages sort once more; leave behind what is no longer needed
    df = df.drop("_gain", "_loss", "_up", "_down", "_deviation", "change")
    df = with_ema(df, {"ema_20": 20, "ema_50": 50}, "close", s).select(*bars.columns, *ADVANCED)
    return df.na.drop(subset=ADVANCED) if complete else df


def enhanced_bars(
    bars: DataFrame, market: DataFrame, eps: DataFrame, s: Series = DAILY, complete: bool = True
) -> DataFrame:
    """Bars with momentum, beta, alpha, dividend yield and price/earnings."""
    df = with_market_returns(with_market(with_fundamentals(bars, eps), market), s)
    df = with_beta(df.withColumn("momentum", momentum("close", 14, s)), s)
    df = df.withColumns({"alpha": alpha(), "dividend_yield": dividend_yield(), "pe_ratio": pe_ratio()})
    return df.na.drop(subset=ENHANCED) if complete else df


#: how each feature is made: from a row and its neighbours, as a mean, or as a deviation
DIRECT = {
    "intraday_return": lambda s: intraday_return(),
    "log_return": lambda s: log_return("close", s),
    "price_volume_ratio": lambda s: ratio("close", "volume"),
    "price_change": lambda s: F.col("close") - F.col("open"),
    "momentum_10": lambda s: difference("close", 10, s),
    "momentum_20": lambda s: difference("close", 20, s),
}
MEANS = {
    **{f"sma_{n}": ("close", n) for n in (10, 20, 50, 100, 200)},
    **{f"avg_volume_{n}": ("volume", n) for n in (10, 50)},
}
DEVIATIONS = {"volatility_10": ("intraday_return", 10), "historical_volatility": ("log_return", 20)}
EMAS = {"ema_20": 20, "ema_50": 50}
BANDS = ("upper_band", "lower_band")


def ensure_features(df: DataFrame, columns: list[str], s: Series = DAILY) -> DataFrame:
    """Add those of ``columns`` that are absent, per asset: any of the basic and advanced sets.

    A feature that neither the table has nor this derives is an error, as is one
    that lacks its inputs.
    """
    absent = [c for c in columns if c not in df.columns]
    unknown = [c for c in absent if c not in (*DIRECT, *MEANS, *DEVIATIONS, *EMAS, *BANDS, "rsi_14")]
    if unknown:
        raise ValueError(f"can't derive: {', '.join(unknown)}")
    given = df.columns
    means = {c: MEANS[c] for c in absent if c in MEANS}
    deviations = {c: DEVIATIONS[c] for c in absent if c in DEVIATIONS}
    helpers = [source for source, _ in deviations.values()]
    direct = {c: DIRECT[c](s) for c in dict.fromkeys([*absent, *helpers]) if c in DIRECT and c not in given}
    inputs = {source for source, _ in [*means.values()]} - {*direct}
    if {"price_volume_ratio"} & {*absent}:
        inputs.add("volume")
    require_columns(df, ["close", *sorted(inputs)])
    df = df.withColumns(direct)
    if "rsi_14" in absent:
        df = df.withColumn("_change", difference("close", 1, s)).withColumns(gains_and_losses("_change"))
        means |= RSI_MEANS
    if {*BANDS} & {*absent}:
        means["_middle"], deviations["_deviation"] = ("close", 20), ("close", 20)
    df = with_rolling(df, means, deviations, s)
    if "rsi_14" in absent:
        df = df.withColumn("rsi_14", rsi())
    if {*BANDS} & {*absent}:
        df = df.withColumns({n: c for n, c in bands("_middle", "_deviation").items() if n in absent})
    df = df.drop("_gain", "_loss", "_up", "_down", "_change", "_middle", "_deviation")
    if {*EMAS} & {*absent}:
        df = with_ema(df, {c: EMAS[c] for c in absent if c in EMAS}, "close", s)
    return df.select(*given, *absent)
