"""Rolling means, deviations, bands and RSI over a ``Series``.

A value appears once its window holds ``n`` non-null values, or, with
``min_periods=1``, from the first row on.

Spark evaluates a sliding frame row by row: a 200-row mean costs 200 steps per
row. Full windows are put together from narrow ones instead. The sum of 200 rows
is five sums of 40, each of them five sums of 8; squared deviations of adjacent
windows combine exactly as well (Chan's formula). Only non-negative terms are
added and nothing is subtracted from a running total, so no precision is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetweave.functions.cleaning import ratio
from assetweave.operators.series import DAILY, Series

#: the narrowest windows, which are aggregated directly, have at least this many rows
NARROW = 5

Wanted = dict[str, tuple[str, int]]


def _part(n: int) -> int | None:
    """Width of the windows that a window of n rows is put together from."""
    return next((n // p for p in (5, 2, 3) if n % p == 0 and n // p >= NARROW), None)


def _sum(column: str, n: int) -> str:
    return f"_sum_{column}_{n}"


def _squares(column: str, n: int) -> str:
    return f"_squares_{column}_{n}"


def with_rolling(
    df: DataFrame,
    means: Wanted | None = None,
    deviations: Wanted | None = None,
    s: Series = DAILY,
    min_periods: int | None = None,
) -> DataFrame:
    """Add moving averages and sample standard deviations: output name -> (column, rows)."""
    means, deviations = means or {}, deviations or {}
    if min_periods is not None:
        return _partial(df, means, deviations, s, min_periods)
    kept = df.columns

    # which windows are needed at which level, and whether with squared deviations
    levels: dict[int, dict[tuple[str, int], bool]] = {}

    def plan(column: str, n: int, squares: bool) -> int:
        part = _part(n)
        level = 0 if part is None else plan(column, part, squares) + 1
        wanted = levels.setdefault(level, {})
        wanted[column, n] = wanted.get((column, n), False) or squares
        return level

    for column, n in means.values():
        plan(column, n, False)
    for column, n in deviations.values():
        plan(column, n, True)

    for level in sorted(levels):
        df = _narrow(df, levels[level], s) if level == 0 else _combined(df, levels[level], s)
    mean = {out: F.col(_sum(column, n)) / n for out, (column, n) in means.items()}
    deviation = {
        out: F.sqrt(F.col(_squares(column, n)) / (n - 1)) if n > 1 else F.lit(None).cast("double")
        for out, (column, n) in deviations.items()
    }
    return df.select(*kept, *[c.alias(out) for out, c in {**mean, **deviation}.items()])


def _narrow(df: DataFrame, windows: dict[tuple[str, int], bool], s: Series) -> DataFrame:
    """Sums, and squared deviations, straight over frames."""
    raw: dict[str, Column] = {}
    for (column, n), squares in windows.items():
        raw[f"_n_{column}_{n}"] = F.count(column).over(s.last(n))
        raw[f"_raw{_sum(column, n)}"] = F.sum(column).over(s.last(n))
        if squares:
            raw[f"_raw{_squares(column, n)}"] = F.var_pop(column).over(s.last(n))
    full: dict[str, Column] = {}
    for (column, n), squares in windows.items():
        complete = F.col(f"_n_{column}_{n}") >= n
        full[_sum(column, n)] = F.when(complete, F.col(f"_raw{_sum(column, n)}"))
        if squares:
            full[_squares(column, n)] = F.when(complete, F.col(f"_raw{_squares(column, n)}") * n)
    return df.withColumns(raw).withColumns(full)


def _combined(df: DataFrame, windows: dict[tuple[str, int], bool], s: Series) -> DataFrame:
    """Windows out of adjacent windows of the level below."""
    lags: dict[str, Column] = {}
    full: dict[str, Column] = {}

    def pieces(name: str, n: int, part: int) -> list[Column]:
        found = [F.col(name)]
        for back in range(part, n, part):
            lags[f"{name}_{back}"] = F.lag(name, back).over(s.window)
            found.append(F.col(f"{name}_{back}"))
        return found

    def total(columns: list[Column]) -> Column:
        result = columns[0]
        for c in columns[1:]:
            result = result + c
        return result

    for (column, n), squares in windows.items():
        part = _part(n)
        sums = pieces(_sum(column, part), n, part)
        full[_sum(column, n)] = total(sums)
        if squares:
            mean = total(sums) / n
            between = [(x / part - mean) * (x / part - mean) * part for x in sums]
            full[_squares(column, n)] = total([*pieces(_squares(column, part), n, part), *between])
    return df.withColumns(lags).withColumns(full)


def _partial(df: DataFrame, means: Wanted, deviations: Wanted, s: Series, min_periods: int) -> DataFrame:
    """Aggregates over whatever the last n rows hold, from ``min_periods`` values on."""
    kept = df.columns
    raw: dict[str, Column] = {}
    for wanted, agg in ((means, F.avg), (deviations, F.stddev_samp)):
        for out, (column, n) in wanted.items():
            raw[f"_n_{column}_{n}"] = F.count(column).over(s.last(n))
            raw[f"_raw_{out}"] = agg(column).over(s.last(n))
    outs = [
        F.when(F.col(f"_n_{column}_{n}") >= min_periods, F.col(f"_raw_{out}")).alias(out)
        for out, (column, n) in {**means, **deviations}.items()
    ]
    return df.withColumns(raw).select(*kept, *outs)


def with_means(df: DataFrame, means: Wanted, s: Series = DAILY, min_periods: int | None = None) -> DataFrame:
    return with_rolling(df, means, None, s, min_periods)


def with_deviations(df: DataFrame, deviations: Wanted, s: Series = DAILY, min_periods: int | None = None) -> DataFrame:
    return with_rolling(df, None, deviations, s, min_periods)


def bands(mid: str, deviation: str, width: float = 2.0) -> dict[str, Column]:
    """Upper and lower band: mean plus and minus ``width`` deviations."""
    spread = width * F.col(deviation)
    return {"upper_band": F.col(mid) + spread, "lower_band": F.col(mid) - spread}


def with_bands(
    df: DataFrame, s: Series = DAILY, column: str = "close", n: int = 20, width: float = 2.0
) -> DataFrame:
    """Add ``upper_band`` and ``lower_band`` of a column."""
    df = with_rolling(df, {"_mid": (column, n)}, {"_dev": (column, n)}, s)
    return df.withColumns(bands("_mid", "_dev", width)).drop("_mid", "_dev")


def gains_and_losses(change: str = "change") -> dict[str, Column]:
    """What RSI averages; the missing change of the first row counts as zero."""
    c = F.col(change)
    return {"_gain": F.when(c > 0, c).otherwise(0.0), "_loss": F.when(c < 0, -c).otherwise(0.0)}


def rsi(up: str = "_up", down: str = "_down") -> Column:
    """Relative strength from mean gain and loss: 100 without losses, NULL without any movement."""
    gain, loss = F.col(up), F.col(down)
    return F.when((loss == 0) & (gain > 0), 100.0).otherwise(100 - ratio(F.lit(100.0), 1 + ratio(gain, loss)))


def with_rsi(
    df: DataFrame, s: Series = DAILY, change: str = "change", n: int = 14, min_periods: int | None = None
) -> DataFrame:
    """Add ``rsi_<n>``; ``change`` names the difference to the previous row."""
    df = df.withColumns(gains_and_losses(change))
    df = with_means(df, {"_up": ("_gain", n), "_down": ("_loss", n)}, s, min_periods)
    return df.withColumn(f"rsi_{n}", rsi()).drop("_gain", "_loss", "_up", "_down")
