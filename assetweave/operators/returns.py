"""Returns since a date, from conditional aggregates. No join, no sort; partial aggregation applies."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetweave.functions.cleaning import ratio

#: fixed values: look-back of the trailing returns in 365-day years
YEARS = {"return_1y": 1, "return_3y": 3, "return_5y": 5}


def _day(value: str | dt.date) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def asof(date: dt.date, value: str = "close", when: str = "dt") -> Column:
    """Aggregate: last known value at or before ``date``."""
    return F.max_by(value, F.when((F.col(when) <= F.lit(date)) & F.col(value).isNotNull(), F.col(when)))


def asof_close(prices: DataFrame, today: str, key: str = "ticker") -> DataFrame:
    """Close one, three and five 365-day years before ``today``, one row per asset."""
    base = _day(today)
    back = {f"close_{n}y": asof(base - dt.timedelta(days=365 * n)) for n in YEARS.values()}
    return prices.groupBy(key).agg(*[c.alias(name) for name, c in back.items()])


def asof_closes(prices: DataFrame, dates: list[str | dt.date], key: str = "ticker") -> DataFrame:
    """The last known close at or before each of ``dates``, one row per asset and date, from one aggregation."""
    days = sorted({_day(d) for d in dates})
    wide = prices.groupBy(key).agg(*[asof(d).alias(d.isoformat()) for d in days])
    long = wide.unpivot([key], [f"`{d.isoformat()}`" for d in days], "as_of", "close")
    return long.withColumn("as_of", F.to_date(F.regexp_replace("as_of", "`", "")))


def trailing_aggregates(today: str) -> dict[str, Column]:
    """Aggregates that ``trailing_columns`` turns into returns."""
    base = _day(today)
    new_year = F.lit(dt.date(base.year, 1, 1))
    return {
        "_last": F.max_by("close", "dt"),
        "_ytd_start": F.min_by("close", F.when(F.col("dt") >= new_year, F.col("dt"))),
        **{f"_from_{name}": asof(base - dt.timedelta(days=365 * n)) for name, n in YEARS.items()},
    }


def trailing_columns() -> dict[str, Column]:
    def percent(start: str) -> Column:
        return ratio(F.col("_last") - F.col(start), start) * 100

    return {"return_ytd": percent("_ytd_start"), **{name: percent(f"_from_{name}") for name in YEARS}}


def trailing_returns(prices: DataFrame, today: str, key: str = "ticker") -> DataFrame:
    """Percent returns: year to date, and 1, 3, 5 years; NULL without history."""
    prices = prices.where(F.col("dt").isNotNull() & F.col("close").isNotNull())
    totals = prices.groupBy(key).agg(*[c.alias(n) for n, c in trailing_aggregates(today).items()])
    return totals.select(key, *[c.alias(n) for n, c in trailing_columns().items()])
