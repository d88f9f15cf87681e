"""Cleaning operators on raw price rows and asset metadata."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetweave.functions.cleaning import (
    US_DATE,
    clean_money,
    col,
    is_us_date,
    missing_text,
    nan_to_null,
    parse_date,
    parse_price_date,
)
from assetweave.schemas import require_columns

#: fixed values: descriptive fields of an asset
DESCRIPTIVE = [
    "short_name",
    "long_name",
    "asset_type",
    "sector",
    "industry",
    "exchange",
    "currency",
    "description",
]
#: fixed values: fields whose absence marks an asset for enrichment
IDENTIFYING = ["short_name", "long_name", "asset_type"]


def with_date(df: DataFrame, source: str = "date_text", fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Add ``dt`` parsed with one format; text that does not parse gives NULL."""
    return df.withColumn("dt", parse_date(source, fmt))


def curate_prices(raw: DataFrame) -> DataFrame:
    """Typed prices from raw text of either date format."""
    return raw.withColumns({"dt": parse_price_date("date_text"), "close": clean_money("close_text")})


def require(df: DataFrame, date: str = "dt", prefix: str = "close_", how: str = "every") -> DataFrame:
    """Rows with a date and a price.

    ``how="every"`` asks for all price columns. After a union of sources each row
    has only its own source's column, so ``how="any"`` asks for one of them.
    """
    prices = [F.col(c).isNotNull() for c in df.columns if c.startswith(prefix)]
    condition = F.col(date).isNotNull()
    if prices:
        combined = prices[0]
        for p in prices[1:]:
            combined = combined & p if how == "every" else combined | p
        condition = condition & combined
    return df.where(condition)


def drop_incomplete(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.na.drop(subset=columns)


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    return require_columns(df, columns).select(*columns)


def standardize_dates(df: DataFrame, now: dt.datetime) -> DataFrame:
    """Rewrite ``MM/dd/yyyy`` text as ISO and stamp the rows that changed."""
    fixed = F.when(is_us_date("date_text"), parse_date("date_text", US_DATE))
    changed = F.col("_fixed").isNotNull()
    return (
        df.withColumn("_fixed", fixed)
        .withColumns(
            {
                "date_text": F.coalesce(F.date_format("_fixed", "yyyy-MM-dd"), "date_text"),
                "last_updated": F.when(changed, F.lit(now.date())).otherwise(F.col("last_updated")),
                "last_updated_timestamp": F.when(changed, F.lit(now)).otherwise(F.col("last_updated_timestamp")),
            }
        )
        .drop("_fixed")
    )


def assets_with_bad_dates(df: DataFrame, key: str = "asset") -> DataFrame:
    return df.where(is_us_date("date_text")).select(key).distinct()


def backfill_stamps(df: DataFrame, now: dt.datetime) -> DataFrame:
    """Fill each missing stamp on its own."""
    return df.withColumns(
        {
            "last_updated": F.coalesce("last_updated", F.lit(now.date())),
            "last_updated_timestamp": F.coalesce("last_updated_timestamp", F.lit(now)),
        }
    )


def missing_stamps(df: DataFrame) -> DataFrame:
    """How many rows each back-fill changes."""
    return df.agg(
        F.count_if(F.col("last_updated").isNull()).alias("last_updated_filled"),
        F.count_if(F.col("last_updated_timestamp").isNull()).alias("last_updated_timestamp_filled"),
    )


def impute_mean(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace NULL and NaN in the listed columns by the column mean."""
    known = require_columns(df, columns).withColumns({c: nan_to_null(c) for c in columns})
    means = known.agg(F.struct(*[F.avg(c).alias(c) for c in columns]).alias("m")).scalar()
    return known.withColumns({c: F.coalesce(F.col(c), means[c]) for c in columns})


def needs_enrichment() -> Column:
    first, *rest = [missing_text(c) for c in IDENTIFYING]
    for condition in rest:
        first = first | condition
    return first


def normalize_metadata(raw: DataFrame, failed: Column | None = None) -> DataFrame:
    """Missing text becomes "N/A"; funds have no sector or industry; failed look-ups read "Error"."""
    is_fund = F.coalesce(F.col("asset_type") == "ETF", F.lit(False))
    failed = F.lit(False) if failed is None else failed

    def cleaned(name: str) -> Column:
        value = F.coalesce(F.col(name), F.lit("N/A")) if name in raw.columns else F.lit("N/A")
        if name in ("sector", "industry"):
            value = F.when(is_fund, "N/A").otherwise(value)
        return F.when(failed, "Error").otherwise(value)

    return raw.select("ticker", *[cleaned(c).alias(c) for c in DESCRIPTIVE])


def attach_user(df: DataFrame, age: int, amount: int, duration: int) -> DataFrame:
    """The answers of one user as constant columns."""
    answers = {"user_age": age, "investment_amount": amount, "investment_duration": duration}
    return df.withColumns({name: F.lit(value) for name, value in answers.items()})


def market_hours(ts: Column | str) -> Column:
    """Weekday, 09:30 <= time < 16:00 in New York, for a UTC timestamp without zone."""
    local = F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), col(ts).cast("timestamp_ntz"))
    minute = F.hour(local) * 60 + F.minute(local)
    return (F.weekday(local) < 5) & (minute >= 570) & (minute < 960)
