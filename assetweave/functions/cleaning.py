"""Column expressions for dirty text, dates and ratios. Bad input gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: fixed values: the two date formats that occur in stored prices
ISO_DATE = "yyyy-MM-dd"
US_DATE = "MM/dd/yyyy"
US_DATE_PATTERN = r"^\d{2}/\d{2}/\d{4}$"
#: fixed values: signs in stored amounts, and the text for a missing value
MONEY_SIGNS = r"[\$,]"
NOT_AVAILABLE = "N/A"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient; NULL where the denominator is zero or NULL."""
    return F.try_divide(col(numerator), col(denominator))


def clean_money(text: Column | str) -> Column:
    """``"$1,234.50"`` to 1234.5."""
    number = F.regexp_replace(F.trim(col(text)), MONEY_SIGNS, "").try_cast("double")
    return F.when(~F.isnan(number), number)


def parse_date(text: Column | str, fmt: str = ISO_DATE) -> Column:
    return F.try_to_timestamp(col(text), F.lit(fmt)).cast("date")


def is_us_date(text: Column | str) -> Column:
    return col(text).rlike(US_DATE_PATTERN)


def parse_price_date(text: Column | str) -> Column:
    """Date of either stored format."""
    return F.when(is_us_date(text), parse_date(text, US_DATE)).otherwise(parse_date(text))


def missing_text(c: Column | str) -> Column:
    """NULL or the "N/A" sentinel."""
    return col(c).isNull() | (col(c) == NOT_AVAILABLE)


def nan_to_null(c: Column | str) -> Column:
    return F.nanvl(col(c), F.lit(None).cast("double"))
