"""Row-to-row changes of a series, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assetweave.functions.cleaning import col, ratio
from assetweave.operators.series import DAILY, Series


def previous(c: Column | str, n: int = 1, s: Series = DAILY) -> Column:
    return F.lag(col(c), n).over(s.window)


def daily_return(c: Column | str = "close", s: Series = DAILY) -> Column:
    """Close-to-close return."""
    return ratio(c, previous(c, 1, s)) - 1


def intraday_return(open_: Column | str = "open", close: Column | str = "close") -> Column:
    return ratio(col(close) - col(open_), open_)


def log_return(c: Column | str = "close", s: Series = DAILY) -> Column:
    return F.ln(ratio(c, previous(c, 1, s)))


def difference(c: Column | str, n: int, s: Series = DAILY) -> Column:
    return col(c) - previous(c, n, s)


def momentum(c: Column | str = "close", n: int = 14, s: Series = DAILY) -> Column:
    """Relative change over n rows."""
    return ratio(c, previous(c, n, s)) - 1
