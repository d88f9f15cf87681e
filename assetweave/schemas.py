"""Explicit schemas of the tables the stages exchange, and the column check."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


PRICES = _struct(asset=T.StringType(), dt=T.DateType(), close=T.DoubleType())

BARS = _struct(
    ticker=T.StringType(),
    category=T.StringType(),
    dt=T.DateType(),
    open=T.DoubleType(),
    high=T.DoubleType(),
    low=T.DoubleType(),
    close=T.DoubleType(),
    volume=T.DoubleType(),
    dividends=T.DoubleType(),
)

RAW_QUOTES = _struct(
    asset=T.StringType(),
    date_text=T.StringType(),
    close_text=T.StringType(),
    last_updated=T.DateType(),
    last_updated_timestamp=T.TimestampType(),
)

QUOTES = _struct(event_id=T.LongType(), ts=T.TimestampNTZType(), asset=T.StringType(), price=T.DoubleType())

EVENTS = _struct(
    event_id=T.LongType(),
    ts=T.TimestampNTZType(),
    user_id=T.LongType(),
    event_type=T.StringType(),
    value=T.DoubleType(),
    props=T.StringType(),
)

USERS = _struct(
    user_id=T.LongType(),
    age=T.LongType(),
    amount=T.LongType(),
    duration=T.LongType(),
    tolerance=T.StringType(),
)

PRICE_LINES = _struct(ticker=T.StringType(), dt=T.DateType(), close=T.DoubleType())

#: stored tables read by name; with the schema given, opening one starts no job
STORED = {
    "orders": _struct(o_orderkey=T.LongType(), o_custkey=T.LongType(), o_orderdate=T.TimestampNTZType()),
    "lineitem": _struct(
        l_orderkey=T.LongType(),
        l_partkey=T.LongType(),
        l_suppkey=T.LongType(),
        l_linenumber=T.IntegerType(),
        l_quantity=T.DoubleType(),
        l_extendedprice=T.DoubleType(),
        l_discount=T.DoubleType(),
        l_tax=T.DoubleType(),
        l_returnflag=T.StringType(),
        l_linestatus=T.StringType(),
        l_shipdate=T.TimestampNTZType(),
    ),
    "supplier": _struct(
        s_suppkey=T.LongType(), s_name=T.StringType(), s_nationkey=T.IntegerType(), s_acctbal=T.DoubleType()
    ),
    "nation": _struct(n_nationkey=T.IntegerType(), n_name=T.StringType(), n_regionkey=T.IntegerType()),
    "region": _struct(r_regionkey=T.IntegerType(), r_name=T.StringType()),
    "customer": _struct(
        c_custkey=T.LongType(),
        c_name=T.StringType(),
        c_nationkey=T.IntegerType(),
        c_acctbal=T.DoubleType(),
        c_mktsegment=T.StringType(),
    ),
    "events": EVENTS,
}

#: fixed values: column list of the basic processed table
PROCESSED = ["dt", "open", "high", "low", "close", "volume", "ticker", "category"]
#: fixed values: column list of the enhanced processed table
PROCESSED_ENHANCED = [*PROCESSED, "momentum", "beta", "alpha", "pe_ratio", "dividend_yield"]


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Return ``df`` unchanged, or raise naming every missing column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df
