"""Market tables derived from the driver's parquet files.

One supplier is one asset, so the number of assets grows with the data. A line
item is a tick: price per unit, quantity, dividend (the discount). Ticks are
aggregated to one bar per asset and day *before* any join, with partial
aggregation on the map side, so an asset that owns a third of all ticks costs
no more shuffle than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assetweave import schemas
from assetweave.sources.readers import read_table

#: fixed value: last trading day of the derived tables, used as "today"
TODAY = "2001-11-04"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, with the columns this module needs."""
    return read_table(spark, f"{sf_dir}/{name}.parquet", schemas.STORED[name])


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        F.to_date("l_shipdate").alias("dt"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("qty"),
        F.col("l_discount").alias("disc"),
        tick_number().alias("seq"),
    )


def tick_number() -> Column:
    """Order of the ticks of a day: order, line, whole part number and price in cents, as one decimal.

    A decimal has a fixed width, so the first and last price stay in a hash
    aggregation. Order numbers of 15, part numbers of 11 and prices of 10 digits
    fit; beyond that the arithmetic raises.
    """

    def digits(value, n: int) -> Column:
        return value.cast(f"decimal({n},0)")

    line = digits(F.col("l_orderkey"), 15) * F.lit(100).cast("decimal(3,0)") + digits(F.col("l_linenumber"), 2)
    part = digits(line, 17) * F.lit(10**11).cast("decimal(12,0)") + digits(F.col("l_partkey"), 11)
    cents = digits(F.round(F.col("l_extendedprice") * 100), 10)
    return digits(digits(part, 28) * F.lit(10**10).cast("decimal(11,0)"), 38) + cents


def with_category(df: DataFrame, spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """Join ticker and category of each asset to ``df``.

    Suppliers grow with the data, so statistics decide how to join them; nation
    and region are tables of fixed size. They are joined after the suppliers:
    the size estimate of a join is the product of its sides, and a chained
    dimension would look too large to broadcast.
    """
    supplier = table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_nationkey", F.col("s_name").alias("ticker")
    )
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select(
        "r_regionkey", F.col("r_name").alias("category")
    )
    return (
        df.join(supplier, df[key] == supplier.s_suppkey)
        .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    )


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """suppkey, ticker, category of every asset."""
    keys = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("_key"))
    return with_category(keys, spark, sf_dir, "_key").select("s_suppkey", "ticker", "category")


def bars(spark: SparkSession, sf_dir: str, ticker: str | None = None) -> DataFrame:
    """One OHLCV row per (ticker, dt); with ``ticker`` only that asset's ticks are read into the aggregation."""
    raw = ticks(spark, sf_dir)
    if ticker is not None:
        wanted = table(spark, sf_dir, "supplier").where(F.col("s_name") == ticker).select("s_suppkey")
        raw = raw.join(wanted, raw.l_suppkey == wanted.s_suppkey, "left_semi")
    daily = (
        raw
        .groupBy("l_suppkey", "dt")
        .agg(
            F.min_by("price", "seq").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "seq").alias("close"),
            F.sum("qty").alias("volume"),
            F.max("disc").alias("dividends"),
        )
    )
    return with_category(daily, spark, sf_dir, "l_suppkey").select(
        "ticker", "category", "dt", "open", "high", "low", "close", "volume", "dividends"
    )


def market(price_bars: DataFrame) -> DataFrame:
    """Stand-in index: highest close of the day. At most one row per calendar day."""
    return price_bars.groupBy("dt").agg(F.max("close").alias("close"))


def fundamentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("ticker"), (F.col("s_acctbal") / 1000).alias("eps")
    )


def raw_quotes(price_bars: DataFrame) -> DataFrame:
    """Prices as dirty text: two date formats, ``$`` amounts, ``n/a``, missing stamps."""
    day = F.dayofmonth("dt")
    whole = F.floor("close").cast("string")
    return price_bars.select(
        F.col("ticker").alias("asset"),
        F.when(day % 3 == 0, F.date_format("dt", "MM/dd/yyyy"))
        .otherwise(F.date_format("dt", "yyyy-MM-dd"))
        .alias("date_text"),
        F.when(day % 7 == 0, "n/a")
        .when(day % 4 == 0, F.concat(F.lit("$"), whole, F.lit(".50")))
        .otherwise(whole)
        .alias("close_text"),
        F.when(day % 5 != 0, F.col("dt")).alias("last_updated"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("user_id"),
        (18 + key % 63).alias("age"),
        (1000 + 500 * (key % 100)).alias("amount"),
        (1 + key % 20).alias("duration"),
        F.when(key % 3 == 0, "Low").when(key % 3 == 1, "Medium").otherwise("High").alias("tolerance"),
    )


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptive attributes per asset, with NULL and "N/A" gaps."""
    key = F.col("s_suppkey")
    return assets(spark, sf_dir).select(
        "ticker",
        F.when(key % 4 == 0, None).when(key % 4 == 1, "N/A").otherwise(F.col("ticker")).alias("short_name"),
        F.when(key % 5 == 0, "ETF").otherwise("EQUITY").alias("asset_type"),
        F.col("category").alias("sector"),
    )


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intraday quotes: a handful of assets, any number of rows each."""
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", F.col("event_type").alias("asset"), F.col("value").alias("price")
    )


def asof_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(request_id, ticker, as_of): one request per order, a third of them for one asset, some before its first bar."""
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select(
        key.alias("request_id"),
        F.date_sub(F.to_date("o_orderdate"), F.when(key % 10 == 0, 400).otherwise(0)).alias("as_of"),
        F.when(key % 3 == 0, 0).otherwise(F.col("o_custkey")).alias("_asset"),
    )
    largest = table(spark, sf_dir, "supplier").agg(F.coalesce(F.max("s_suppkey"), F.lit(0))).first()[0]
    orders = orders.withColumn("_suppkey", F.col("_asset") % (largest + 1))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("ticker"))
    joined = orders.join(supplier, orders["_suppkey"] == supplier["s_suppkey"])
    return joined.select("request_id", "ticker", "as_of")


def quote_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(request_id, asset, asked_at): some minutes after two of three quotes."""
    events = table(spark, sf_dir, "events")
    return events.where(F.col("event_id") % 3 != 0).select(
        F.col("event_id").alias("request_id"),
        F.col("event_type").alias("asset"),
        (F.col("ts") + F.expr("make_dt_interval(0, 0, cast(event_id % 7 as int), 0)")).alias("asked_at"),
    )
