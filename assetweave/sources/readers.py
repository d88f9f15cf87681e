"""Readers: CSV with a given schema, landed price files, stored tables, vendor JSON."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetweave.functions.cleaning import parse_date

#: column added by document stores; never wanted
STORE_ID = "_id"

#: fixed value: the member of a vendor response that holds the daily bars
VENDOR_ENVELOPE = "Time Series (Daily)"
#: fixed values: vendor field names, in the order they become open..volume
VENDOR_FIELDS = ["1. open", "2. high", "3. low", "4. close", "5. volume"]


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header. The schema is given, so the files are read once."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A stored parquet table without the store's own id column, with ``schema`` or else the files' own columns."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path).drop(STORE_ID)


def load_prices(spark: SparkSession, folder: str, schema: T.StructType, tag: str = "asset") -> DataFrame:
    """Landed price files below ``folder/<tag>=<value>/``, the folder name becoming column ``tag``."""
    with_tag = T.StructType([*schema.fields, T.StructField(tag, T.StringType())])
    return spark.read.schema(with_tag).option("header", True).csv(folder)


def qualify(df: DataFrame, column: str, source: str, n: int = 1) -> DataFrame:
    """Rename ``close`` to ``close_<source>_<n>``."""
    return df.withColumnRenamed(column, f"{column}_{source}_{n}")


def ingest(sources: dict[str, DataFrame], qualify_column: str | None = "close") -> DataFrame:
    """Tag every source, fill columns it lacks with NULL, and union all rows.

    Columns come in order of first appearance.
    """
    frames = []
    for name, df in sources.items():
        if qualify_column:
            df = qualify(df, qualify_column, name)
        frames.append(df.withColumn("source", F.lit(name)))
    return union_all(frames)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def universe(spark: SparkSession, mapping: dict[str, list[str]]) -> DataFrame:
    """A category-to-tickers mapping as (category, ticker) rows."""
    rows = spark.createDataFrame(list(mapping.items()), "category string, tickers array<string>")
    return rows.select("category", F.explode("tickers").alias("ticker"))


def universe_of(bars: DataFrame) -> DataFrame:
    """The universe that stored bars imply."""
    return bars.select("category", "ticker").distinct()


def parse_daily_json(df: DataFrame, body: str = "body", envelope: str | None = None) -> DataFrame:
    """Vendor JSON, date -> five text fields, to one typed row per date.

    ``envelope`` names the member that holds the dates, if the text is the whole response.
    """
    by_date = "map<string,map<string,string>>"
    if envelope:
        parsed = F.from_json(body, f"struct<`{envelope}`:{by_date}>")[envelope]
    else:
        parsed = F.from_json(body, by_date)
    fields = [F.col("fields")[name] for name in VENDOR_FIELDS]
    names = ["open", "high", "low", "close"]
    others = [c for c in df.columns if c != body]
    return (
        df.withColumn("_by_date", parsed)
        .select(*others, F.explode("_by_date").alias("date_text", "fields"))
        .select(
            *others,
            parse_date("date_text").alias("dt"),
            *[f.try_cast("double").alias(n) for f, n in zip(fields, names)],
            fields[4].try_cast("bigint").alias("volume"),
        )
    )


def prices_for(prices: DataFrame, asset: str, key: str = "asset") -> DataFrame:
    """Date and close of one asset; filter and projection reach the scan."""
    return prices.where(F.col(key) == asset).select("dt", "close")


def date_range(df: DataFrame, start: str, end: str, column: str = "dt") -> DataFrame:
    """Rows with start <= date < end."""
    c = F.col(column)
    return df.where((c >= F.to_date(F.lit(start))) & (c < F.to_date(F.lit(end))))


def ingest_audit(assets: DataFrame, prices: DataFrame, key: str = "ticker", value: str = "close") -> DataFrame:
    """Per asset of the universe: success, empty (no rows) or error (rows, none with a value)."""
    loaded = prices.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"), F.count(value).alias("n_valid"))
    n_rows = F.coalesce("n_rows", F.lit(0))
    n_valid = F.coalesce("n_valid", F.lit(0))
    return assets.select(key).distinct().join(loaded, key, "left").select(
        key,
        n_rows.alias("n_rows"),
        F.when(n_rows == 0, "empty").when(n_valid == 0, "error").otherwise("success").alias("status"),
    )
