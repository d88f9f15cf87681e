"""Price flow: several sources in, one table of returns out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetweave.operators.cleaning import require
from assetweave.operators.metrics import quote_returns
from assetweave.operators.series import BLOCK_ROWS, Series
from assetweave.sources.readers import ingest


def returns_by_source(sources: dict[str, DataFrame], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Union the sources, keep rows with a time and a price, and add returns per source and asset.

    Each source has ``asset``, ``ts``, ``seq`` (order among equal times) and ``close``.
    One source may hold most rows, and one asset most of a source, so the series
    is laid out in blocks.
    """
    merged = ingest(sources)
    closes = [c for c in merged.columns if c.startswith("close_")]
    priced = require(merged, date="ts", how="any").withColumn("close", F.coalesce(*closes)).drop(*closes)
    return quote_returns(priced, Series(("source", "asset"), ("ts", "seq")), block_rows)
