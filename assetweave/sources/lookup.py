"""A price table laid out for lookups of one asset (S9).

Rows are range-sorted by the key and then by time, so that an asset lies in few files
and pages however large the table is, and an asset with a third of all rows is spread
over as many files as it needs. Row groups and pages are kept small and carry their
smallest and largest key; a Bloom filter per row group turns away keys that lie
between those but don't exist. All of it is Parquet's own and used by Spark's scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: bytes of a row group, rows of a page
GROUP_BYTES, PAGE_ROWS = 4 << 20, 5_000
#: different keys that a row group's Bloom filter is made for
KEYS_PER_GROUP = 10_000


def write_lookup(df: DataFrame, path: str, key: str = "asset", order: str = "dt", group_bytes: int = GROUP_BYTES) -> None:
    """Write ``df`` sorted by key and time, replacing what is there."""
    rows = df.repartitionByRange(F.col(key), F.col(order)).sortWithinPartitions(key, order)
    writer = rows.write.mode("overwrite").option("parquet.block.size", group_bytes)
    writer = writer.option("parquet.page.row.count.limit", PAGE_ROWS)
    writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.option(f"parquet.bloom.filter.expected.ndv#{key}", KEYS_PER_GROUP).parquet(path)


def lookup(spark: SparkSession, path: str, asset: str, key: str = "asset", columns: tuple[str, ...] = ("dt", "close")) -> DataFrame:
    """Some columns of one asset."""
    return spark.read.parquet(path).where(F.col(key) == asset).select(*columns)


def rows_scanned(df: DataFrame) -> int:
    """Rows that the scans of a plan gave to it when ``df`` ran; run an action on ``df`` first."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    total = 0
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numOutputRows")
        total += metric.get().value() if metric.isDefined() else 0
    return int(total)
