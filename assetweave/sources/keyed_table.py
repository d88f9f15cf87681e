"""A stored table with a key: upserts rewrite only the partitions they touch.

The table is plain Parquet, partitioned by a column that follows from the key, and
read and written by Spark's own partition pruning and dynamic partition overwrite.
The new content of the touched partitions is written to the shared folder first,
so a job that is lost before the overwrite leaves the table as it was, and one that is
lost within it is mended by running the same upsert again: the same row wins again.
One writer at a time; readers start after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetweave.operators.merge import dedupe
from assetweave.session import stored
from assetweave.sources.sinks import file_system

PARTITION = "_partition"


def _table(spark: SparkSession, table: str) -> DataFrame | None:
    fs, path_of = file_system(spark, table)
    if not fs.exists(path_of(table)):
        return None
    # a partition's value is text, whatever it looks like
    schema = spark.read.parquet(table).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name != PARTITION)
    return spark.read.schema(f"{fields}, {PARTITION} string").parquet(table)


def read_keyed(spark: SparkSession, table: str) -> DataFrame:
    """The current rows."""
    rows = _table(spark, table)
    if rows is None:
        raise ValueError(f"there is no table {table}")
    return rows.drop(PARTITION)


def stamped(rows: DataFrame, now) -> DataFrame:
    """Rows with the date and time of their last change."""
    return rows.withColumns({"last_updated": F.lit(now.date()), "last_updated_timestamp": F.lit(now)})


def upsert_table(
    delta: DataFrame, table: str, keys: list[str], order: list, partition, value: str | None = None, now=None
) -> dict[str, int]:
    """Put ``delta`` into the table: per key the first row in ``order`` stays, of old and new ones.

    ``partition`` is the column expression that rows are stored by, say the month;
    it must follow from the key. ``order`` must be total. With ``now`` new rows are
    stamped. Rows without a key or, if named, a ``value`` are not written. Returns
    the numbers of rows written and failed, so that a caller can report both.
    """
    spark = delta.sparkSession
    good = F.lit(True)
    for name in [*keys, *([value] if value else [])]:
        good = good & F.col(name).isNotNull()
    delta = stamped(delta, now) if now else delta
    delta = stored(delta.withColumn("_good", good).withColumn(PARTITION, F.coalesce(partition.cast("string"), F.lit("none"))), "delta")
    counts = delta.agg(F.count_if("_good").alias("written"), F.count_if(~F.col("_good")).alias("failed")).first()
    rows = delta.where("_good").drop("_good")
    touched = [r[0] for r in rows.select(PARTITION).distinct().collect()]  # dates, not rows
    if not touched:
        return counts.asDict()
    old = _table(spark, table)
    if old is not None:
        rows = rows.unionByName(old.where(F.col(PARTITION).isin(touched)), allowMissingColumns=True)
    kept = stored(dedupe(rows, keys, order), "upserted")
    writer = kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION)
    writer.parquet(table)
    return counts.asDict()
