"""A lookup reads a small part of the table, also for an asset that isn't there and for one with a third of all rows."""

import pytest
from pyspark.sql import functions as F

from assetweave.sources.lookup import lookup, rows_scanned, write_lookup

N = 300_000


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lookup") / "t")
    asset = F.when(F.col("id") % 3 == 0, "A0300").otherwise(F.format_string("A%04d", (F.col("id") % 1000) * 2))
    rows = spark.range(N).select(
        asset.alias("asset"),
        F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") / 1000).cast("int")).alias("dt"),
        F.rand(3).alias("close"),
        F.rand(4).alias("other"),
    )
    write_lookup(rows.repartition(8), path, group_bytes=64 << 10)
    return path


def test_few_rows_are_read(spark, table):
    found = lookup(spark, table, "A0004")
    assert len(found.collect()) == N / 1000 * 2 / 3
    assert rows_scanned(found) <= 0.1 * N
    assert found.columns == ["dt", "close"]


@pytest.mark.parametrize("asset", ["A0005", "A9999", "", "A0301"])
def test_an_unknown_asset_reads_next_to_nothing(spark, table, asset):
    found = lookup(spark, table, asset)
    assert found.collect() == []
    assert rows_scanned(found) <= 0.02 * N


def test_a_frequent_asset_is_spread(spark, table):
    found = spark.read.parquet(table).where("asset = 'A0300'").groupBy(F.input_file_name().alias("f")).count().collect()
    assert sum(r["count"] for r in found) >= N / 3 and len(found) >= 2


def test_without_the_layout_far_more_is_read(spark, tmp_path, table):
    plain = str(tmp_path / "plain")
    spark.read.parquet(table).repartition(4, F.rand(1)).write.parquet(plain)
    found = lookup(spark, plain, "A0004")
    found.collect()
    assert rows_scanned(found) > 0.2 * N  # pages are still skipped by their smallest and largest key
