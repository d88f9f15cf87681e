"""As-of join against a plain loop: carries over many blocks, ties, gaps, keys side by side."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from assetweave.operators.asof import asof_join

DAY = dt.date(2020, 1, 1)


def day(n):
    return None if n is None else DAY + dt.timedelta(days=n)


def plain(requests, values):
    out = []
    for i, key, at in requests:
        known = [(d, c) for k, d, c in values if k == key and None not in (k, d, c) and at is not None and d <= at]
        found = max(known, default=(None, None))
        out.append((i, key, at, found[1], found[0]))
    return sorted(out, key=repr)


def joined(spark, requests, values, **options):
    r = spark.createDataFrame(requests, "id long, ticker string, as_of date").repartition(3)
    v = spark.createDataFrame(values, "ticker string, dt date, close double").repartition(4)
    return sorted((tuple(x) for x in asof_join(r, v, found_at="close_at", **options).collect()), key=repr)


@pytest.mark.parametrize("block_rows", [1, 3, 7, 65_536])
def test_against_a_loop(spark, block_rows):
    rng = random.Random(block_rows)
    keys = ["hot"] * 6 + ["a", "b", "c", "sparse", None]
    values = [(rng.choice(keys[:9]), day(rng.randrange(60)), rng.choice([1.0, 2.0, 3.5, None])) for _ in range(80)]
    values += [("sparse", day(0), 9.0), (None, day(3), 1.0), ("a", None, 1.0)]
    requests = [(i, rng.choice([*keys, "unknown"]), day(rng.choice([*range(-3, 70), None]))) for i in range(150)]
    requests += [requests[5], (999, "sparse", day(69))]  # a repeated request; a value far back
    assert joined(spark, requests, values, block_rows=block_rows) == plain(requests, values)


def test_a_value_is_carried_over_blocks_without_any(spark):
    requests = [(i, "x", day(1 + i)) for i in range(50)] + [(100, "w", day(5)), (101, "y", day(5))]
    got = joined(spark, requests, [("x", day(0), 4.0), ("y", day(9), 5.0)], block_rows=2)
    assert all(r[3] == 4.0 and r[4] == day(0) for r in got if r[1] == "x")
    assert [r[3] for r in got if r[1] != "x"] == [None, None]


def test_empty_sides(spark):
    assert joined(spark, [], [("x", day(0), 1.0)]) == []
    assert joined(spark, [(1, "x", day(0))], []) == [(1, "x", day(0), None, None)]


def test_ties_types_and_columns(spark):
    values = spark.createDataFrame([("x", day(0), 1, 5.0), ("x", day(0), 2, 3.0)], "ticker string, dt date, seq int, close double")
    requests = spark.createDataFrame([("x", dt.datetime(2020, 1, 1, 15), "kept")], "ticker string, as_of timestamp_ntz, note string")
    row = asof_join(requests, values, tie=("seq",), name="price").first()
    assert (row.price, row.note, row.as_of) == (3.0, "kept", dt.datetime(2020, 1, 1, 15))
    assert asof_join(requests, values, name="price").first().price == 5.0
    with pytest.raises(ValueError, match="already"):
        asof_join(requests, values, name="note")


def test_a_hot_key_is_spread(spark):
    """One key with all rows: no block, and so no window group, has more than its share."""
    values = spark.range(5000).select(F.lit("x").alias("ticker"), F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("dt"), F.col("id").cast("double").alias("close"))
    requests = spark.range(5000).select(F.lit("x").alias("ticker"), F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("as_of"))
    got = asof_join(requests, values, block_rows=100)
    assert got.where(F.datediff("as_of", F.lit(DAY)) != F.col("close")).count() == 0 and got.count() == 5000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan or "BroadcastHashJoin" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
