import datetime as dt

import pytest
from pyspark.sql import functions as F

from assetweave.operators import merge


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def prices(spark, data):
    return spark.createDataFrame(data, "asset string, dt string, close double, stamp int")


def test_upsert_newest_wins_and_repeats_change_nothing(spark):
    base = prices(spark, [("A", "d1", 1.0, 1), ("A", "d2", 2.0, 5), ("B", "d1", 3.0, 1)])
    delta = prices(spark, [("A", "d1", 10.0, 2), ("A", "d2", 20.0, 2), ("C", "d1", 4.0, 2)])
    once = merge.upsert(base, delta, ["asset", "dt"], "stamp", ["close"])
    assert rows(once) == [("A", "d1", 10.0, 2), ("A", "d2", 2.0, 5), ("B", "d1", 3.0, 1), ("C", "d1", 4.0, 2)]
    assert rows(merge.upsert(once, delta, ["asset", "dt"], "stamp", ["close"])) == rows(once)


def test_upsert_tie_goes_to_the_delta(spark):
    base = prices(spark, [("A", "d1", 1.0, 1)])
    delta = prices(spark, [("A", "d1", 2.0, 1), ("A", "d1", 3.0, 1)])
    assert rows(merge.upsert(base, delta, ["asset", "dt"], "stamp", tie=["close"])) == [("A", "d1", 3.0, 1)]


def test_dedupe_keeps_first_in_order_under_skew(spark):
    hot = spark.range(3000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    rest = spark.range(600).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    out = merge.dedupe(hot.union(rest), ["k"], [F.col("v").desc()])
    assert out.count() == 601
    assert out.where("k = 'hot'").first().v == 2999


def test_duplicate_groups(spark):
    df = spark.createDataFrame([("A",), ("A",), ("B",)], "k string")
    assert rows(merge.duplicate_groups(df, ["k"])) == [("A", 2)]


def test_merge_fields_writes_null_and_keeps_the_rest(spark):
    base = spark.createDataFrame([("A", 1.0, "x"), ("B", 2.0, "y")], "ticker string, vol double, note string")
    delta = spark.createDataFrame([("A", None, 9.0), ("C", 3.0, None)], "ticker string, vol double, beta double")
    got = {r.ticker: r.asDict() for r in merge.merge_fields(base, delta, "ticker").collect()}
    assert got["A"] == {"ticker": "A", "vol": None, "note": "x", "beta": 9.0}
    assert got["B"] == {"ticker": "B", "vol": 2.0, "note": "y", "beta": None}
    assert got["C"] == {"ticker": "C", "vol": 3.0, "note": None, "beta": None}


def test_merge_fields_refuses_a_key_twice(spark):
    base = spark.createDataFrame([("A", 1.0)], "ticker string, vol double")
    delta = spark.createDataFrame([("A", 2.0), ("A", 3.0)], "ticker string, vol double")
    with pytest.raises(Exception, match="more than one new row for A"):
        merge.merge_fields(base, delta, "ticker").collect()


def test_change_stats_sees_new_and_lost_columns(spark):
    before = spark.createDataFrame([(1, "a", "x"), (2, "b", None)], "k int, v string, old string")
    after = spark.createDataFrame([(1, "a", None), (2, "b", None)], "k int, v string, new string")
    stats = merge.change_stats(before, after, ["k"]).first()
    assert (stats.inserted, stats.removed, stats.updated, stats.unchanged) == (0, 0, 1, 1)


NOW = dt.datetime(2024, 5, 1, 12, tzinfo=dt.timezone.utc)


def folders(spark, table):
    from assetweave.sources.sinks import file_system

    fs, path_of = file_system(spark, table)
    return sum(
        p.getPath().getName().startswith("_partition=")
        for f in fs.listStatus(path_of(table))
        for p in fs.listStatus(f.getPath())
    )


def test_keyed_table_rewrites_only_what_it_touches(spark):
    from assetweave.session import new_path
    from assetweave.sources.keyed_table import read_keyed, upsert_table

    table, month = new_path(spark, "keyed"), F.substring("dt", 1, 7)

    def put(data, hours, **more):
        df = spark.createDataFrame(data, "asset string, dt string, close double")
        newest = [F.col("last_updated_timestamp").desc(), F.col("close").desc()]
        return upsert_table(df, table, ["asset", "dt"], newest, month, "close", NOW + dt.timedelta(hours=hours), **more)

    def files():
        return {r[0].split("/")[-1] for r in read_keyed(spark, table).select(F.input_file_name()).distinct().collect()}

    assert put([("A", "2024-01-01", 1.0), ("A", "2024-02-01", 2.0), ("B", "2024-02-01", 3.0)], 0) == {"written": 3, "failed": 0}
    first = files()
    assert put([("A", "2024-02-01", 5.0), ("C", "2024-03-01", 6.0), ("D", "2024-03-01", None), (None, "2024-03-01", 1.0)], 1) == {
        "written": 2,
        "failed": 2,
    }
    january = {f for f in first if f in files()}
    assert len(january) == 1  # the file of January is still the one written first
    assert put([], 2) == {"written": 0, "failed": 0}
    for hours in (3, 4, 5):
        put([("A", "2024-02-01", 5.0)], hours)
    got = rows(read_keyed(spark, table).select("asset", "dt", "close"))
    assert got == [("A", "2024-01-01", 1.0), ("A", "2024-02-01", 5.0), ("B", "2024-02-01", 3.0), ("C", "2024-03-01", 6.0)]
    assert read_keyed(spark, table).where("last_updated is null or last_updated_timestamp is null").count() == 0
    assert folders(spark, table) == 3


def test_change_stats(spark):
    before = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, None)], "k int, v string")
    after = spark.createDataFrame([(1, "a"), (2, "b"), (4, None), (5, "e")], "k int, v string")
    stats = merge.change_stats(before, after, ["k"]).first()
    assert (stats.inserted, stats.removed, stats.updated, stats.unchanged) == (1, 1, 1, 2)


def test_enrich_touches_incomplete_rows_only(spark):
    schema = "ticker string, short_name string, long_name string, asset_type string, sector string"
    meta = spark.createDataFrame(
        [("A", "Al", "Alpha", "EQUITY", "old"), ("B", "N/A", "Beta", "EQUITY", "old"), ("C", None, "x", "ETF", "old")], schema
    )
    found = spark.createDataFrame([("A", "1", "1", "1", "new"), ("B", "Be", None, "EQUITY", "new")], schema)
    got = {r.ticker: r for r in merge.enrich(meta, found).collect()}
    assert got["A"].sector == "old"
    assert (got["B"].short_name, got["B"].long_name, got["B"].sector) == ("Be", "N/A", "new")
    assert got["C"].short_name is None and got["C"].sector == "old"


@pytest.mark.parametrize(
    "kind, values, left",
    [
        ("double", [1.0, None, float("nan")], {"B", "C", "D"}),
        ("string", ["1", "x", None], {"A", "B", "C", "D"}),
        ("date", [dt.date(2020, 1, 1), None, dt.date(2020, 1, 1)], {"B", "D"}),
    ],
)
def test_pending(spark, kind, values, left):
    assets = spark.createDataFrame([("A",), ("B",), ("C",), ("D",), ("D",)], "ticker string")
    meta = spark.createDataFrame(list(zip("ABC", values)), f"ticker string, m {kind}")
    assert {r.ticker for r in merge.pending(assets, meta, ["m"]).collect()} == left
    assert merge.pending(assets, meta, ["absent"]).count() == 4
