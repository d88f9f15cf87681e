import datetime as dt
import json

import pytest
from pyspark.sql import types as T

from assetweave import schemas
from assetweave.plans.prices import returns_by_source
from assetweave.session import new_path, shared_dir
from assetweave.sources import readers, sinks


def test_ingest_aligns_columns_and_loses_no_rows(spark):
    a = spark.createDataFrame([("A", 1.0)], "asset string, close double")
    b = spark.createDataFrame([(2, 3.0), (3, 4.0)], "seq int, close double")
    out = readers.ingest({"hist": a, "live": b})
    assert out.columns == ["asset", "close_hist_1", "source", "seq", "close_live_1"]
    rows = {r.seq: r for r in out.collect()}
    assert len(rows) == 3 and rows[None].close_hist_1 == 1.0 and rows[2].asset is None and rows[2].source == "live"


def test_universe(spark):
    rows = readers.universe(spark, {"Bonds": ["B1", "B2"], "Stocks": ["S1"]}).collect()
    assert {(r.category, r.ticker) for r in rows} == {("Bonds", "B1"), ("Bonds", "B2"), ("Stocks", "S1")}


def test_audit(spark):
    assets = spark.createDataFrame([("A",), ("B",), ("C",)], "ticker string")
    prices = spark.createDataFrame([("A", 1.0), ("A", None), ("B", None)], "ticker string, close double")
    got = {r.ticker: (r.n_rows, r.status) for r in readers.ingest_audit(assets, prices).collect()}
    assert got == {"A": (2, "success"), "B": (1, "error"), "C": (0, "empty")}


def test_vendor_json(spark):
    def day(value):
        return {name: value for name in readers.VENDOR_FIELDS}

    body = json.dumps({"2024-01-02": day("1.5"), "2024-01-03": {**day("2"), "4. close": "oops"}, "bad": day("3")})
    rows = readers.parse_daily_json(spark.createDataFrame([("A", body), ("B", "{not json")], "ticker string, body string")).collect()
    by_day = {r.dt: r for r in rows}
    assert by_day[dt.date(2024, 1, 2)].open == 1.5
    assert by_day[dt.date(2024, 1, 3)].close is None and by_day[dt.date(2024, 1, 3)].volume == 2
    assert None in by_day and all(r.ticker == "A" for r in rows)


def test_vendor_json_in_its_envelope(spark):
    bars = {"2024-01-02": {name: "1" for name in readers.VENDOR_FIELDS}}
    body = json.dumps({"Meta Data": {"2. Symbol": "A"}, readers.VENDOR_ENVELOPE: bars})
    df = spark.createDataFrame([("A", body), ("B", '{"Note": "limit reached"}')], "ticker string, body string")
    rows = readers.parse_daily_json(df, envelope=readers.VENDOR_ENVELOPE).collect()
    assert [(r.ticker, r.dt, r.close) for r in rows] == [("A", dt.date(2024, 1, 2), 1.0)]


def test_csv_round_trip_and_append(spark, make_bars):
    path = new_path(spark, "csv")
    bars = make_bars({"A": [1.25, 2.5]})
    sinks.append_csv(bars, path)
    sinks.append_csv(bars, path)
    back = readers.read_csv(spark, path, schemas.BARS)
    assert back.schema == schemas.BARS and back.count() == 4
    sinks.write_csv(bars, path)
    assert sorted(map(tuple, readers.read_csv(spark, path, schemas.BARS).collect())) == sorted(map(tuple, bars.collect()))


def test_landed_files_are_tagged_by_folder(spark):
    path = new_path(spark, "landed")
    prices = spark.createDataFrame([("2024-01-01", 1.0, "A"), ("2024-01-01", 2.0, "B")], "dt string, close double, asset string")
    prices.write.partitionBy("asset").option("header", True).csv(path)
    schema = T.StructType([T.StructField("dt", T.DateType()), T.StructField("close", T.DoubleType())])
    got = {(r.asset, r.close) for r in readers.load_prices(spark, path, schema).collect()}
    assert got == {("A", 1.0), ("B", 2.0)}


def test_table_without_store_id(spark):
    path = new_path(spark, "t")
    spark.createDataFrame([("x", 1)], "_id string, a int").write.parquet(path)
    assert readers.read_table(spark, path).columns == ["a"]


def test_a_table_keeps_columns_whatever_its_name(spark):
    path = f"{new_path(spark, 'named')}/events.parquet"
    spark.createDataFrame([(1, "x")], "event_id long, extra string").write.parquet(path)
    assert readers.read_table(spark, path).columns == ["event_id", "extra"]


def test_ticks_are_told_apart_by_whole_part_and_price(spark, tmp_path):
    """Equal orders, lines and low digits of the part number; order numbers beyond 2^40."""
    import datetime as dt

    from assetweave.schemas import STORED
    from assetweave.sources import market_tables as tables

    day, order = dt.datetime(2000, 1, 1), (1 << 45) + 1
    lines = [(order, (5 << 20) + 1, 1, 1, 1.0, price, 0.0, 0.0, "", "", day) for price in (30.0, 10.0, 20.0)]
    lines.append((order, 1, 1, 1, 1.0, 99.0, 0.0, 0.0, "", "", day))
    spark.createDataFrame(lines, STORED["lineitem"]).repartition(3).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "S", 1, 0.0)], STORED["supplier"]).write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(1, "N", 1)], STORED["nation"]).write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(1, "R")], STORED["region"]).write.parquet(f"{tmp_path}/region.parquet")
    bar = tables.bars(spark, str(tmp_path)).first()
    assert (bar.open, bar.close, bar.high, bar.low) == (99.0, 30.0, 99.0, 10.0)


def test_asof_close_skips_missing_prices(make_bars):
    from assetweave.operators import returns

    bars = make_bars({"A": [1.0, 2.0, None]})
    got = returns.asof_closes(bars, ["2019-12-31", "2020-01-02", "2020-01-03"]).orderBy("as_of").collect()
    assert [(str(r.as_of), r.close) for r in got] == [("2019-12-31", None), ("2020-01-02", 2.0), ("2020-01-03", 2.0)]


def test_a_second_index_row_is_an_error(make_bars):
    from assetweave.operators import market

    bars = make_bars({"A": [1.0, 2.0]})
    index = bars.select("dt", "close")
    assert market.with_market(bars, index).count() == 2
    with pytest.raises(Exception, match="more than one index row"):
        market.with_market(bars, index.unionAll(index)).collect()


def test_versions(spark):
    table = new_path(spark, "versions")
    with pytest.raises(ValueError):
        sinks.read_current(spark, table)
    sinks.overwrite(spark.range(3), table)
    current = sinks.read_current(spark, table)
    sinks.overwrite(current.where("id > 0"), table)  # replaces the table it reads
    assert current.count() == 3
    assert sinks.read_current(spark, table).count() == 2


def test_stage_counts_come_with_the_write(spark):
    observed, seen = sinks.observe_stage(spark.range(7), "numbers")
    sinks.append(observed, new_path(spark, "observed"))
    row = sinks.stage_metrics(spark, {"numbers": seen}).first()
    assert (row.stage, row.status, row.rows) == ("numbers", "success", 7)


def test_date_range_is_half_open(make_bars):
    bars = make_bars({"A": [1.0, 2.0, 3.0]})
    assert [r.close for r in readers.date_range(bars, "2020-01-02", "2020-01-03").collect()] == [2.0]


def test_returns_by_source_keep_every_priced_row(spark):
    schema = "asset string, ts timestamp_ntz, seq long, close double"
    hist = spark.createDataFrame([("A", dt.datetime(2024, 1, d), 0, float(d)) for d in range(1, 6)], schema)
    live = spark.createDataFrame([("A", dt.datetime(2024, 1, 1), i, 10.0 + i) for i in range(40)] + [("B", None, 1, 1.0)], schema)
    out = returns_by_source({"hist": hist, "live": live}, block_rows=8).collect()
    assert len(out) == 45
    first = [r for r in out if r.daily_return is None]
    assert {(r.source, r.seq) for r in first} == {("hist", 0), ("live", 0)}
    by_seq = {r.seq: r for r in out if r.source == "live"}
    assert by_seq[39].daily_return == pytest.approx(49 / 48 - 1)


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
