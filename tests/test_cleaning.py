import datetime as dt

import pytest
from pyspark.sql import functions as F

from assetweave.functions.cleaning import clean_money, parse_price_date
from assetweave.functions.risk import age_risk, risk_bin, risk_score
from assetweave.operators import cleaning
from assetweave.schemas import require_columns

NOW = dt.datetime(2024, 5, 6, 7, 8, 9, tzinfo=dt.timezone.utc)


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


def test_clean_money(spark):
    values = ["$1,234.50", "x", "12", None, "", "NaN", " $7 "]
    assert column(spark, values, "string", clean_money) == [1234.5, None, 12.0, None, None, None, 7.0]


def test_dates_of_either_format(spark):
    got = column(spark, ["01/31/2024", "2024-01-31", "bad", "13/45/2024", None], "string", parse_price_date)
    assert got == [dt.date(2024, 1, 31), dt.date(2024, 1, 31), None, None, None]


def raw(spark):
    return spark.createDataFrame(
        [
            ("A", "01/31/2024", "$1", dt.date(2020, 1, 1), None),
            ("A", "2024-01-31", "2", None, None),
            ("B", "bad", "n/a", dt.date(2020, 1, 1), dt.datetime(2020, 1, 1)),
            ("B", "13/45/2024", "3", None, None),
        ],
        "asset string, date_text string, close_text string, last_updated date, last_updated_timestamp timestamp",
    )


def test_standardize_dates_stamps_changed_rows_only(spark):
    rows = {r.date_text: r for r in cleaning.standardize_dates(raw(spark).where("date_text <> '2024-01-31'"), NOW).collect()}
    assert set(rows) == {"2024-01-31", "bad", "13/45/2024"}
    assert rows["2024-01-31"].last_updated == NOW.date()
    assert rows["2024-01-31"].last_updated_timestamp is not None
    assert rows["bad"].last_updated == dt.date(2020, 1, 1)
    assert rows["13/45/2024"].last_updated is None


def test_assets_with_bad_dates(spark):
    assert {r.asset for r in cleaning.assets_with_bad_dates(raw(spark)).collect()} == {"A", "B"}
    clean = raw(spark).where("date_text = '2024-01-31'")
    assert cleaning.assets_with_bad_dates(clean).count() == 0


def test_backfill_fills_each_stamp_on_its_own(spark):
    counts = cleaning.missing_stamps(raw(spark)).first()
    assert (counts.last_updated_filled, counts.last_updated_timestamp_filled) == (2, 3)
    filled = cleaning.backfill_stamps(raw(spark), NOW)
    after = cleaning.missing_stamps(filled).first()
    assert (after.last_updated_filled, after.last_updated_timestamp_filled) == (0, 0)
    assert filled.where("last_updated = date'2020-01-01'").count() == 2


def test_require_every_and_any(spark):
    df = spark.createDataFrame(
        [(dt.date(2020, 1, 1), 1.0, None), (dt.date(2020, 1, 1), None, 2.0), (None, 1.0, 1.0), (dt.date(2020, 1, 2), 1.0, 2.0)],
        "dt date, close_a_1 double, close_b_1 double",
    )
    assert cleaning.require(df, how="every").count() == 1
    assert cleaning.require(df, how="any").count() == 3


def test_impute_mean_treats_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, None), (None, 7.0), (float("nan"), 6.0)], "a double, b double")
    rows = sorted((r.a, r.b) for r in cleaning.impute_mean(df, ["a", "b"]).collect())
    assert rows == [(1.0, 5.0), (2.0, 6.0), (2.0, 7.0), (3.0, 6.0)]
    with pytest.raises(ValueError, match="c"):
        cleaning.impute_mean(df, ["a", "c"])


def test_require_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert require_columns(df, ["a"]) is df
    with pytest.raises(ValueError, match="b, c"):
        require_columns(df, ["a", "b", "c"])
    with pytest.raises(ValueError):
        cleaning.project(df, ["b"])


def test_normalize_metadata(spark):
    df = spark.createDataFrame(
        [("A", "Alpha", "EQUITY", "Tech"), ("E", None, "ETF", "Tech"), ("N", "Nil", None, None)],
        "ticker string, short_name string, asset_type string, sector string",
    )
    rows = {r.ticker: r for r in cleaning.normalize_metadata(df, F.col("ticker") == "N").collect()}
    assert (rows["A"].sector, rows["A"].industry, rows["A"].long_name) == ("Tech", "N/A", "N/A")
    assert (rows["E"].sector, rows["E"].industry, rows["E"].short_name) == ("N/A", "N/A", "N/A")
    assert rows["N"].short_name == "Error" and rows["N"].currency == "Error"


def test_market_hours_in_new_york(spark):
    utc = [
        dt.datetime(2024, 1, 5, 20, 59, 59),  # Friday 15:59:59, winter
        dt.datetime(2024, 1, 5, 21, 0),
        dt.datetime(2024, 1, 6, 15, 0),  # Saturday
        dt.datetime(2024, 1, 8, 14, 30),  # Monday 09:30
        dt.datetime(2024, 1, 8, 14, 29, 59),
        dt.datetime(2024, 7, 8, 13, 30),  # Monday 09:30, summer
        dt.datetime(2024, 7, 8, 20, 0),
    ]
    got = column(spark, utc, "timestamp_ntz", cleaning.market_hours)
    assert got == [True, False, False, True, False, True, False]


def test_attach_user(spark):
    row = cleaning.attach_user(spark.createDataFrame([(1,)], "a int"), 30, 50000, 7).first()
    assert (row.user_age, row.investment_amount, row.investment_duration) == (30, 50000, 7)


def test_risk_rules(spark):
    df = spark.createDataFrame([(30, 7), (18, 2)], "age int, duration int")
    scores = [r.s for r in df.select(risk_score("age", "duration").alias("s")).collect()]
    assert scores == pytest.approx([5 / 35 + 1, 17 / 35 + 0.4])
    got = column(spark, [0.0, 0.5, 0.51, 1.0, 2.0, 2.01, -0.1, None], "double", risk_bin)
    assert got == ["Low Risk", "Low Risk", "Medium Risk", "Medium Risk", "High Risk", None, None, None]
    got = column(spark, [29, 30, 50, 51, None], "int", age_risk)
    assert got == ["Mid Risk", "High Risk", "High Risk", "Low Risk", None]
