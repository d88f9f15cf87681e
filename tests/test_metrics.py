import datetime as dt
import math
import statistics

import pytest
from pyspark.sql import functions as F

from assetweave.operators import market, metrics, returns
from assetweave.plans import assets as asset_plans


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def daily(closes):
    return [b / a - 1 for a, b in zip(closes, closes[1:])]


def test_volatility_and_ratios(make_bars):
    closes = [100.0, 101.0, 99.0, 103.0, 102.0, 105.0, 101.0]
    rets = daily(closes)
    prices = metrics.with_returns(make_bars({"A": closes}))
    row = one(metrics.volatility(prices))
    sd = statistics.stdev(rets)
    assert row.daily_volatility == pytest.approx(sd)
    assert row.annual_volatility == pytest.approx(sd * math.sqrt(252))
    excess = statistics.mean(r - 0.02 / 252 for r in rets)
    assert one(metrics.sharpe(prices)).sharpe_ratio == pytest.approx(excess / sd)
    down = statistics.stdev(r for r in rets if r < 0)
    assert one(metrics.sortino(prices)).sortino_ratio == pytest.approx(excess / down)


@pytest.mark.parametrize("closes", [[1.0, 2.0, 3.0], [3.0, 2.0, 4.0, 5.0]])
def test_sortino_needs_two_negative_returns(make_bars, closes):
    assert one(metrics.sortino(metrics.with_returns(make_bars({"A": closes})))).sortino_ratio is None


def test_single_row_asset_has_no_metrics(make_bars):
    row = one(metrics.asset_metrics(make_bars({"A": [5.0]}), "2020-06-01"))
    assert row.annual_volatility is None and row.sharpe_ratio is None and row.risk_adjusted_ytd is None


def test_flat_prices_give_null_ratios(make_bars):
    row = one(metrics.asset_metrics(make_bars({"A": [5.0] * 5}), "2020-01-05"))
    assert row.daily_volatility == 0.0
    assert row.sharpe_ratio is None and row.risk_adjusted_ytd is None and row.return_ytd == 0.0


def test_trailing_returns(spark):
    rows = [("A", dt.date(2016, 1, 4), 10.0), ("A", dt.date(2019, 1, 2), 20.0), ("A", dt.date(2019, 12, 30), 40.0)]
    prices = spark.createDataFrame([*rows, ("A", None, 9.0), ("A", dt.date(2019, 12, 31), None)], "ticker string, dt date, close double")
    row = one(returns.trailing_returns(prices, "2020-01-02"))
    assert row.return_ytd is None  # no price since 1 January
    assert row.return_1y == pytest.approx(100.0)
    assert row.return_3y == pytest.approx(300.0)
    assert row.return_5y is None  # no price that old
    row = one(returns.trailing_returns(prices, "2019-12-31"))
    assert row.return_ytd == pytest.approx(100.0)


def test_asof_takes_the_last_close_at_or_before(spark):
    prices = spark.createDataFrame(
        [("A", dt.date(2019, 1, 1), 1.0), ("A", dt.date(2019, 1, 2), 2.0), ("A", dt.date(2019, 1, 3), 3.0)],
        "ticker string, dt date, close double",
    )
    assert one(returns.asof_close(prices, "2020-01-02")).close_1y == 2.0


def test_beta_and_alpha(make_bars, spark):
    market_closes = [100.0, 102.0, 101.0, 104.0, 103.0]
    index = make_bars({"M": market_closes}).select("dt", "close")
    closes = [50.0, 52.0, 51.5, 54.0, 53.0]
    joined = market.with_market_returns(market.with_market(make_bars({"A": closes}), index))
    r, m = daily(closes), daily(market_closes)
    beta = statistics.covariance(r, m) / statistics.variance(m)
    assert one(market.beta(joined)).beta == pytest.approx(beta)
    full = market.with_beta(joined).withColumn("alpha", market.alpha()).orderBy("dt").collect()
    rf = 0.01 / 252
    assert full[0].alpha is None
    assert full[1].alpha == pytest.approx(r[0] - (rf + beta * (m[0] - rf)))


def test_market_dates_without_index_drop_out(make_bars):
    bars = make_bars({"A": [1.0, 2.0, 3.0]})
    index = bars.where(F.col("close") != 2.0).select("dt", "close")
    assert market.with_market(bars, index).count() == 2


def test_missing_eps_keeps_the_row(make_bars, spark):
    bars = make_bars({"A": [4.0], "B": [6.0]})
    eps = spark.createDataFrame([("A", 2.0)], "ticker string, eps double")
    rows = market.with_fundamentals(bars, eps).withColumn("pe", market.pe_ratio()).orderBy("ticker").collect()
    assert [r.pe for r in rows] == [2.0, None]


def test_refresh_computes_only_missing_assets(make_bars, spark):
    bars = make_bars({"A": [1.0, 2.0, 3.0], "B": [1.0, 3.0, 2.0], "C": [2.0, 1.0, 2.0]})
    meta = spark.createDataFrame([("A", 0.5, "x"), ("B", float("nan"), "y")], "ticker string, daily_volatility double, note string")
    fresh = asset_plans.refresh_metadata(bars.select("ticker"), meta, bars, "2020-01-03", ["daily_volatility"])
    rows = {r.ticker: r for r in fresh.collect()}
    assert rows["A"].daily_volatility == 0.5 and rows["A"].sharpe_ratio is None
    assert rows["B"].note == "y" and rows["B"].daily_volatility == pytest.approx(statistics.stdev([2.0, -1 / 3]))
    assert rows["C"].note is None and rows["C"].daily_volatility is not None
