import pytest
from pyspark.sql import functions as F

from assetweave.operators import portfolio


@pytest.fixture(scope="module")
def assets(spark):
    """Nearly all assets are in one class and category."""
    rows = []
    for i in range(400):
        label = ["High Risk", "Low Risk", "Medium Risk"][i % 3] if i % 20 == 0 else "High Risk"
        rows.append((f"T{i:03}", "hot" if i % 10 else f"c{i % 4}", label, float(i % 7) - 1.0, 10.0, None))
    return spark.createDataFrame(
        rows, "ticker string, category string, risk_category string, momentum double, pe_ratio double, x double"
    ).cache()


@pytest.fixture(scope="module")
def users(spark):
    rows = [(i, 18 + i % 60, 1000 + i, 1 + i % 20, ["Low", "Medium", "High"][i % 3]) for i in range(300)]
    return spark.createDataFrame(rows, "user_id long, age long, amount long, duration long, tolerance string")


def test_choice_is_bounded_seeded_and_without_repeats(assets):
    chosen = portfolio.choose_assets(assets, ["risk_category", "category"]).collect()
    groups = {}
    for r in chosen:
        groups.setdefault((r.risk_category, r.category), []).append(r.ticker)
    assert all(len(v) <= 5 and len(set(v)) == len(v) for v in groups.values())
    available = {(r.risk_category, r.category): r.n for r in assets.groupBy("risk_category", "category").agg(F.count("*").alias("n")).collect()}
    assert {k: min(5, n) for k, n in available.items()} == {k: len(v) for k, v in groups.items()}
    again = portfolio.choose_assets(assets.repartition(7), ["risk_category", "category"]).collect()
    assert {r.ticker for r in again} == {r.ticker for r in chosen}
    other = portfolio.choose_assets(assets, ["risk_category", "category"], seed=7).collect()
    assert {r.ticker for r in other} != {r.ticker for r in chosen}


def test_portfolios_follow_the_risk_class_and_spend_the_amount(assets, users):
    built = portfolio.build_portfolio(users, assets)
    scored = {r.user_id: r.risk_category for r in portfolio.scored_users(users).collect()}
    totals = {}
    for r in built.collect():
        assert r.risk_category == scored[r.user_id]
        if r.investment is not None:
            totals.setdefault(r.user_id, [r.amount, 0.0])[1] += r.investment
    assert totals
    assert all(total == pytest.approx(amount) for amount, total in totals.values())


def test_zero_momentum_gives_no_allocation(spark):
    df = spark.createDataFrame([("u", 1.0), ("u", -1.0)], "risk_category string, momentum double")
    assert [r.share for r in portfolio.allocate(df).collect()] == [None, None]


def test_tolerance(assets, users):
    matched = portfolio.match_tolerance(assets, users)
    assert matched.count() == assets.count()
    assert matched.where("risk_category <> concat(tolerance, ' Risk')").count() == 0
    assert {r.n_users for r in matched.select("n_users").distinct().collect()} == {100}
    low = portfolio.for_tolerance(assets, "Low")
    assert 0 < low.count() < assets.count()


def test_sector_shares_sum_to_one(assets):
    rows = portfolio.sector_allocation(assets).collect()
    assert sum(r.share for r in rows) == pytest.approx(1.0)
    assert sum(r["count"] for r in rows) == 400


def test_signal(make_bars):
    rising = [float(i) for i in range(1, 32)]
    out = {r.ticker: r for r in portfolio.signal(make_bars({"UP": rising, "DOWN": rising[::-1], "NEW": rising[:29]})).collect()}
    assert set(out) == {"UP", "DOWN", "NEW"}
    assert out["NEW"].last_close == 29.0 and out["NEW"].last_moving_avg is None and out["NEW"].recommendation is None
    assert out["UP"].recommendation == "Buy" and out["DOWN"].recommendation == "Hold"
    assert out["UP"].last_close == 31.0 and out["UP"].last_moving_avg == pytest.approx(16.5)


def test_order_and_limits(make_bars):
    bars = make_bars({"B": [1.0, 2.0], "A": [3.0]})
    assert [r.ticker for r in portfolio.sorted_bars(bars).collect()] == ["A", "B", "B"]
    assert portfolio.first_rows(bars, ["ticker", "dt"], 1).first().close == 3.0
    assert portfolio.latest_record(bars, [F.col("dt").desc()]).first().close == 2.0
    latest = portfolio.latest_per_asset(bars, ["ticker"], ["close"]).collect()
    assert {r.ticker: r.close for r in latest} == {"A": 3.0, "B": 2.0}
    view = bars.withColumns({c: F.lit(1.0) for c in ("momentum", "pe_ratio")}).withColumn("risk_category", F.lit("Low Risk"))
    assert portfolio.portfolio_view(view).columns == ["ticker", "category", "momentum", "pe_ratio", "risk_category"]
