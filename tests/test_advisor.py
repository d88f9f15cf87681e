from pyspark.sql import functions as F

from assetweave.plans import advisor
from assetweave.plans.advisor import FEATURES, recommend
from assetweave.session import new_path
from assetweave.sources import market_tables as tables


def test_chain_from_bars_to_portfolios(spark, sf_dir):
    bars = tables.bars(spark, sf_dir)
    out = recommend(
        bars, tables.market(bars), tables.fundamentals(spark, sf_dir), tables.users(spark, sf_dir), new_path(spark, "advisor")
    )
    stages = {r.stage: r.rows for r in out["stages"].collect()}
    for name, rows in stages.items():
        assert out[name].count() == rows > 0
    clustered = out["clustered"]
    assert clustered.select("risk_category").distinct().count() == 3
    assert clustered.where(F.greatest(*[F.col(c).isNull().cast("int") for c in FEATURES]) == 1).count() == 0
    explained = out["interpretation"].collect()
    assert {r.cluster for r in explained} == {r.prediction for r in clustered.select("prediction").distinct().collect()}
    portfolios = out["portfolios"]
    assert portfolios.groupBy("user_id", "ticker").count().where("count > 1").count() == 0
    assert portfolios.groupBy("user_id", "category").count().where("count > 5").count() == 0


def test_features_come_with_the_enhanced_bars(spark, sf_dir, monkeypatch):
    """The rows are brought together by asset once; what fills gaps reads written rows, compressed as in the other stages."""
    filled, impute = [], advisor.impute_mean

    def seen(df, columns):
        filled.append(df)
        return impute(df, columns)

    monkeypatch.setattr(advisor, "impute_mean", seen)
    bars = tables.bars(spark, sf_dir)
    out = recommend(
        bars, tables.market(bars), tables.fundamentals(spark, sf_dir), tables.users(spark, sf_dir), new_path(spark, "advisor")
    )
    plan = filled[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    assert "volatility_10" not in out["enhanced"].columns
    assert [c for c in out["features"].columns if c != "volatility_10"] == out["enhanced"].columns
    for name in ("enhanced", "features", "clustered"):
        assert all(f.endswith(".zstd.parquet") for f in out[name].inputFiles())
