"""What the physical plans must look like for the jobs to scale."""

import re

import pytest
from pyspark.sql import functions as F

from assetweave.operators import merge, metrics, portfolio
from assetweave.plans import features
from assetweave.queries import QUERIES
from assetweave.session import stored
from assetweave.sources import market_tables as tables
from assetweave.sources import readers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bars(spark, sf_dir):
    return stored(tables.bars(spark, sf_dir), "bars")


def shuffles(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


@pytest.mark.parametrize("build", [features.basic_features, features.advanced_features])
def test_feature_sets_shuffle_once(bars, build):
    text = plan(build(bars))
    assert shuffles(text) == 1
    assert "Join" not in text


def test_all_metrics_share_one_shuffle(bars):
    text = plan(metrics.asset_metrics(bars, "2001-11-04"))
    assert shuffles(text) == 1
    assert "ReadSchema: struct<ticker:string,dt:date,close:double>" in text


def test_bars_are_hash_aggregated_before_the_join(spark, sf_dir):
    text = plan(tables.bars(spark, sf_dir))
    assert "SortAggregate" not in text
    assert text.index("BroadcastHashJoin") < text.index("HashAggregate")  # the plan prints top down
    assert "partial_max" in text


@pytest.mark.parametrize(
    "build",
    [
        lambda b: merge.dedupe(b, ["ticker", "dt"], ["close"]),
        lambda b: merge.upsert(b, b, ["ticker", "dt"], "dt", ["close"]),
        lambda b: portfolio.choose_assets(b, ["category"]),
    ],
)
def test_top_rows_are_cut_before_the_shuffle(bars, build):
    text = plan(build(bars))
    before_shuffle = text[text.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_latest_row_per_asset_is_a_partial_aggregate(bars):
    text = plan(portfolio.latest_per_asset(bars, ["ticker", "category"], ["close"]))
    assert "partial_max_by" in text and "SortAggregate" not in text


def test_lookup_is_pushed_into_the_scan(bars):
    text = plan(readers.prices_for(bars, "Supplier#000000001", key="ticker"))
    assert "EqualTo(ticker,Supplier#000000001)" in text
    assert "ReadSchema: struct<ticker:string,dt:date,close:double>" in text


def test_date_range_is_pushed_into_the_scan(bars):
    text = plan(readers.date_range(bars, "1998-01-01", "1999-01-01"))
    assert "GreaterThanOrEqual(dt,1998-01-01)" in text and "LessThan(dt,1999-01-01)" in text


def scans(text, column="l_suppkey"):
    return len(re.findall(rf"FileScan parquet \[[^\]]*{column}", text))


def test_one_asset_reads_only_its_own_ticks_into_the_aggregation(spark, sf_dir):
    text = plan(QUERIES["s09_prices_for"](spark, sf_dir))
    below = text[text.rindex("HashAggregate(keys=[l_suppkey") :]
    assert "LeftSemi" in below and "EqualTo(s_name,Supplier#000000001)" in below


@pytest.mark.parametrize(
    "name",
    "j01_with_market a09_beta w15_alpha w20_enhanced_bars p04_project_enhanced k08_change_stats p09_impute_mean "
    "a15_refresh_metadata".split(),
)
def test_ticks_are_read_once(spark, sf_dir, name):
    """The bars are stored by one pass; what follows reads the stored rows."""
    assert scans(plan(QUERIES[name](spark, sf_dir))) == 0


def test_users_are_not_shuffled_for_their_portfolios(spark, sf_dir, bars):
    label = F.when(F.col("close") > 1000, "Low Risk").otherwise("High Risk")
    labelled = bars.select("ticker", "category", label.alias("risk_category"), F.col("close").alias("momentum"))
    text = plan(portfolio.build_portfolio(tables.users(spark, sf_dir), labelled))
    assert "BroadcastHashJoin" in text and "CartesianProduct" not in text and "NestedLoop" not in text
    # users are read on the join's streamed side, with no exchange on their way
    streamed = text[text.index(":-") : text.index("BroadcastExchange")]
    assert "c_custkey" in streamed and "Exchange" not in streamed


def test_class_shares_do_not_gather_a_class(bars):
    label = F.when(F.col("close") > 1000, "Low Risk").otherwise("High Risk")
    labelled = bars.select("ticker", label.alias("risk_category"), F.col("close").alias("momentum"))
    text = plan(portfolio.allocate(labelled))
    assert "Window" not in text and "partial_sum" in text
