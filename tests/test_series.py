"""The blocked layout gives the same values as the layout by asset, also under heavy skew."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from assetweave.operators.ema import ema_lookback, with_ema
from assetweave.operators.metrics import quote_returns, with_returns
from assetweave.operators.series import DAILY, Series, in_blocks, with_position
from assetweave.plans import features


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of all rows belong to one asset; many assets have one or two rows."""
    rng = random.Random(9)
    sizes = {"hot": 1500, "warm": 700, **{f"t{i:03}": 1 + i % 4 for i in range(300)}}
    rows = []
    for ticker, n in sizes.items():
        for i in range(n):
            close = rng.uniform(10, 1000)
            day = dt.date(2000, 1, 1) + dt.timedelta(days=i)
            rows.append((ticker, "C", day, close + rng.gauss(0, 1), close, close, close, float(rng.randint(1, 99)), 0.0))
    rng.shuffle(rows)
    from assetweave import schemas

    return spark.createDataFrame(rows, schemas.BARS).repartition(5).cache()


def by_key(df):
    return {(r.ticker, r.dt): r for r in df.collect()}


def assert_same(a, b):
    a, b = by_key(a), by_key(b)
    assert a.keys() == b.keys()
    for key, row in a.items():
        for name, value in row.asDict().items():
            other = b[key][name]
            if isinstance(value, float) and other is not None:
                assert other == pytest.approx(value, rel=1e-9, abs=1e-9), (key, name)
            else:
                assert other == value, (key, name)


def test_position_is_the_rank_in_total_order(skewed):
    rows = sorted((r.ticker, r.dt, r._position) for r in with_position(skewed, ["ticker", "dt"]).collect())
    assert [p for _, _, p in rows] == list(range(len(rows)))


@pytest.mark.parametrize("block", [256, 1000, 65536])
def test_basic_features_in_blocks(skewed, block):
    plain = features.basic_features(skewed, complete=False)
    blocked = in_blocks(
        skewed, DAILY, features.BASIC_LOOKBACK, lambda d, s: features.basic_features(d, s, complete=False), block
    )
    assert blocked.columns == plain.columns
    assert_same(plain, blocked)


def test_ema_in_blocks(skewed):
    plain = with_ema(skewed, {"e": 20})
    blocked = in_blocks(skewed, DAILY, ema_lookback(20), lambda d, s: with_ema(d, {"e": 20}, "close", s), 450)
    assert_same(plain, blocked)


def test_blocks_hold_a_bounded_number_of_rows(skewed):
    sizes = []

    def compute(df, s):
        sizes.append(df.groupBy("_block").count().agg(F.max("count")).first()[0])
        return df

    out = in_blocks(skewed, DAILY, 50, compute, 500)
    assert out.count() == skewed.count()
    assert sizes[0] <= 550


def test_quote_returns_need_no_asset_bound(skewed):
    plain = with_returns(skewed)
    blocked = quote_returns(skewed, Series(("ticker",), ("dt",)), 300)
    assert_same(plain, blocked)


def test_lookback_must_fit_a_block(skewed):
    with pytest.raises(ValueError):
        in_blocks(skewed, DAILY, 200, lambda d, s: d, 100)


def test_tasks_grow_with_the_blocks(skewed):
    """A task gets a block's rows, however many rows there are."""
    counts = []

    def compute(df, s):
        counts.append(df.rdd.getNumPartitions())
        return df

    rows = skewed.count()
    for block_rows in (rows, 10):
        assert in_blocks(skewed, DAILY, 2, compute, block_rows).count() == rows
    assert counts[1] >= rows // 10 > counts[0]
