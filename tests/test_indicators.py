import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from assetweave.functions import indicators as ind
from assetweave.functions.cleaning import ratio
from assetweave.operators import rolling
from assetweave.operators.ema import with_ema
from assetweave.plans import features


def column(df, name):
    return [r[name] for r in df.orderBy("ticker", "dt").select(name).collect()]


def with_change(df):
    return df.withColumn("change", ind.difference("close", 1))


def test_rsi_only_gains_is_100_from_row_14(make_bars):
    values = column(rolling.with_rsi(with_change(make_bars({"A": [float(i) for i in range(1, 16)]}))), "rsi_14")
    assert values[:13] == [None] * 13
    assert values[13:] == [100.0, 100.0]


def test_rsi_of_flat_prices_is_null(make_bars):
    values = column(rolling.with_rsi(with_change(make_bars({"A": [5.0] * 15}))), "rsi_14")
    assert values == [None] * 15


def test_rsi_equals_plain_formula(make_bars):
    rng = random.Random(1)
    closes = [100 + rng.gauss(0, 5) for _ in range(40)]
    values = column(rolling.with_rsi(with_change(make_bars({"A": closes}))), "rsi_14")
    changes = [0.0] + [b - a for a, b in zip(closes, closes[1:])]
    for i in range(13, 40):
        window = changes[i - 13 : i + 1]
        up = sum(max(c, 0) for c in window) / 14
        down = sum(max(-c, 0) for c in window) / 14
        assert values[i] == pytest.approx(100 - 100 / (1 + up / down), rel=1e-12)


def test_sma_warm_up_and_partial(make_bars):
    bars = make_bars({"A": [float(i) for i in range(1, 13)]})
    full = column(rolling.with_means(bars, {"m": ("close", 10)}), "m")
    assert full[:9] == [None] * 9 and full[9:] == [5.5, 6.5, 7.5]
    partial = column(rolling.with_means(bars, {"m": ("close", 10)}, min_periods=1), "m")
    assert partial[:3] == [1.0, 1.5, 2.0]


@pytest.mark.parametrize("n", [7, 10, 16, 30, 50, 100, 200])
def test_composed_means_equal_direct_frames(make_bars, n):
    rng = random.Random(n)
    bars = make_bars({t: [rng.uniform(1, 1e4) for _ in range(230)] for t in "AB"})
    composed = column(rolling.with_means(bars, {"m": ("close", n)}), "m")
    direct = column(rolling.with_means(bars, {"m": ("close", n)}, min_periods=n), "m")
    assert [v is None for v in composed] == [v is None for v in direct]
    assert all(a == pytest.approx(b, rel=1e-13) for a, b in zip(composed, direct) if a is not None)


def test_null_in_window_gives_null_mean(make_bars):
    bars = make_bars({"A": [1.0, None, *[2.0] * 12]})
    values = column(rolling.with_means(bars, {"m": ("close", 10)}), "m")
    assert values[:11] == [None] * 11 and values[11] == 2.0


def test_mean_of_a_constant_is_the_constant(make_bars):
    values = column(rolling.with_means(make_bars({"A": [7.0] * 60}), {"m": ("close", 50)}), "m")
    assert set(values[49:]) == {7.0}


def test_historical_volatility_starts_at_row_21(make_bars):
    rng = random.Random(3)
    closes = [100 * math.exp(rng.gauss(0, 0.1)) for _ in range(25)]
    bars = make_bars({"A": closes}).withColumn("log_return", ind.log_return())
    values = column(rolling.with_deviations(bars, {"v": ("log_return", 20)}), "v")
    assert values[:20] == [None] * 20
    logs = [math.log(b / a) for a, b in zip(closes, closes[1:])]
    assert values[20] == pytest.approx(statistics.stdev(logs[:20]))


def test_ratios_with_zero_or_missing_denominator(make_bars):
    bars = make_bars({"A": [3.0, 4.0]}, volumes={"A": [0.0, 2.0]})
    assert column(bars.withColumn("r", ratio("close", "volume")), "r") == [None, 2.0]
    eps = bars.withColumn("eps", F.when(F.col("close") == 3, 0.0))
    assert column(eps.withColumn("pe", ratio("close", "eps")), "pe") == [None, None]


def plain_ema(values, span):
    a = 2 / (span + 1)
    out = [values[0]]
    for x in values[1:]:
        out.append(a * x + (1 - a) * out[-1])
    return out


@pytest.mark.parametrize("span", [1, 2, 20, 50])
def test_ema_equals_recurrence(make_bars, span):
    rng = random.Random(span)
    series = {t: [rng.uniform(1, 1e5) for _ in range(n)] for t, n in {"A": 1400, "B": 3, "C": 257}.items()}
    got = column(with_ema(make_bars(series), {"e": span}), "e")
    want = [y for t in sorted(series) for y in plain_ema(series[t], span)]
    assert all(abs(g - w) <= 1e-12 * abs(w) for g, w in zip(got, want))


def test_ema_starts_at_the_first_known_value_and_keeps_over_gaps(make_bars):
    rng = random.Random(1)
    values = [None if i < 3 or rng.random() < 0.3 else rng.uniform(1, 100) for i in range(900)]
    bars = make_bars({"A": [v or -1.0 for v in values]})
    got = column(with_ema(bars.withColumn("close", F.when(F.col("close") > 0, F.col("close"))), {"e": 20}), "e")
    known = iter(plain_ema([v for v in values if v is not None], 20))
    want = []
    for v in values:
        want.append(next(known) if v is not None else (want[-1] if want else None))
    start = next(i for i, v in enumerate(values) if v is not None)
    assert got[:start] == want[:start] == [None] * start and start >= 3
    assert got[start:] == pytest.approx(want[start:], rel=1e-12)


def test_ema_forgets_a_very_large_early_price(make_bars):
    values = [1e12, *[float(i % 7 + 1) for i in range(1500)]]
    got = column(with_ema(make_bars({"A": values}), {"e": 20}), "e")
    assert got[-1] == pytest.approx(plain_ema(values, 20)[-1], rel=1e-9)


def test_feature_sets_have_no_gaps_and_start_late(make_bars):
    rng = random.Random(5)
    closes = {t: [100 + rng.gauss(0, 5) for _ in range(205)] for t in "AB"}
    opens = {t: [c + rng.gauss(0, 1) for c in v] for t, v in closes.items()}
    bars = make_bars(closes, opens=opens)
    basic = features.basic_features(bars)
    assert basic.count() == 2 * 6
    assert basic.columns == [*bars.columns, *features.BASIC]
    advanced = features.advanced_features(bars)
    assert advanced.count() == 2 * 106
    assert features.basic_features(bars, min_periods=1).count() == 2 * 204


def test_ensure_features_keeps_what_is_there(make_bars):
    bars = make_bars({"A": [1.0, 2.0, 3.0]}).withColumn("rsi_14", F.lit(1.0))
    df = features.ensure_features(bars, ["rsi_14", "volatility_10"])
    assert df.columns == [*bars.columns, "volatility_10"]
    with pytest.raises(ValueError):
        features.ensure_features(bars.drop("volume"), ["avg_volume_50"])
    with pytest.raises(ValueError, match="beta"):
        features.ensure_features(bars, ["beta", "rsi_14"])


def test_ensure_features_derives_both_sets(make_bars):
    rng = random.Random(9)
    bars = make_bars({"A": [100 + rng.gauss(0, 5) for _ in range(230)]})
    wanted = [*dict.fromkeys([*features.BASIC, *features.ADVANCED])]
    got = features.ensure_features(bars, wanted)
    assert got.columns == [*bars.columns, *wanted]
    for make, names in ((features.basic_features, features.BASIC), (features.advanced_features, features.ADVANCED)):
        want = make(bars).select("dt", *names)
        both = want.join(got.select("dt", *[F.col(n).alias(f"_{n}") for n in names]), "dt")
        differ = [F.abs(F.col(n) - F.col(f"_{n}")) > 1e-9 for n in names]
        assert both.count() == want.count() > 0
        assert both.where(F.array_contains(F.array(*differ), True)).count() == 0


def test_ema_sorts_once_for_its_steps(make_bars):
    """Two sorts in all: by time for the numbers of the rows, by step for the averages."""
    plan = with_ema(make_bars({"A": [1.0, 2.0, 3.0]}), {"e": 20, "f": 50})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 2 and plan.count("Exchange hashpartitioning") == 1


def test_ema_with_steps_of_missing_values(make_bars):
    """Missing values at the start, at the ends of steps and for longer than a step."""
    rng = random.Random(2)
    values = [None] * 3 + [rng.uniform(1, 9) for _ in range(256)] + [None] * 300 + [rng.uniform(1, 9) for _ in range(700)] + [None]
    bars = make_bars({"A": [v or -1.0 for v in values]})
    got = with_ema(bars.withColumn("close", F.when(F.col("close") > 0, F.col("close"))), {"e": 50, "last": 1})
    known = [v for v in values if v is not None]
    for name, span in (("e", 50), ("last", 1)):
        want, averages, last = [], iter(plain_ema(known, span)), None
        for v in values:
            last = last if v is None else next(averages)
            want.append(last)
        found = column(got, name)
        assert found[:3] == [None] * 3 and found[3:] == pytest.approx(want[3:], rel=1e-12)
