import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from assetweave.operators import profile


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert {r["column"]: r.nulls for r in profile.null_profile(df).collect()} == {"a": 1, "b": 2}


@pytest.mark.parametrize("accuracy", [profile.ACCURACY, 50])
def test_describe_matches_exact_statistics(spark, monkeypatch, accuracy):
    """With the low accuracy the brackets are narrower than the table, as they are on large tables."""
    monkeypatch.setattr(profile, "ACCURACY", accuracy)
    rng = random.Random(2)
    # a third of all values equal, heavy tail, NULLs, and a column of its own size
    data = [
        (rng.choice([0.0, rng.gauss(0, 1), rng.paretovariate(1)]), float(rng.randint(0, 5)) if rng.random() < 0.8 else None)
        for _ in range(3001)
    ]
    df = spark.createDataFrame(data, "a double, b double").repartition(4)
    pdf = pd.DataFrame(data, columns=["a", "b"]).describe()
    for row in profile.describe(df, ["a", "b"]).collect():
        want = pdf[row["column"]]
        assert row["count"] == want["count"]
        assert row["min"] == want["min"] and row["max"] == want["max"]
        assert row["mean"] == pytest.approx(want["mean"]) and row["std"] == pytest.approx(want["std"])
        for mine, theirs in (("p25", "25%"), ("p50", "50%"), ("p75", "75%")):
            assert row[mine] == pytest.approx(want[theirs], rel=1e-12, abs=1e-12)


def test_describe_of_an_empty_column(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    got = {r["column"]: r for r in profile.describe(df, ["a", "b"]).collect()}
    assert got["a"]["p50"] == 1.0 and got["b"]["count"] == 0 and got["b"]["p50"] is None


def test_correlation_matrix(spark):
    rng = np.random.default_rng(4)
    values = rng.normal(size=(500, 3))
    values[:, 2] += values[:, 0]
    df = spark.createDataFrame(pd.DataFrame(values, columns=list("abc")))
    want = np.corrcoef(values.T)
    for r in profile.correlation(df, list("abc")).collect():
        assert r.corr == pytest.approx(want["abc".index(r.feature_a), "abc".index(r.feature_b)])


def test_distinct_values(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("k"))
    assert {r.k for r in profile.distinct_values(df, "k").collect()} == {0, 1, 2}
