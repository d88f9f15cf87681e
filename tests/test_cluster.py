import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from assetweave.operators import attribution, cluster

FEATURES = ["a", "b", "volatility_10"]


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(11)
    rows = []
    for level, volatility in enumerate([5.0, 0.1, 1.0]):
        for _ in range(60):
            rows.append((*(rng.normal(4 * level, 0.2, 2)), abs(rng.normal(volatility, 0.02)), level))
    frame = pd.DataFrame(rows, columns=[*FEATURES, "truth"])
    frame["id"] = range(len(frame))
    frame.loc[::20, "a"] = None
    return spark.createDataFrame(frame).repartition(3).cache()


def test_clusters_labels_and_quality(points):
    clustered = cluster.cluster(points, FEATURES)
    assert clustered.count() == points.count()
    assert -1 <= cluster.silhouette(clustered) <= 1
    labelled = cluster.risk_label(clustered)
    assert labelled.count() == points.count()
    means = {r.risk_category: r.m for r in labelled.groupBy("risk_category").agg(F.avg("volatility_10").alias("m")).collect()}
    assert means["Low Risk"] < means["Medium Risk"] < means["High Risk"]
    assert cluster.clustered_view(labelled, FEATURES).columns == [*FEATURES, "cluster", "risk_category"]


def test_same_seed_same_clusters(points):
    def run():
        return {r.id: r.prediction for r in cluster.cluster(points, FEATURES).collect()}

    assert run() == run()


def test_elbow_falls(points):
    costs = cluster.elbow(points, ["b", "volatility_10"], range(2, 5)).orderBy("k").collect()
    assert [r.k for r in costs] == [2, 3, 4]
    assert costs[0].cost > costs[1].cost


def test_saved_model_scores_new_rows_with_its_own_scaler(points, tmp_path):
    names = ["b", "volatility_10"]
    model = cluster.train(points, names)
    cluster.save(model, str(tmp_path / "m"))
    before = {r.id: r.prediction for r in model.transform(points).collect()}
    part = points.where("id < 10")  # its own mean and deviation would differ
    after = {r.id: r.prediction for r in cluster.score(part, str(tmp_path / "m")).collect()}
    assert after == {i: before[i] for i in after} and len(after) == 10


def test_scaled_features_have_mean_zero(points):
    from pyspark.ml.functions import vector_to_array

    scaled = cluster.scale(points, ["b"]).select(vector_to_array("features")[0].alias("z"))
    row = scaled.agg(F.avg("z").alias("m"), F.stddev_samp("z").alias("s")).first()
    assert row.m == pytest.approx(0, abs=1e-9) and row.s == pytest.approx(1)


def test_nearest_takes_the_lowest_index_on_ties(spark):
    df = spark.createDataFrame([(0.0,), (0.9,), (1.5,)], "x double")
    assert [r.c for r in df.select(cluster.nearest(["x"], [[-1.0], [1.0], [2.0]]).alias("c")).collect()] == [0, 1, 1]


def brute_force(x, background, weights, centers, outcome):
    def predict(p):
        return int(np.argmin(((centers - p) ** 2).sum(axis=1)))

    own = predict(x)

    def value(members):
        total = 0.0
        for b, w in zip(background, weights):
            mixed = np.array([x[i] if i in members else b[i] for i in range(len(x))])
            if outcome == "id":
                total += w * predict(mixed)
            else:
                total += w * (predict(mixed) == (own if outcome == "own" else outcome))
        return total / sum(weights)

    phi, m = [], len(x)
    for i in range(m):
        others = [j for j in range(m) if j != i]
        total = 0.0
        for size in range(m):
            for s in itertools.combinations(others, size):
                share = math.factorial(size) * math.factorial(m - size - 1) / math.factorial(m)
                total += share * (value({*s, i}) - value(set(s)))
        phi.append(total)
    return own, phi, value(set(range(m))) - value(set())


@pytest.mark.parametrize("target", ["id", "own", 1])
def test_attribution_is_exact_shapley(spark, target):
    rng = np.random.default_rng(6)
    names = ["a", "b", "c", "d"]
    rows = rng.normal(size=(40, 4))
    background, weights = rng.normal(size=(7, 4)), rng.integers(1, 5, 7).astype(float)
    centers = rng.normal(size=(3, 4))
    df = spark.createDataFrame(pd.DataFrame(rows, columns=names).assign(id=range(40))).repartition(3)
    summary = spark.createDataFrame(pd.DataFrame(background, columns=names).assign(weight=weights))
    got = attribution.attribution(df, names, centers.tolist(), summary, target, keep=("id",)).collect()
    assert len(got) == 40
    for r in got:
        own, phi, gap = brute_force(rows[r.id], background, weights, centers, target)
        mine = [r[f"phi_{c}"] for c in names]
        assert r.cluster == own
        assert mine == pytest.approx(phi, abs=1e-12)
        assert sum(mine) == pytest.approx(gap, abs=1e-12)  # efficiency
    means = attribution.attribution_by_cluster(spark.createDataFrame(got))
    assert means.count() == len({r.cluster for r in got})


def test_every_row_is_scored_and_missing_values_are_the_training_means(spark, points, tmp_path):
    model = cluster.train(points, FEATURES)
    cluster.save(model, str(tmp_path / "gaps"))
    means = points.agg(*[F.avg(c).alias(c) for c in FEATURES]).first()
    odd = spark.createDataFrame(
        [(1, None, 4.0, 1.0), (2, float("nan"), 4.0, 1.0), (3, means.a, 4.0, 1.0)], "id int, a double, b double, volatility_10 double"
    )
    got = cluster.score(odd, str(tmp_path / "gaps"))
    assert {r.prediction for r in got.collect()} == {r.prediction for r in got.where("id = 3").collect()}
    assert got.count() == 3 and cluster.scale(points, FEATURES).count() == points.count()
    assert got.columns == [*odd.columns, "features", "prediction"]


def test_more_clusters_than_labels_are_an_error(points):
    clustered = cluster.cluster(points, FEATURES, k=5)
    with pytest.raises(Exception, match="more clusters than the 3 labels"):
        cluster.risk_label(clustered).collect()
    five = cluster.risk_label(clustered, labels=["1", "2", "3", "4", "5"])
    assert five.select("risk_category").distinct().count() == 5


def test_cells_cover_all_rows(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame(pd.DataFrame(rng.normal(size=(500, 2)), columns=["a", "b"])).repartition(3)
    cells = attribution.cells(df, ["a", "b"]).collect()
    assert sum(r.weight for r in cells) == 500 and len(cells) <= 16
    mean = df.agg(F.avg("a")).first()[0]
    assert sum(r.a * r.weight for r in cells) / 500 == pytest.approx(mean)
    with pytest.raises(ValueError, match="cells"):
        attribution.cells(df, ["a"] * 9)


def test_background_must_be_a_summary(spark, monkeypatch):
    monkeypatch.setattr(attribution, "MAX_BACKGROUND", 2)
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (3.0, 1.0)], "a double, weight double")
    with pytest.raises(ValueError, match="summarise"):
        attribution.attribution(df, ["a"], [[0.0], [1.0]], df)


@pytest.mark.parametrize("target", ["id", "own", 0, 2])
@pytest.mark.parametrize("clusters", [2, 3])
def test_tables_equal_pairs_and_hold_no_pair(monkeypatch, target, clusters):
    """Values by bisection are those of comparing all rows, ties on a grid included."""
    if target == 2 and clusters == 2:
        return
    rng = np.random.default_rng(9)
    rows, background = rng.integers(-2, 3, (60, 3)).astype(float), rng.integers(-2, 3, (25, 3)).astype(float)
    weights = rng.integers(1, 4, 25) / 50
    centers = np.array([[1.0, 0, 0], [-1, 0, 0], [0, 1, 0]])[:clusters]
    assert attribution.Leads.fits(background, centers, target)
    expected = attribution.shapley(rows, centers, attribution.Pairs(background, weights, centers, target))
    monkeypatch.setattr(attribution, "_nearest", lambda *_: pytest.fail("rows met the background"))
    got = attribution.shapley(rows, centers, attribution.Leads(background, weights, centers, target))
    assert (got[0] == expected[0]).all() and np.allclose(got[1], expected[1], atol=1e-12)
    assert not attribution.Leads.fits(np.zeros((4000, 3)), np.zeros((3, 3)), target)  # tables too large
    assert not attribution.Leads.fits(background, np.zeros((4, 3)), "own")  # four centers


def test_training_meets_all_rows_as_plain_numbers(points, monkeypatch):
    """Spark's K-Means, which caches a vector per row, is only fitted to the centers; those are the means of their rows."""
    fitted, fit = [], cluster.KMeans.fit

    def counted(self, dataset, params=None):
        fitted.append(dataset.count())
        return fit(self, dataset, params)

    monkeypatch.setattr(cluster.KMeans, "fit", counted)
    model = cluster.train(points, FEATURES)
    assert fitted == [3]
    _, _, centers = cluster.scaler_and_centers(model)
    rows = cluster.predict(model, points).select("prediction", "features", "id").toPandas()
    assert len(rows) == 180
    for number, center in enumerate(centers):
        own = np.array([v.toArray() for v in rows.features[rows.prediction == number]])
        assert len(own) > 50 and np.allclose(own.mean(axis=0), center)
    other = cluster.scaler_and_centers(cluster.train(points.repartition(7), FEATURES))[2]
    assert np.allclose(sorted(centers), sorted(other))
