"""K-Means without chance: against a plain version, Spark's own evaluator and model costs."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from assetweave.operators import lloyd


def plain_fit(x, k, rounds):
    cells = {}
    for row in x:
        cells.setdefault(tuple(np.floor(row)), []).append(row)
    cells = [(np.mean(c, axis=0), len(c)) for c in cells.values()]
    chosen = []
    while len(chosen) < k:
        def score(cell):
            gap = min(((cell[0] - c) ** 2).sum() for c in chosen) if chosen else 1.0
            return (cell[1] * gap, tuple(cell[0]))
        chosen.append(max(cells, key=score)[0])
    centers = np.array(chosen)
    for _ in range(rounds):
        near = ((x[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        centers = np.array([x[near == c].mean(axis=0) if (near == c).any() else centers[c] for c in range(k)])
    return centers


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(c, 0.6, (150, 3)) for c in ([0, 0, 0], [4, 1, 0], [-3, 3, 2], [1, -4, 3])])
    return x, spark.createDataFrame(pd.DataFrame(x, columns=["a", "b", "c"])).repartition(4).cache()


def test_all_numbers_of_clusters_at_once(points):
    x, df = points
    got = lloyd.fit(df, ["a", "b", "c"], range(1, 7), rounds=5)
    for k in range(1, 7):
        assert np.allclose(got[k], plain_fit(x, k, 5), atol=1e-9), k
    costs = {r.k: r.cost for r in lloyd.costs(df, ["a", "b", "c"], got).collect()}
    for k, cost in costs.items():
        assert cost == pytest.approx(((x[:, None] - np.array(got[k])[None]) ** 2).sum(axis=2).min(axis=1).sum())
    assert all(costs[k] >= costs[k + 1] for k in range(1, 6))
    sizes = lloyd.sizes(df, ["a", "b", "c"], got[4]).collect()
    assert sorted(r.n for r in sizes) == [150] * 4


def test_result_does_not_depend_on_the_partitioning(points):
    _, df = points
    one, many = (lloyd.fit(df.repartition(n), ["a", "b"], [3]) for n in (1, 7))
    assert np.allclose(one[3], many[3], atol=1e-9)


def test_silhouette_is_that_of_the_evaluator(points):
    _, df = points
    names = ["a", "b", "c"]
    centers = lloyd.fit(df, names, [4])
    rows = lloyd.assigned(df, names, centers).withColumn("prediction", F.col("_cluster_4"))
    mine = lloyd.silhouette_of(rows, names, "prediction")
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    assert mine.agg(F.avg("silhouette")).first()[0] == pytest.approx(ClusteringEvaluator().evaluate(vectors), abs=1e-9)


def test_edge_cases(spark):
    rows = spark.createDataFrame([(0.0, 0), (0.0, 0), (0.0, 0), (5.0, 1)], "a double, g int")
    found = {r.g: r.silhouette for r in lloyd.silhouette_of(rows, ["a"], "g").collect()}
    assert found == {0: 1.0, 1: 0.0}  # a cluster of one row counts 0
    assert lloyd.silhouette_of(rows.where("g = 0"), ["a"], "g").first().silhouette is None
    assert lloyd.fit(rows, ["a"], [2, 9])[9] == [[0.0], [5.0]]  # no more centers than cells
    assert lloyd.fit(rows.limit(0), ["a"], [2]) == {}


def test_equally_near_centers(spark):
    rows = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "a double")
    near = lloyd.assigned(rows, ["a"], {2: [[0.0], [2.0]]}).collect()
    assert [r["_cluster_2"] for r in near] == [0, 0, 1]


def test_a_saved_model_scores_with_its_own_scale(spark, tmp_path, points):
    _, df = points
    df = df.withColumn("id", F.monotonically_increasing_id())
    gaps = df.withColumn("a", F.when(F.col("id") % 7 != 0, F.col("a")))
    model = lloyd.train(gaps, ["a", "b", "c"], 3)
    path = str(tmp_path / "model")
    lloyd.save(model, path)
    again = lloyd.load(spark, path)
    assert again == model
    before = {r.id: r.prediction for r in lloyd.score(gaps, model).collect()}
    assert len(before) == df.count() and set(before.values()) == {0, 1, 2}
    part = lloyd.score(gaps.where("id < 20"), again)  # its own mean and deviation would differ
    assert {r.id: r.prediction for r in part.collect()} == {i: c for i, c in before.items() if i < 20}
    assert part.columns == [*gaps.columns, "prediction"]
    with pytest.raises(ValueError, match="no rows"):
        lloyd.train(gaps.limit(0), ["a"], 2)


def test_rounds_and_costs_take_no_expression_per_center(spark, monkeypatch):
    """Rows are assigned in batches for all k, not copied per k; the sums are those of the expressions."""
    rows = spark.createDataFrame([(float(i % 5), float(i % 3)) for i in range(60)], "a double, b double").repartition(3)
    centers = {2: [[0.0, 0.0], [2.0, 0.0]], 3: [[0.0, 1.0], [4.0, 1.0], [9.0, 9.0]]}
    near = lloyd.assigned(rows, ["a", "b"], centers).toPandas()
    moved = {
        k: [near[near[f"_cluster_{k}"] == c][["a", "b"]].mean().tolist() if (near[f"_cluster_{k}"] == c).any() else center for c, center in enumerate(some)]
        for k, some in centers.items()
    }
    expressions = lambda *_: pytest.fail("an expression per center")
    monkeypatch.setattr(lloyd, "assigned", expressions)
    got = lloyd.round_of(rows, ["a", "b"], centers)
    assert all(np.allclose(got[k], moved[k]) for k in centers) and got[3][2] == [9.0, 9.0]
    costs = {r.k: r.cost for r in lloyd.costs(rows, ["a", "b"], centers).collect()}
    assert costs == pytest.approx({k: near[f"_gap_{k}"].sum() for k in centers})


def test_a_round_in_columns_is_the_round_in_arrays(spark):
    data = [(float(i % 7), float(i % 3) / 2) for i in range(50)] + [(None, 1.0), (0.5, None)]
    rows = spark.createDataFrame(data, "a double, b double")
    centers = {2: [[0.0, 0.0], [5.0, 1.0]], 3: [[0.0, 0.0], [5.0, 1.0], [90.0, 90.0]]}
    got, want = (f(rows, ["a", "b"], centers) for f in (lloyd.column_round, lloyd.round_of))
    assert got[3][2] == [90.0, 90.0]
    for k in centers:
        assert [pytest.approx(c) for c in got[k]] == want[k]
