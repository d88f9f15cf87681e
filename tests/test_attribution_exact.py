"""Attribution against all rows: equal to the plain kernel, which compares every row with every row."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assetweave.operators import attribution, attribution_exact

NAMES = ["a", "b", "c", "d"]


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(0, 40), st.integers(0, 30), st.sampled_from([2, 5, 1000]), st.booleans(), st.booleans())
def test_dominated_counts(seed, n, m, values, tie_a, tie_b):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, values, (2, n)).astype(float)
    qa, qb = rng.integers(-1, values + 1, (2, m)).astype(float)
    w = rng.integers(1, 4, n)
    below_a = a[None] <= qa[:, None] if tie_a else a[None] < qa[:, None]
    below_b = b[None] <= qb[:, None] if tie_b else b[None] < qb[:, None]
    got = attribution_exact.dominated(a, b, w, qa, qb, (tie_a, tie_b))
    assert got.tolist() == ((below_a & below_b) * w[None]).sum(axis=1).tolist()


def table(rows):
    return pd.DataFrame(rows, columns=NAMES[: rows.shape[1]]).assign(id=range(len(rows)))


def plain(spark, frame, names, centers, target):
    everything = spark.createDataFrame(frame[names].assign(weight=1.0))
    return rows_of(attribution.attribution(spark.createDataFrame(frame), names, centers, everything, target, keep=("id",)))


def rows_of(df):
    return {r.id: (r.cluster, [r[c] for c in df.columns if c.startswith("phi_")]) for r in df.collect()}


def same(got, expected):
    assert got.keys() == expected.keys()
    for i, (cluster, phi) in expected.items():
        assert got[i][0] == cluster and got[i][1] == pytest.approx(phi, abs=1e-9)


@pytest.mark.parametrize("target", ["own", "id", 1])
@pytest.mark.parametrize("bucket_rows", [100_000, 20])
def test_equals_all_pairs(spark, target, bucket_rows):
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(300, 4))
    rows[:100] = rows[0]  # a third of all rows alike
    rows[50:200, 2] = 0.25  # half of them alike in one feature
    frame, centers = table(rows), rng.normal(size=(3, 4)).tolist()
    df = spark.createDataFrame(frame).repartition(5)
    got = attribution_exact.attribution_exact(df, NAMES, centers, None, target, ("id",), bucket_rows, task_queries=15)
    same(rows_of(got), plain(spark, frame, NAMES, centers, target))


@pytest.mark.parametrize("features,clusters", [(1, 3), (2, 2), (3, 3), (3, 2)])
def test_other_numbers_of_features_and_clusters(spark, features, clusters):
    rng = np.random.default_rng(features + clusters)
    frame, names = table(rng.normal(size=(80, features))), NAMES[:features]
    centers = rng.normal(size=(clusters, features)).tolist()
    got = attribution_exact.attribution_exact(spark.createDataFrame(frame), names, centers, keep=("id",), bucket_rows=30)
    same(rows_of(got), plain(spark, frame, names, centers, "own"))


def test_ties_go_to_the_lower_cluster(spark):
    """Points and rows on a grid lie exactly between centers."""
    grid = np.array([[x, y] for x in range(-2, 3) for y in range(-2, 3)], float)
    frame, centers = table(grid), [[1.0, 0.0], [-1.0, 0.0], [0.0, 1.0]]
    for bucket_rows in (1000, 4):
        got = attribution_exact.attribution_exact(spark.createDataFrame(frame), ["a", "b"], centers, keep=("id",), bucket_rows=bucket_rows)
        same(rows_of(got), plain(spark, frame, ["a", "b"], centers, "own"))


def test_background_of_its_own_and_gaps(spark):
    rng = np.random.default_rng(9)
    frame, other = table(rng.normal(size=(40, 3))), table(rng.normal(size=(70, 3)))
    centers, names = rng.normal(size=(3, 3)).tolist(), NAMES[:3]
    df = spark.createDataFrame(frame).withColumn("b", F.when(F.col("id") != 7, F.col("b")))
    background = spark.createDataFrame(other).withColumn("c", F.when(F.col("id") != 3, F.col("c")))
    got = rows_of(attribution_exact.attribution_exact(df, names, centers, background, keep=("id",), bucket_rows=9))
    weighted = spark.createDataFrame(other[other["id"] != 3][names].assign(weight=1.0))
    expected = rows_of(attribution.attribution(df, names, centers, weighted, keep=("id",)))
    assert len(got) == 39
    same(got, expected)
    with pytest.raises(ValueError, match="no rows"):
        attribution_exact.attribution_exact(df, names, centers, background.limit(0))
    with pytest.raises(ValueError, match="two or three"):
        attribution_exact.attribution_exact(df, names, centers + centers)


def test_largest_gap_to_the_cells(spark):
    rng = np.random.default_rng(2)
    frame, centers = table(rng.normal(size=(200, 2))), [[1.0, 0.0], [-1.0, 0.0], [0.0, 1.0]]
    df = spark.createDataFrame(frame)
    exact = attribution_exact.attribution_exact(df, ["a", "b"], centers, keep=("id",))
    cells = attribution.attribution(df, ["a", "b"], centers, attribution.cells(df, ["a", "b"]), keep=("id",))
    gap = attribution_exact.largest_gap(exact, cells, ["id"]).first()
    assert 0 < gap.phi_a < 1 and 0 < gap.phi_b < 1
    assert attribution_exact.largest_gap(exact, exact, ["id"]).first().phi_a == 0


@pytest.mark.parametrize("turn_records", [1, 200_000_000])
def test_centers_that_agree_in_a_feature(spark, turn_records):
    """A coordinate that is the same for all points is not the one that all of them are compared along."""
    rng = np.random.default_rng(6)
    frame, names = table(rng.normal(size=(200, 3))), NAMES[:3]
    centers = [[1.0, 0.0, 0.3], [-0.5, 0.0, -0.6], [0.0, 0.7, 0.0]]
    planes = attribution_exact.Planes(np.array(centers), 3, [0, 1, 2])
    planes.cut(frame[names].to_numpy(), 8)
    for plane in range(len(planes.all)):
        place, _ = planes.place(plane, planes.points(plane, frame[names].to_numpy()))
        assert np.bincount(place).max() < 60, planes.all[plane]
    df = spark.createDataFrame(frame)
    before = spark.conf.get(attribution_exact.CLEANUP, "false")
    got = attribution_exact.attribution_exact(
        df, names, centers, keep=("id",), bucket_rows=25, task_queries=15, turn_records=turn_records
    )
    same(rows_of(got), plain(spark, frame, names, centers, "own"))
    assert spark.conf.get(attribution_exact.CLEANUP, "false") == before


def test_points_known_by_their_bucket_collapse():
    along, other = np.array([0.5, 0.5, 0.25, 0.5]), np.array([3, 1, 2, 3], np.uint8)
    a, b, n = attribution_exact._collapsed(along, other, np.array([1, 2, 3, 4]))
    assert (a.tolist(), b.tolist(), n.tolist()) == ([0.25, 0.5, 0.5], [2, 1, 3], [3, 2, 5])


@pytest.mark.parametrize(
    "centers",
    [
        [[0, 0, 1, 1], [1, 0, -1, -1], [-1, 1, 1, 0]],
        [[2, 0, 1, 0], [-1, 0, 1, 3], [0, 0, 1, -2]],  # all agree in two features
        [[1, 0, 0, 1], [0, 1, 0, 1]],
    ],
)
@pytest.mark.parametrize("target", ["own", "id"])
def test_ties_on_lines_and_planes(spark, centers, target):
    """Whole numbers, so that rows lie exactly between centers for every set of features."""
    grid = np.array(np.meshgrid(*[range(-1, 2)] * 4)).reshape(4, -1).T.astype(float)
    frame = table(np.concatenate([grid, grid[::3]]))
    df = spark.createDataFrame(frame).repartition(3)
    got = attribution_exact.attribution_exact(df, NAMES, centers, None, target, ("id",), bucket_rows=20, task_queries=30)
    same(rows_of(got), plain(spark, frame, NAMES, centers, target))


def test_points_move_once_per_coordinate():
    """With four features only the sets of two need planes; their planes have three coordinates in common."""
    rng = np.random.default_rng(12)
    planes = attribution_exact.Planes(rng.normal(size=(3, 4)), 4, [0, 1, 2])
    assert len(planes.all) == 42 and len(planes.flat) == 18
    assert len(planes.axes) - len(planes.lines) == 18
    # of each feature, its values; and where the others let each cluster's interval of it end
    assert len(planes.lines) == 4 + 4 * 4


def test_blocks_count_as_all_points_do():
    rng = np.random.default_rng(5)
    n, m = 3000, 400
    rank, weight = rng.permutation(n), rng.integers(1, 90, n)
    high, below = rng.integers(0, n + 1, (2, m))
    symbol, limit = rng.integers(0, 256, n).astype(np.uint8), rng.integers(0, 256, m).astype(np.uint8)
    for w in (None, weight):
        size = np.ones(n, int) if w is None else w
        expected = [size[:h][rank[:h] < b].sum() for h, b in zip(high, below)]
        assert attribution_exact._counted(rank, w, high, below).tolist() == expected
        expected = [size[:h][symbol[:h] < b].sum() for h, b in zip(high, limit)]
        assert attribution_exact._counted(symbol, w, high, limit, 256).tolist() == expected
