"""K-Means whose result follows from the rows alone, for all numbers of clusters at once.

Seeds come from a summary of all rows in cells of one standard deviation (count and
mean, map-side sums): the densest cell, then again and again the cell with the
largest count times squared distance to the seeds so far. The seeds of k clusters
are the first k, so one list serves every k. Lloyd's rounds follow, each one
aggregate over the rows: numpy assigns a batch's rows for every k and adds them up
per cluster, and the sums of all clusters of all k come back together, a few dozen
rows. A row is neither copied per k nor carried through an expression per center.
The lowest number wins among equally near centers; a cluster that loses its rows keeps
its center. Nothing is random, so any engine that runs the same rounds gets the
same clusters.

``silhouette_of`` is the squared Euclidean silhouette from each cluster's count, sum
and squared length: one pass over rows, no pairs.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assetweave.session import stored

#: rounds after the seeds
ROUNDS = 8
#: width of a cell, in standard deviations
CELL = 1.0

Centers = dict[int, list[list[float]]]


def squared(columns: Sequence[str], center: Sequence[float]) -> Column:
    total = F.lit(0.0)
    for name, value in zip(columns, center):
        total = total + (F.col(name) - value) * (F.col(name) - value)
    return total


def cell_summary(rows: DataFrame, columns: Sequence[str], width: float = CELL) -> DataFrame:
    """Count and mean of every cell."""
    cell = [F.floor(F.col(c) / width).alias(f"_cell_{c}") for c in columns]
    means = [F.avg(c).alias(c) for c in columns]
    return rows.groupBy(*cell).agg(*means, F.count(F.lit(1)).alias("n")).select(*columns, "n")


def seeds(cells: DataFrame, columns: Sequence[str], k: int) -> list[list[float]]:
    """Up to ``k`` cell means; fewer if there are fewer cells."""
    chosen: list[list[float]] = []
    while len(chosen) < k:
        gaps = [squared(columns, c) for c in chosen]
        far = F.lit(1.0) if not gaps else F.least(*gaps) if len(gaps) > 1 else gaps[0]
        # among equal scores the largest mean, feature by feature
        best = cells.agg(F.max(F.struct((F.col("n") * far).alias("score"), *columns)).alias("best")).first()["best"]
        if best is None or (chosen and best["score"] <= 0):
            break
        chosen.append([best[c] for c in columns])
    return chosen


def assigned(rows: DataFrame, columns: Sequence[str], centers: Centers) -> DataFrame:
    """Add ``_cluster_<k>`` and ``_gap_<k>``, the squared distance, for every k."""
    gaps = {f"_gaps_{k}": F.array(*[squared(columns, c) for c in some]) for k, some in centers.items()}
    rows = rows.withColumns(gaps)
    near = {f"_gap_{k}": F.array_min(f"_gaps_{k}") for k in centers}
    rows = rows.withColumns(near)
    cluster = {f"_cluster_{k}": (F.array_position(f"_gaps_{k}", F.col(f"_gap_{k}")) - 1).cast("int") for k in centers}
    return rows.withColumns(cluster).drop(*gaps)


def _gaps(batch: pa.RecordBatch, centers: list[list[float]]) -> np.ndarray:
    """Squared distances, centers x rows, added up feature by feature as ``squared`` does."""
    x = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
    gaps = np.zeros((len(centers), batch.num_rows))
    for gap, center in zip(gaps, centers):
        for values, value in zip(x, center):
            gap += (values - value) * (values - value)
    return gaps


def _sums(centers: Centers):
    """(k, c, n, s0, s1, ...): a batch's rows nearest to each center, counted and added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            for k, some in centers.items():
                gaps = _gaps(batch, some)
                near = (gaps == np.fmin.reduce(gaps)).argmax(axis=0)  # the lowest number among equals
                sums = [np.bincount(near, values, len(some)) for values in x]
                n = np.bincount(near, minlength=len(some))
                hit = np.flatnonzero(n)
                columns = [pa.array(np.full(len(hit), k, np.int32)), pa.array(hit.astype(np.int32)), pa.array(n[hit])]
                names = ["k", "c", "n", *(f"s{i}" for i in range(len(x)))]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(v[hit]) for v in sums)], names)

    return run


def _least(centers: Centers):
    """One row per batch: for every k the sum of the rows' distances to their nearest centers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                least = [pa.array([np.fmin.reduce(_gaps(batch, some)).sum()]) for some in centers.values()]
                yield pa.RecordBatch.from_arrays(least, [str(k) for k in centers])

    return run


def _complete(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles. A row with a NULL is near no center."""
    # ship this module's functions with the task, so that workers need only numpy and pyarrow
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    rows = rows.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return rows.where(" and ".join(f"`{c}` is not null" for c in columns))


def round_of(rows: DataFrame, columns: Sequence[str], centers: Centers) -> Centers:
    """The means of the rows nearest to each center, for every k, from one aggregate."""
    names = [f"s{i}" for i in range(len(columns))]
    schema = ", ".join(["k int, c int, n long", *(f"{s} double" for s in names)])
    near = _complete(rows, columns).mapInArrow(_sums(centers), schema)
    found = near.groupBy("k", "c").agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in names])
    moved = {k: [list(c) for c in some] for k, some in centers.items()}
    for r in found.collect():  # a row per k and cluster
        moved[r["k"]][r["c"]] = [r[s] / r["n"] for s in names]
    return moved


def column_round(rows: DataFrame, columns: Sequence[str], centers: Centers) -> Centers:
    """``round_of`` in column expressions, faster where there is one number of clusters."""
    moved = {}
    for k, some in centers.items():
        near = assigned(rows.na.drop(subset=list(columns)), columns, {k: some})
        sums = [F.sum(c).alias(f"s{i}") for i, c in enumerate(columns)]
        moved[k] = [list(c) for c in some]
        for r in near.groupBy(F.col(f"_cluster_{k}").alias("c")).agg(F.count(F.lit(1)).alias("n"), *sums).collect():
            moved[k][r["c"]] = [r[f"s{i}"] / r["n"] for i in range(len(columns))]
    return moved


def _still(before: Centers, after: Centers, tolerance: float) -> bool:
    """Whether no center moved further than ``tolerance``."""
    return all(math.dist(a, b) <= tolerance for k in before for a, b in zip(before[k], after[k]))


def fit(
    rows: DataFrame,
    columns: Sequence[str],
    ks: Sequence[int],
    rounds: int = ROUNDS,
    tolerance: float = 0.0,
    round_of: Callable[[DataFrame, Sequence[str], Centers], Centers] = round_of,
) -> Centers:
    """Centers for every number of clusters. ``rows`` are read once per round and should be stored."""
    first = seeds(cell_summary(rows, columns).persist(), columns, max(ks))
    if not first:
        return {}
    centers = {k: first[:k] for k in ks}
    for _ in range(rounds):
        before, centers = centers, round_of(rows, columns, centers)
        if _still(before, centers, tolerance):
            break
    return centers


def costs(rows: DataFrame, columns: Sequence[str], centers: Centers) -> DataFrame:
    """(k, cost): sum of squared distances to the nearest center."""
    near = _complete(rows, columns).mapInArrow(_least(centers), ", ".join(f"`{k}` double" for k in centers))
    one = near.agg(*[F.sum(f"`{k}`").alias(str(k)) for k in centers])
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"`{k}`").alias("cost")) for k in centers])
    return one.select(F.inline(pairs))


def sizes(rows: DataFrame, columns: Sequence[str], centers: list[list[float]]) -> DataFrame:
    """(cluster, n, center_<column>): rows nearest to each center, and the center."""
    k = len(centers)
    counted = assigned(rows, columns, {k: centers}).groupBy(F.col(f"_cluster_{k}").alias("cluster")).agg(F.count("*").alias("n"))
    place = F.array(*[F.array(*map(F.lit, c)) for c in centers])[F.col("cluster")]
    return counted.select("cluster", "n", *[place[i].alias(f"center_{c}") for i, c in enumerate(columns)])


def silhouette_of(rows: DataFrame, columns: Sequence[str], cluster: str) -> DataFrame:
    """Add ``silhouette``; 0 in a cluster of one row, NULL if there is only one cluster."""
    length = sum((F.col(c) * F.col(c) for c in columns[1:]), F.col(columns[0]) * F.col(columns[0]))
    sums = [F.sum(c).alias(f"_s{i}") for i, c in enumerate(columns)]
    known = rows.groupBy(cluster).agg(F.count(F.lit(1)).alias("_n"), F.sum(length).alias("_q"), *sums).collect()
    own, other = F.lit(None).cast("double"), []
    single = F.lit(False)
    for r in sorted(known, key=lambda r: r[cluster]):
        n = r["_n"]
        dot = sum((F.col(c) * r[f"_s{i}"] for i, c in enumerate(columns[1:], 1)), F.col(columns[0]) * r["_s0"])
        mean = length + r["_q"] / n - 2 * dot / n
        here = F.col(cluster) == r[cluster]
        own = F.when(here, mean * (n / (n - 1) if n > 1 else 1.0)).otherwise(own)
        other.append(F.when(~here, mean))
        single = single | (here & F.lit(n == 1))
    if len(known) < 2:
        return rows.withColumn("silhouette", F.lit(None).cast("double"))
    least = F.least(*other)
    value = F.try_divide(least - own, F.greatest(least, own))
    return rows.withColumn("silhouette", F.when(single, 0.0).otherwise(F.coalesce(value, F.lit(0.0))))


@dataclass(frozen=True)
class Model:
    """Everything that scoring needs: the training rows' means and deviations, and the centers in their scale."""

    features: list[str]
    means: list[float]
    deviations: list[float]
    centers: list[list[float]]

    def scaled(self, df: DataFrame) -> tuple[DataFrame, list[str]]:
        """``df`` with standardised columns, a missing value being the training mean; and the columns' names."""
        names = [f"_z_{c}" for c in self.features]
        z = {}
        for name, c, mean, deviation in zip(names, self.features, self.means, self.deviations):
            known = F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(mean)), F.lit(mean))
            z[name] = (known - mean) / (deviation or 1.0)
        return df.withColumns(z), names


def train(df: DataFrame, features: list[str], k: int, rounds: int = ROUNDS) -> Model:
    """Means, deviations and ``k`` centers of all rows; a missing value counts as the feature's mean."""
    totals = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(f"m{i}") for i, c in enumerate(features)],
        *[F.var_samp(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(f"v{i}") for i, c in enumerate(features)],
        *[F.count(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(f"n{i}") for i, c in enumerate(features)],
    ).first()
    if not totals["n"]:
        raise ValueError("no rows to train on")
    means = [totals[f"m{i}"] or 0.0 for i in range(len(features))]
    # rows at the mean add nothing to the sum of squares, but count
    deviations = [
        math.sqrt((totals[f"v{i}"] or 0.0) * max(totals[f"n{i}"] - 1, 0) / max(totals["n"] - 1, 1)) for i in range(len(features))
    ]
    empty = Model(features, means, deviations, [])
    rows, names = empty.scaled(df)
    rows = stored(rows.select(*names), "training-rows")
    return Model(features, means, deviations, fit(rows, names, [k], rounds)[k])


def save(model: Model, path: str) -> None:
    """One row per feature, as Parquet, replacing what is there."""
    spark = SparkSession.active()
    centers = zip(*model.centers)
    rows = [(i, *r, list(c)) for i, (*r, c) in enumerate(zip(model.features, model.means, model.deviations, centers))]
    schema = "place int, feature string, mean double, deviation double, centers array<double>"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> Model:
    rows = spark.read.parquet(path).orderBy("place").collect()  # one per feature
    centers = [list(c) for c in zip(*(r["centers"] for r in rows))]
    return Model(*([r[c] for r in rows] for c in ("feature", "mean", "deviation")), centers)


def score(df: DataFrame, model: Model) -> DataFrame:
    """Every row with its cluster, ``prediction``, by the means and deviations of the training rows."""
    rows, names = model.scaled(df)
    k = len(model.centers)
    near = assigned(rows, names, {k: model.centers})
    return near.withColumn("prediction", F.col(f"_cluster_{k}")).drop(*names, f"_cluster_{k}", f"_gap_{k}")
