"""Exact Shapley attribution of a cluster assignment to its features.

The value of a set of features is the mean outcome when those features keep
their value and the others come from background rows. Rows are independent of
each other given the background, so the table is mapped in place: no shuffle,
numpy per Arrow batch. The background is a weighted summary of all rows: they are
sorted into cells by where each feature lies between fixed cuts, and a cell counts
with its mean row and its number of rows. Cuts are a parameter; with m features and
c cuts there are at most (c + 1)^m cells, which is checked.

With two or three centers a row isn't compared with every background row: a cluster
is chosen where the background's lead over each rival stays below a limit that
follows from the row, so the value of a set is a place in a table of prefix sums
(``Leads``), found by bisection.
"""

from __future__ import annotations

import itertools
import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: background rows that the kernel takes
MAX_BACKGROUND = 4096
#: bytes of prefix sums that a task holds; beyond that, and with more centers, rows meet every background row
MAX_TABLES = 64 << 20
#: of standardised features
CUTS = (-1.0, 0.0, 1.0)


def cells(scaled: DataFrame, features: list[str], cuts: tuple[float, ...] = CUTS) -> DataFrame:
    """All rows as cells: mean of every feature, and ``weight``, the number of rows."""
    if (len(cuts) + 1) ** len(features) > MAX_BACKGROUND:
        raise ValueError(f"{len(cuts)} cuts of {len(features)} features can make more than {MAX_BACKGROUND} cells")
    places = []
    for c in features:
        place = F.lit(0)
        for cut in cuts:
            place = place + (F.col(c) > cut).cast("int")
        places.append(place.alias(f"_{c}"))
    means = [F.avg(c).alias(c) for c in features]
    return scaled.na.drop(subset=features).groupBy(*places).agg(*means, F.count(F.lit(1)).alias("weight")).select(
        *features, "weight"
    )


def _squared(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Points x centers x features."""
    return (points[:, None, :] - centers[None, :, :]) ** 2


def _sets(m: int) -> list[tuple[int, ...]]:
    return [members for r in range(m + 1) for members in itertools.combinations(range(m), r)]


def _keep(members: tuple[int, ...], m: int) -> np.ndarray:
    keep = np.zeros(m, dtype=bool)
    keep[list(members)] = True
    return keep


class Pairs:
    """Values of sets by comparing every row with every background row."""

    def __init__(self, background: np.ndarray, weights: np.ndarray, centers: np.ndarray, target: str | int):
        self.other, self.weights, self.target = _squared(background, centers), weights, target

    def value(self, members: tuple[int, ...], kept: np.ndarray, assigned: np.ndarray) -> np.ndarray:
        """Mean outcome of every row; ``kept`` are its distances (rows x centers) over the members."""
        chosen = _nearest(kept, self.other[:, :, ~_keep(members, self.other.shape[2])].sum(axis=2))
        if isinstance(self.target, int):
            outcome = chosen == self.target
        else:
            outcome = chosen == assigned[:, None] if self.target == "own" else chosen
        return outcome @ self.weights


class Leads:
    """Values of sets by tables, for two or three centers.

    Cluster j is chosen where for each rival r the background row's D_j - D_r is below
    (for a rival of higher number at most) the row's D_r - D_j. Both leads are sorted,
    and the weights below any two places are prefix sums.
    """

    def __init__(self, background: np.ndarray, weights: np.ndarray, centers: np.ndarray, target: str | int):
        self.target, self.clusters = target, [target] if isinstance(target, int) else range(len(centers))
        self.tables = {}
        other, n = _squared(background, centers), len(background)
        for members in _sets(centers.shape[1]):
            replaced = other[:, :, ~_keep(members, centers.shape[1])].sum(axis=2)
            for j in self.clusters:
                rivals = [r for r in range(len(centers)) if r != j]
                edges, places = [], []
                for r in rivals:
                    edge, place = np.unique(replaced[:, j] - replaced[:, r], return_inverse=True)
                    edges.append(edge)
                    places.append(place.ravel() + 1)
                sums = np.zeros([len(e) + 1 for e in edges])
                np.add.at(sums, tuple(places), weights)
                for axis in range(sums.ndim):
                    sums = sums.cumsum(axis=axis)
                self.tables[members, j] = rivals, edges, sums

    @staticmethod
    def fits(background: np.ndarray, centers: np.ndarray, target: str | int) -> bool:
        k, m = centers.shape
        tables = 2**m * (1 if isinstance(target, int) else k)
        return k in (2, 3) and tables * 8 * (len(background) + 1) ** (k - 1) <= MAX_TABLES

    def _share(self, members: tuple[int, ...], j: int, kept: np.ndarray) -> np.ndarray:
        rivals, edges, sums = self.tables[members, j]
        limits = [kept[:, r] - kept[:, j] for r in rivals]
        return sums[tuple(np.searchsorted(e, q, "right" if r > j else "left") for r, e, q in zip(rivals, edges, limits))]

    def value(self, members: tuple[int, ...], kept: np.ndarray, assigned: np.ndarray) -> np.ndarray:
        """Mean outcome of every row; ``kept`` are its distances (rows x centers) over the members."""
        if isinstance(self.target, int):
            return self._share(members, self.target, kept)
        out = np.zeros(len(kept))
        for j in self.clusters:
            if self.target == "own":
                some = np.flatnonzero(assigned == j)
                out[some] = self._share(members, j, kept[some])
            elif j:
                out += j * self._share(members, j, kept)
        return out


def shapley(rows: np.ndarray, centers: np.ndarray, values: Pairs | Leads) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and attributions (rows x features) for a batch of rows."""
    n, m = rows.shape
    own = _squared(rows, centers)
    assigned = own.sum(axis=2).argmin(axis=1)
    phi = np.zeros((n, m))
    for members in _sets(m):
        v = values.value(members, own[:, :, _keep(members, m)].sum(axis=2), assigned)
        size = len(members)
        for i in range(m):
            if i in members:
                phi[:, i] += v * math.factorial(size - 1) * math.factorial(m - size) / math.factorial(m)
            else:
                phi[:, i] -= v * math.factorial(size) * math.factorial(m - size - 1) / math.factorial(m)
    return assigned, phi


def _nearest(kept: np.ndarray, replaced: np.ndarray) -> np.ndarray:
    """Center with the smallest sum of both partial distances, for every row and background row."""
    best = kept[:, :1] + replaced[:, 0]
    chosen = np.zeros(best.shape, dtype=np.int8)
    for j in range(1, kept.shape[1]):
        distance = kept[:, j : j + 1] + replaced[:, j]
        closer = distance < best
        chosen[closer] = j
        np.minimum(best, distance, out=best)
    return chosen


def attribution(
    df: DataFrame,
    features: list[str],
    centers: list[list[float]],
    background: DataFrame,
    target: str | int = "own",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``keep``, ``cluster`` and ``phi_<feature>`` of every row whose features are complete.

    ``background`` has the features and a column ``weight``. ``target="own"``
    explains the membership in the row's own cluster, a number the membership in
    that cluster, and ``"id"`` the cluster number itself.
    """
    sample = background.select(*features, "weight").limit(MAX_BACKGROUND + 1).toPandas()
    if len(sample) > MAX_BACKGROUND:
        raise ValueError(f"summarise the background to at most {MAX_BACKGROUND} rows")
    points = sample[features].to_numpy(dtype=float)
    weights = sample["weight"].to_numpy(dtype=float)
    if not len(points):
        raise ValueError("the background has no rows")
    weights = weights / weights.sum()
    middles = np.asarray(centers, dtype=float)
    kept = df.select(*keep).schema.fields
    schema = T.StructType(
        [
            *kept,
            T.StructField("cluster", T.IntegerType()),
            *[T.StructField(f"phi_{c}", T.DoubleType()) for c in features],
        ]
    )
    kind = Leads if Leads.fits(points, middles, target) else Pairs
    # rows per numpy step, so that rows x background x centers (of pairs) stays in cache-friendly size
    step = 10_000 if kind is Leads else max(1, 2_000_000 // (len(points) * len(middles)))

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = kind(points, weights, middles, target)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                named = dict(zip(part.schema.names, part.columns))
                rows = np.stack([named[c].to_numpy(zero_copy_only=False).astype(float) for c in features], 1)
                cluster, phi = shapley(rows, middles, values)
                columns = [*(named[c] for c in keep), pa.array(cluster.astype(np.int32)), *map(pa.array, phi.T.copy())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    # ship this module's functions with the task, so that workers need only numpy and pyarrow
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    complete = df.select(*keep, *[c for c in features if c not in keep]).na.drop(subset=features)
    return complete.mapInArrow(explain, schema)


def attribution_by_cluster(attributed: DataFrame) -> DataFrame:
    """Mean attribution of every feature, per cluster."""
    phis = [c for c in attributed.columns if c.startswith("phi_")]
    return attributed.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in phis])
