"""Profiling: null counts, summary statistics with exact quartiles, correlations, distinct values."""

from __future__ import annotations

import math

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assetweave.session import stored

#: fixed values: the quantiles of a summary
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
#: of the quantile sketch: ranks are off by at most 1 / ACCURACY of the rows
ACCURACY = 10_000


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def null_profile(df: DataFrame) -> DataFrame:
    """Null count per column, (column, nulls), in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column", "nulls")


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max per column.

    Quartiles are exact, linearly interpolated, without sorting the table: a
    first pass takes the moments and a quantile sketch whose error is bounded,
    a second pass counts the values below the bracket that the sketch gives for
    each quartile and keeps those inside, a few in ten thousand. Only these are
    ranked. A bracket that doesn't hold the wanted ranks is opened to the whole
    column. ``df`` is read twice.
    """
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    probabilities = [p for q in QUARTILES.values() for p in (q - 2 / ACCURACY, q + 2 / ACCURACY)]
    moments = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    moments["sketch"] = lambda c: F.percentile_approx(c, probabilities, ACCURACY)
    row = values.agg(*[f(c).alias(f"{i}_{name}") for i, c in enumerate(columns) for name, f in moments.items()]).first()
    summary = {c: {name: row[f"{i}_{name}"] for name in moments} for i, c in enumerate(columns)}
    names = ["column", "count", "mean", "std", "min", "max"]
    kinds = {"column": "string", "count": "bigint"}
    rows = [(c, *(summary[c][n] for n in names[1:])) for c in columns]
    result = df.sparkSession.createDataFrame(rows, ", ".join(f"`{n}` {kinds.get(n, 'double')}" for n in names))
    quartiles = _quartiles(values, {c: r for c, r in summary.items() if r["count"]})
    return result.join(F.broadcast(quartiles), "column", "left").select(*names[:5], *QUARTILES, "max")


#: (column, quartile, wanted rank, lowest, highest value that can have that rank)
Bracket = tuple[str, str, float, float, float]


def _quartiles(values: DataFrame, summary: dict) -> DataFrame:
    """Interpolated values at the wanted ranks, one row per column."""
    brackets = []
    for column, row in summary.items():
        for i, (name, q) in enumerate(QUARTILES.items()):
            brackets.append((column, name, (row["count"] - 1) * q, row["sketch"][2 * i], row["sketch"][2 * i + 1]))
    below, copies = _candidates(values, brackets)
    inside = {r["bracket"]: r["n"] for r in copies.groupBy("bracket").agg(F.sum("copies").alias("n")).collect()}
    misses = [
        i
        for i, (_, _, rank, _, _) in enumerate(brackets)
        if not below[i] <= math.floor(rank) <= math.ceil(rank) < below[i] + inside.get(i, 0)
    ]
    if misses:
        for i in misses:
            column, name, rank, _, _ = brackets[i]
            brackets[i] = (column, name, rank, summary[column]["min"], summary[column]["max"])
        below, copies = _candidates(values, brackets)
    wanted = values.sparkSession.createDataFrame(
        [(i, c, name, rank, below[i]) for i, (c, name, rank, _, _) in enumerate(brackets)],
        "bracket int, column string, quartile string, rank double, below bigint",
    )
    ranked = _with_rank(copies, "bracket", "value", "copies").join(F.broadcast(wanted), "bracket")
    first = F.col("below") + F.col("_before")

    def at(rank):
        return F.max(F.when((first <= rank) & (rank < first + F.col("copies")), F.col("value")))

    picked = ranked.groupBy("column", "quartile", "rank").agg(
        at(F.floor("rank")).alias("low"), at(F.ceil("rank")).alias("high")
    )
    value = F.col("low") + (F.col("high") - F.col("low")) * (F.col("rank") - F.floor("rank"))
    return picked.groupBy("column").agg(
        *[F.max(F.when(F.col("quartile") == name, value)).alias(name) for name in QUARTILES]
    )


def _candidates(values: DataFrame, brackets: list[Bracket]) -> tuple[list[int], DataFrame]:
    """Rows below each bracket, and (bracket, value, copies) of those inside, from one pass.

    Every row gives one pattern of the brackets it lies below; patterns are few
    (four per column) and counted before the shuffle.
    """
    inside = [
        F.when(F.col(c).between(low, high), F.struct(F.lit(i).alias("bracket"), F.col(c).alias("value"), F.lit("").alias("under")))
        for i, (c, _, _, low, high) in enumerate(brackets)
    ]
    under = F.concat(F.lit(""), *[F.when(F.col(c) < low, "1").otherwise("0") for c, _, _, low, _ in brackets])
    pattern = F.struct(F.lit(-1).alias("bracket"), F.lit(None).cast("double").alias("value"), under.alias("under"))
    found = values.select(F.inline(F.filter(F.array(pattern, *inside), lambda x: x.isNotNull())))
    found = stored(found.groupBy("bracket", "value", "under").agg(F.count(F.lit(1)).alias("copies")), "candidates")
    patterns = found.where("bracket = -1").select("under", "copies").collect()
    below = [sum(r["copies"] for r in patterns if r["under"][i] == "1") for i in range(len(brackets))]
    return below, found.where("bracket >= 0").select("bracket", "value", "copies")


def _with_rank(df: DataFrame, group: str, value: str, weight: str) -> DataFrame:
    """Add ``_before``: total weight of smaller values in the group. Values are unique per group.

    A range sort spreads even a single group over all tasks. It is written out
    with its partition numbers, because totals are taken per partition first.
    """
    ordered = stored(df.orderBy(group, value).withColumn("_part", F.spark_partition_id()), "ranked")
    totals = ordered.groupBy(group, "_part").agg(F.sum(weight).alias("_total"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(group, "_part", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_start"))
    smaller = Window.partitionBy(group, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ordered.withColumn("_inside", F.coalesce(F.sum(weight).over(smaller), F.lit(0)))
        .join(F.broadcast(starts), [group, "_part"])  # at most one row per group and partition
        .withColumn("_before", F.col("_start") + F.col("_inside"))
        .drop("_part", "_start", "_inside")
    )


def correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    """Correlation matrix of complete rows in long form (feature_a, feature_b, corr)."""
    complete = df.select(*columns).na.drop()
    vectors = VectorAssembler(inputCols=columns, outputCol="v").transform(complete)
    matrix = Correlation.corr(vectors, "v").first()[0].toArray()
    cells = [(a, b, float(matrix[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return df.sparkSession.createDataFrame(cells, "feature_a string, feature_b string, corr double")
