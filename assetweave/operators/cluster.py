"""K-Means on asset features, and the risk labels derived from the clusters."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetweave.functions.risk import RISK_LABELS
from assetweave.operators import lloyd
from assetweave.schemas import require_columns

#: fixed values: the three feature lists that models are trained on
FEATURES_5 = ["intraday_return", "sma_50", "volatility_10", "avg_volume_50", "rsi_14"]
FEATURES_10 = [
    "momentum",
    "beta",
    "alpha",
    "pe_ratio",
    "dividend_yield",
    "intraday_return",
    "sma_50",
    "volatility_10",
    "avg_volume_50",
    "rsi_14",
]
FEATURES_4 = ["beta", "alpha", "dividend_yield", "volatility_10"]

CLUSTERS = 3
SEED = 42
#: most rounds, and the largest move of a center that ends them; as in Spark's K-Means
ROUNDS = 20
TOLERANCE = 1e-4


def _filled(features: list[str]) -> list[str]:
    return [f"_filled_{c}" for c in features]


def _scaling(features: list[str]) -> list:
    """NULL and NaN become the training mean, so that every row has a vector; then standardise."""
    return [
        Imputer(inputCols=features, outputCols=_filled(features), strategy="mean"),
        VectorAssembler(inputCols=_filled(features), outputCol="features_raw", handleInvalid="error"),
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
    ]


def _transform(model: PipelineModel, df: DataFrame) -> DataFrame:
    """One output row per input row, without the helper columns."""
    return model.transform(df).drop("features_raw", *model.stages[0].getOutputCols())


def scaler_and_centers(model: PipelineModel) -> tuple[list[float], list[float], list[list[float]]]:
    """Means, deviations and centers of a trained model."""
    scaler, kmeans = model.stages[-2], model.stages[-1]
    centers = [[float(v) for v in center] for center in kmeans.clusterCenters()]
    return [float(v) for v in scaler.mean], [float(v) for v in scaler.std], centers


def scale(df: DataFrame, features: list[str]) -> DataFrame:
    """Add the standardised feature vector ``features``."""
    require_columns(df, features)
    return _transform(Pipeline(stages=_scaling(features)).fit(df), df)


def _scaled_columns(scaling: PipelineModel, df: DataFrame, features: list[str]) -> tuple[DataFrame, list[str]]:
    """The numbers that ``scaling`` puts into the vector, as plain columns; and their names."""
    means = scaling.stages[0].surrogateDF.first()
    scaler = scaling.stages[-1]
    names, z = [f"_z_{c}" for c in features], []
    for name, c, mean, deviation in zip(names, features, scaler.mean, scaler.std):
        known = F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(float(means[c])))
        z.append(((known - float(mean)) * (1.0 / float(deviation) if deviation else 0.0)).alias(name))
    return df.select(*z), names


def train(df: DataFrame, features: list[str], k: int = CLUSTERS, seed: int = SEED) -> PipelineModel:
    """Means, scaler and K-Means in one model.

    All rows take part in every round as plain cached columns, 8 bytes a number; a vector would
    take three times that. The centers found are all that Spark's K-Means is then fitted to, which
    makes the model that is saved, loaded and applied. ``seed`` only orders the clusters.
    """
    require_columns(df, features)
    scaling = Pipeline(stages=_scaling(features)).fit(df)
    rows, names = _scaled_columns(scaling, df, features)
    rows = rows.persist()
    try:
        centers = lloyd.fit(rows, names, [k], ROUNDS, TOLERANCE, lloyd.column_round)[k]
    finally:
        rows.unpersist()
    points = df.sparkSession.createDataFrame([(Vectors.dense(c),) for c in centers], ["features"])
    alone = KMeans(k=k, seed=seed, initMode="random", maxIter=1, featuresCol="features", predictionCol="prediction")
    return PipelineModel(stages=[*scaling.stages, alone.fit(points)])


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def score(df: DataFrame, path: str, column: str = "prediction") -> DataFrame:
    """Cluster rows with a saved model, using the means and the scaler it was trained with."""
    model = PipelineModel.load(path)
    model.stages[-1].setPredictionCol(column)
    return predict(model, df)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Every row with its cluster, ``prediction``."""
    return _transform(model, df)


def cluster(df: DataFrame, features: list[str], k: int = CLUSTERS, seed: int = SEED) -> DataFrame:
    """Impute, scale and cluster; ``prediction`` holds the cluster."""
    return predict(train(df, features, k, seed), df)


def elbow(
    df: DataFrame, features: list[str], ks: range = range(2, 10), seed: int = SEED, parallel: int = 4
) -> DataFrame:
    """Training cost for each k, over one cached scaled input; fits run side by side."""
    scaled = scale(df, features).select("features").persist()

    def cost(k: int) -> tuple[int, float]:
        return k, float(KMeans(k=k, seed=seed, featuresCol="features").fit(scaled).summary.trainingCost)

    try:
        with ThreadPool(parallel) as pool:
            costs = pool.map(inheritable_thread_target(df.sparkSession)(cost), ks)
    finally:
        scaled.unpersist()
    return df.sparkSession.createDataFrame(costs, "k int, cost double")


def silhouette(clustered: DataFrame) -> float:
    """Mean silhouette with squared Euclidean distance."""
    return ClusteringEvaluator(featuresCol="features", predictionCol="prediction").evaluate(clustered)


def risk_label(
    clustered: DataFrame,
    by: str = "volatility_10",
    cluster_column: str = "prediction",
    labels: Sequence[str] = RISK_LABELS,
) -> DataFrame:
    """Name clusters from low to high risk in the order of their mean ``by``.

    The mapping has one row per cluster, so its window and broadcast are tiny.
    More clusters than ``labels`` are an error.
    """
    means = clustered.groupBy(cluster_column).agg(F.avg(by).alias("_mean"))
    rank = F.row_number().over(Window.orderBy(F.col("_mean").asc_nulls_last(), cluster_column))
    names = F.array(*[F.lit(label) for label in labels])
    too_many = F.raise_error(F.lit(f"more clusters than the {len(labels)} labels"))
    mapping = means.select(cluster_column, F.when(rank <= len(labels), names[rank - 1]).otherwise(too_many).alias("risk_category"))
    return clustered.join(F.broadcast(mapping), cluster_column)


def clustered_view(df: DataFrame, features: list[str]) -> DataFrame:
    """Features, ``cluster`` and risk label only."""
    return df.withColumnRenamed("prediction", "cluster").select(*features, "cluster", "risk_category")


def standardize(df: DataFrame, columns: list[str], prefix: str = "z_") -> DataFrame:
    """Standardised copies of columns, without assembling a vector."""
    moments = df.agg(
        F.struct(
            *[F.avg(c).alias(f"mean_{c}") for c in columns], *[F.stddev_samp(c).alias(f"sd_{c}") for c in columns]
        ).alias("m")
    ).scalar()
    return df.withColumns(
        {prefix + c: F.try_divide(F.col(c) - moments[f"mean_{c}"], moments[f"sd_{c}"]) for c in columns}
    )


def nearest(columns: list[str], centers: list[list[float]]) -> Column:
    """Index of the nearest center; the lowest index on ties."""
    distances = []
    for center in centers:
        total = F.lit(0.0)
        for name, value in zip(columns, center):
            total = total + (F.col(name) - value) * (F.col(name) - value)
        distances.append(total)
    best = F.least(*distances)
    chosen = F.when(distances[0] == best, 0)
    for i, d in enumerate(distances[1:], start=1):
        chosen = chosen.when(d == best, i)
    return chosen
