"""The whole chain: bars to features, clusters, explanations and portfolios.

Each stage is written once and read by the next, so a failure restarts at the
last finished stage and rows are counted while they are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetweave.operators import cluster
from assetweave.operators.attribution import attribution, attribution_by_cluster, cells
from assetweave.operators.cleaning import drop_incomplete, impute_mean
from assetweave.operators.portfolio import build_portfolio, latest_per_asset
from assetweave.plans.features import ensure_features, enhanced_bars
from assetweave.sources.sinks import observe_stage, overwrite, read_current, stage_metrics

FEATURES = cluster.FEATURES_4


def recommend(bars: DataFrame, market: DataFrame, eps: DataFrame, users: DataFrame, folder: str) -> dict[str, DataFrame]:
    """Run the chain below ``folder``; returns the tables and the row counts of the stages."""
    spark = bars.sparkSession
    tables, counts = {}, {}

    def write(name: str, df: DataFrame) -> DataFrame:
        observed, counts[name] = observe_stage(df, name)
        overwrite(observed, f"{folder}/{name}", compression="zstd")
        tables[name] = read_current(spark, f"{folder}/{name}")
        return tables[name]

    enhanced = enhanced_bars(drop_incomplete(bars), market, eps)
    # the windows of the features follow while the rows lie together by asset; gaps are filled from what is written
    with_gaps = write("enhanced", ensure_features(enhanced, FEATURES))
    tables["enhanced"] = with_gaps.select(enhanced.columns)
    features = write("features", impute_mean(with_gaps, FEATURES))

    model = cluster.train(features, FEATURES)
    cluster.save(model, f"{folder}/model")
    labelled = cluster.risk_label(cluster.predict(model, features), by="volatility_10")
    clustered = write("clustered", labelled.drop("features"))

    write("interpretation", attribution_by_cluster(explained(clustered, model)))

    latest = latest_per_asset(clustered, ["ticker", "category"], ["momentum", "pe_ratio", "risk_category"])
    write("portfolios", build_portfolio(users, latest))
    tables["stages"] = stage_metrics(spark, counts)
    return tables


def explained(clustered: DataFrame, model, keep: tuple[str, ...] = ()) -> DataFrame:
    """Attribution of the trained clusters in the model's scaled space, against all rows in cells."""
    means, deviations, centers = cluster.scaler_and_centers(model)
    scaled = clustered.withColumns(
        {f"z_{c}": (F.col(c) - m) / (s or 1.0) for c, m, s in zip(FEATURES, means, deviations)}
    )
    names = [f"z_{c}" for c in FEATURES]
    return attribution(scaled, names, centers, cells(scaled, names), target="own", keep=keep)
