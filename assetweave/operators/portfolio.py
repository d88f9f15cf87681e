"""From labelled assets and questionnaire answers to portfolios.

A recommendation depends on the user only through the risk class, so the assets
are chosen once per class and the (large) users table is joined with that short
list. Users never meet all assets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assetweave.functions.cleaning import ratio
from assetweave.functions.risk import risk_bin, risk_score, tolerance_label
from assetweave.operators.rolling import with_means
from assetweave.operators.series import DAILY, Series
from assetweave.session import bounded

#: rows that a side of a join may have to be broadcast
FEW = 100_000
#: assets per category in a portfolio, and the seed of their choice
PER_CATEGORY = 5
SEED = 42


def sorted_bars(bars: DataFrame) -> DataFrame:
    return bars.orderBy("ticker", "dt")


def first_rows(df: DataFrame, order: list, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def latest_record(df: DataFrame, order: list) -> DataFrame:
    """The newest row; ``order`` is newest first."""
    return df.orderBy(*order).limit(1)


def latest_per_asset(df: DataFrame, by: list[str], values: list[str], when: str = "dt") -> DataFrame:
    """Values of the newest row per asset. One column per value keeps the aggregation hash-based."""
    newest = [F.max_by(c, when).alias(c) for c in values]
    return df.groupBy(*by).agg(F.max(when).alias(when), *newest)


def choose_assets(assets: DataFrame, by: list[str], k: int = PER_CATEGORY, seed: int = SEED) -> DataFrame:
    """Up to k assets per group in seeded random order.

    Each map task keeps at most k rows per group before the shuffle (window
    group limit), so large groups cost nothing extra.
    """
    shuffled = Window.partitionBy(*by).orderBy(F.md5(F.concat("ticker", F.lit(str(seed)))), "ticker")
    return assets.withColumn("_n", F.row_number().over(shuffled)).where(F.col("_n") <= k).drop("_n")


def scored_users(users: DataFrame) -> DataFrame:
    """Users with risk score and preferred risk class."""
    return users.withColumn("risk_score", risk_score("age", "duration")).withColumn(
        "risk_category", risk_bin("risk_score")
    )


def allocate(portfolio: DataFrame, by: str = "risk_category", weight: str = "momentum") -> DataFrame:
    """Share of each row in its group's total ``weight``; NULL if the total is zero.

    A group may hold a third of all assets, so totals are aggregated map-side
    and joined back; their size decides at run time how.
    """
    totals = portfolio.groupBy(by).agg(F.sum(weight).alias("_total"))
    joined = portfolio.join(totals, by)
    return joined.withColumn("share", ratio(weight, "_total")).drop("_total")


def build_portfolio(users: DataFrame, assets: DataFrame, k: int = PER_CATEGORY, seed: int = SEED) -> DataFrame:
    """Up to k assets per category of each user's risk class, with the amount to invest in each.

    The short list has at most k rows per (risk class, category); as categories
    are free text, it is only broadcast if it is short indeed.
    """
    short_list = allocate(choose_assets(assets, ["risk_category", "category"], k, seed))
    picks = short_list.select("ticker", "category", "risk_category", "momentum", "share")
    return (
        scored_users(users)
        .join(bounded(picks, FEW, "short-list"), "risk_category")
        .withColumn("investment", F.col("share") * F.col("amount"))
    )


def match_tolerance(assets: DataFrame, users: DataFrame) -> DataFrame:
    """Assets that suit the tolerance levels found among users, with how many users and how much money.

    Users are reduced to one row per level first, so no user-asset pairs arise.
    """
    demand = users.groupBy("tolerance").agg(
        F.count(F.lit(1)).alias("n_users"), F.sum("amount").alias("total_amount")
    )
    wanted = demand.withColumn("risk_category", tolerance_label("tolerance"))
    return assets.join(bounded(wanted, FEW, "demand"), "risk_category")


def for_tolerance(assets: DataFrame, tolerance: str) -> DataFrame:
    """Assets that suit one user's tolerance."""
    return assets.where(F.col("risk_category") == F.concat(F.lit(tolerance), F.lit(" Risk")))


def sector_allocation(df: DataFrame, column: str = "category") -> DataFrame:
    """Rows per category and their share of all rows."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return counts.withColumn("share", F.col("count") / total)


def portfolio_view(df: DataFrame) -> DataFrame:
    return df.select("ticker", "category", "momentum", "pe_ratio", "risk_category")


def signal(prices: DataFrame, n: int = 30, s: Series = DAILY) -> DataFrame:
    """Buy where the last close is above its n-row mean, else Hold; one row per asset.

    An asset with fewer than n rows has no mean and no recommendation yet.
    """
    with_mean = with_means(prices, {"moving_avg": ("close", n)}, s)
    last = with_mean.groupBy(*s.by).agg(
        F.max(s.order[0]).alias("date"),
        F.max_by("close", s.order[0]).alias("last_close"),
        F.max_by("moving_avg", s.order[0]).alias("last_moving_avg"),
    )
    buy = F.col("last_close") > F.col("last_moving_avg")
    return last.withColumn("recommendation", F.when(buy, "Buy").when(~buy, "Hold"))
