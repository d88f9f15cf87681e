"""How a time series is laid out for window functions.

Two layouts, the same results:

* **By asset** (``Series()``). Daily bars hold at most one row per asset and
  calendar day (they come out of an aggregation or de-duplication on that key),
  so an asset's group is bounded by the calendar: some 25,000 rows per century,
  however large the table grows. One shuffle on the asset, all windows share it.

* **In blocks** (``in_blocks``). Intraday rows have no such bound: one asset may
  hold a third of all quotes. The whole table is range-sorted by (asset, time),
  cut into blocks of consecutive rows, and each block also gets copies of the
  ``lookback`` rows before it. Windows then run per block, so no task ever holds
  more than a few blocks, whatever the distribution of assets.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from assetweave.session import stored

#: rows per block of the blocked layout
BLOCK_ROWS = 65_536


@dataclass(frozen=True)
class Series:
    """Grouping and order of a time series."""

    by: tuple[str, ...] = ("ticker",)
    order: tuple[str, ...] = ("dt",)

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.by).orderBy(*self.order)

    @property
    def whole(self) -> WindowSpec:
        return Window.partitionBy(*self.by)

    def last(self, n: int) -> WindowSpec:
        """The current row and the n - 1 rows before it."""
        return self.window.rowsBetween(1 - n, Window.currentRow)


DAILY = Series()


def with_position(df: DataFrame, order: Sequence[str], name: str = "_position") -> DataFrame:
    """Add each row's 0-based position in the total order ``order``.

    A range shuffle spreads the rows evenly even if one key dominates. The
    sorted rows are written to the shared folder together with their partition
    and row number, so both stay fixed when rows are read again. Only one small
    row per partition is ever brought together.
    """
    numbered = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    ordered = stored(numbered, "ordered")
    partition = F.shiftright("_mid", 33)
    within = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ordered.groupBy(partition.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (
        ordered.withColumn("_part", partition)
        .join(F.broadcast(starts), "_part")  # one row per partition
        .withColumn(name, F.col("_start") + within)
        .drop("_mid", "_part", "_start")
    )


def in_blocks(
    df: DataFrame,
    series: Series,
    lookback: int,
    compute: Callable[[DataFrame, Series], DataFrame],
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Run ``compute(df, series)`` per block of consecutive rows.

    ``compute`` may look back at most ``lookback`` rows; its ``series`` argument
    carries the block in its grouping. ``series.order`` must be total within an
    asset. Every row comes out exactly once.
    """
    if lookback > block_rows:
        raise ValueError("lookback must not exceed block_rows")
    placed = with_position(df, [*series.by, *series.order])
    block = F.floor(F.col("_position") / block_rows)
    feeds_next = F.col("_position") % block_rows >= block_rows - lookback
    copies = F.when(feeds_next, F.array(block, block + 1)).otherwise(F.array(block))
    spread = placed.withColumn("_home", block).withColumn("_block", F.explode(copies))
    # as many tasks as blocks, so that what a task sorts doesn't grow with the table
    tasks = max(-(-placed.count() // block_rows), df.sparkSession.sparkContext.defaultParallelism)
    spread = spread.repartition(tasks, "_block", *series.by)
    result = compute(spread, Series(("_block", *series.by), series.order))
    return result.where(F.col("_block") == F.col("_home")).drop("_block", "_home", "_position")
