"""Exponential moving average (span n, no bias adjustment, seeded with the first value).

``y0 = x0;  y[t] = a x[t] + q y[t-1]`` with ``a = 2 / (span + 1)``, ``q = 1 - a``,
over the known values: the first known value is the seed, a missing one (NULL or
NaN) leaves the average as it is, and before the seed there is none.

The recurrence is linear, so it is cut into steps of ``STEP`` rows:

* ``local``: the average restarted in each step, a running sum of ``x q^-i``
  times ``q^i``. A step is short enough for the powers to stay finite.
* ``carry``: what earlier steps contribute, the local averages at their ends, each
  decayed by the rows since. A step holds ``STEP`` known values, so the end of the
  k-th step back is known by its number: a range frame over the steps reaches it.
  Steps whose weight is below 1e-17 are left out.

A missing value belongs to the step of the last known one and adds nothing to it, so
it gets that one's average. Everything is a window function on the series' own
grouping, sorted once more, by step: no join, and no shuffle beyond the one the
other indicators use.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assetweave.operators.series import DAILY, Series

STEP = 256
#: -ln of the weight at which history no longer shows in a double
NEGLIGIBLE = 40.0


def ema_lookback(span: int) -> int:
    """Rows of history that matter for a double."""
    q = 1 - 2 / (span + 1)
    return 1 if q == 0 else math.ceil(NEGLIGIBLE / -math.log(q)) + 1


def with_steps(df: DataFrame, s: Series = DAILY, column: str = "close") -> DataFrame:
    """Add number among the known values, step and offset in the step; next to other windows they share one pass."""
    so_far = s.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        df.withColumn("_known", F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double")))
        .withColumn("_rn", F.sum(F.col("_known").cast("long")).over(so_far) - 1)
        .withColumn("_step", F.floor(F.col("_rn") / STEP))
        .withColumn("_off", F.col("_rn") % STEP)
    )


def with_ema(df: DataFrame, spans: dict[str, int], column: str = "close", s: Series = DAILY) -> DataFrame:
    """Add one average per entry of ``spans`` (output name -> span)."""
    if "_step" not in df.columns:
        df = with_steps(df, s, column)
    rows = (Window.unboundedPreceding, Window.currentRow)
    # a known value, then the missing ones after it, in an order that equal times don't disturb
    in_step = Window.partitionBy(*s.by, "_step").orderBy("_rn", F.col("_known").desc()).rowsBetween(*rows)
    along = Window.partitionBy(*s.by).orderBy("_step")

    x, off = F.col(column), F.col("_off")
    q = {name: 1 - 2 / (span + 1) for name, span in spans.items() if span > 1}
    fed, local, carry, result = {}, {}, {}, {}
    for name, decay in q.items():
        value = F.when(F.col("_rn") == 0, x).otherwise((1 - decay) * x)
        fed[f"_fed_{name}"] = F.when(F.col("_known"), value * F.pow(F.lit(decay), -off))
        local[f"_local_{name}"] = F.sum(f"_fed_{name}").over(in_step) * F.pow(F.lit(decay), off)
        steps_back = math.ceil(NEGLIGIBLE / (-math.log(decay) * STEP)) + 1
        before = F.lit(0.0)
        for k in range(1, steps_back + 1):
            # of a step the row with the most known values, which is any of its last ones
            end = F.max(F.struct("_rn", f"_local_{name}")).over(along.rangeBetween(-k, -k))[f"_local_{name}"]
            before = before + F.coalesce(end, F.lit(0.0)) * decay ** ((k - 1) * STEP)
        carry[f"_carry_{name}"] = before
        result[name] = F.col(f"_local_{name}") + F.col(f"_carry_{name}") * F.pow(F.lit(decay), off + 1)
    for stage in (fed, local, carry, result):
        df = df.withColumns(stage)
    last = F.last(F.when(F.col("_known"), x), ignorenulls=True).over(in_step)
    df = df.withColumns({name: last for name, span in spans.items() if span == 1})
    return df.drop("_known", "_rn", "_step", "_off", *fed, *local, *carry)
