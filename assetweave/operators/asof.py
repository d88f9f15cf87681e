"""As-of join: for each request the last known value of its key at or before its time.

Requests and values are one table in the order (key, time, values before requests),
range-sorted, so that a key with a third of all rows is spread like any other. The
last known value is carried in two levels: inside blocks of consecutive rows, and
from block to block over one summary row per block. A request whose block holds no
earlier value of its key takes the newest one of the blocks before it, however far
back that is; a value never crosses to another key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assetweave.operators.series import BLOCK_ROWS, with_position


def asof_join(
    requests: DataFrame,
    values: DataFrame,
    key: str = "ticker",
    at: str = "as_of",
    when: str = "dt",
    value: str = "close",
    name: str | None = None,
    found_at: str | None = None,
    tie: tuple[str, ...] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``requests`` with ``name`` (by default as ``value``): the last known value at or before ``at``.

    ``values`` has ``key``, ``when``, ``value``; rows with a NULL in one of them
    don't count. Of equal times the last by ``tie``, then the largest value,
    counts. Requests without a value before them, without key or without time
    get NULL; repeated requests stay. ``found_at`` adds the value's own time.
    """
    name = name or value
    for new in filter(None, (name, found_at)):
        if new in requests.columns:
            raise ValueError(f"requests have a column {new} already")
    # times are compared in the values' type: a day's value is known all day
    time = values.schema[when].dataType
    columns = [c for c in requests.columns]
    asked = requests.select(
        F.col(key).alias("_key"),
        F.col(at).cast(time).alias("_at"),
        F.lit(1).alias("_kind"),
        *[F.lit(None).cast(values.schema[c].dataType).alias(f"_tie{i}") for i, c in enumerate(tie)],
        F.lit(None).cast(values.schema[value].dataType).alias("_value"),
        F.struct(*columns).alias("_request"),
    )
    known = values.where(F.col(key).isNotNull() & F.col(when).isNotNull() & F.col(value).isNotNull()).select(
        F.col(key).alias("_key"),
        F.col(when).alias("_at"),
        F.lit(0).alias("_kind"),
        *[F.col(c).alias(f"_tie{i}") for i, c in enumerate(tie)],
        F.col(value).alias("_value"),
        F.lit(None).cast(asked.schema["_request"].dataType).alias("_request"),
    )
    order = ["_key", "_at", "_kind", *[f"_tie{i}" for i in range(len(tie))], "_value"]
    placed = with_position(known.unionByName(asked), order)
    placed = placed.withColumn("_block", F.floor(F.col("_position") / block_rows))
    latest = F.when(F.col("_kind") == 0, F.struct("_key", "_at", "_value"))
    so_far = Window.partitionBy("_block").orderBy("_position").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = placed.withColumn("_near", F.last(latest, ignorenulls=True).over(so_far)).where("_kind = 1")
    # one row per block: its newest value, then the newest of all blocks before
    newest = placed.groupBy("_block").agg(F.max_by(latest, F.when(F.col("_kind") == 0, F.col("_position"))).alias("_newest"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = newest.select("_block", F.last("_newest", ignorenulls=True).over(before).alias("_carried"))
    joined = near.join(carried, "_block")
    # inside the block an earlier value of another key hides nothing: this key's values would come after it
    last = F.coalesce("_near", "_carried")
    own = F.when((last["_key"] == F.col("_key")) & F.col("_at").isNotNull(), last)
    out = [F.col(f"_request.{c}").alias(c) for c in columns] + [own["_value"].alias(name)]
    return joined.select(*out, *([own["_at"].alias(found_at)] if found_at else []))
