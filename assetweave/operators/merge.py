"""Keyed updates of stored tables, expressed on DataFrames: upsert, field merge, comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assetweave.operators.cleaning import DESCRIPTIVE, needs_enrichment


def dedupe(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Keep the first row per key in ``order``.

    Spark cuts each map task's rows to one per key before the shuffle (window
    group limit), so a key with very many copies does not pile up in one task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") == 1).drop("_rank")


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def upsert(base: DataFrame, delta: DataFrame, keys: list[str], stamp: str, tie: list[str]) -> DataFrame:
    """Newest row per key by ``stamp``; on equal stamps the delta's, then the highest ``tie`` columns.

    ``tie`` must tell all rows of a key apart that matter, so that the result is
    the same in every run.
    """
    tagged = base.withColumn("_side", F.lit(0)).unionByName(
        delta.withColumn("_side", F.lit(1)), allowMissingColumns=True
    )
    order = [F.col(stamp).desc_nulls_last(), F.col("_side").desc(), *[F.col(c).desc_nulls_last() for c in tie]]
    return dedupe(tagged, keys, order).drop("_side")


def merge_fields(base: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """Set only the delta's fields, inserting unknown keys.

    A matched row takes the delta's values, NULL included; others stay as they are.
    A key that the delta holds twice is an error.
    """
    twice = F.raise_error(F.concat(F.lit("more than one new row for "), F.col(key).cast("string")))
    fields = [c for c in delta.columns if c != key]
    once = delta.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *[F.any_value(c).alias(c) for c in fields])
    delta = once.where(F.when(F.col("_n") == 1, True).otherwise(twice)).drop("_n")
    new = delta.select(
        F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in delta.columns if c != key]
    ).withColumn("_hit", F.lit(True))
    joined = base.join(new, base[key] == F.col("_key"), "full_outer")
    hit = F.coalesce("_hit", F.lit(False))
    out = [F.coalesce(base[key], "_key").alias(key)]
    for c in base.columns:
        if c == key:
            continue
        if c in delta.columns:
            out.append(F.when(hit, F.col(f"_new_{c}")).otherwise(base[c]).alias(c))
        else:
            out.append(base[c])
    out += [F.col(f"_new_{c}").alias(c) for c in delta.columns if c not in base.columns]
    return joined.select(*out)


def change_stats(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how many keys were inserted, removed, updated and left unchanged.

    A column that only one side has counts as NULL on the other.
    """
    kinds = {**dict(before.dtypes), **dict(after.dtypes)}
    values = [c for c in kinds if c not in keys]

    def rows(df: DataFrame, name: str) -> DataFrame:
        own = [F.col(c) if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in values]
        return df.select(*keys, F.struct(*own).alias(name))

    old, new = rows(before, "_old"), rows(after, "_new")
    old_there, new_there = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    same = F.col("_old").eqNullSafe(F.col("_new"))
    return old.join(new, keys, "full_outer").agg(
        F.count_if(~old_there).alias("inserted"),
        F.count_if(~new_there).alias("removed"),
        F.count_if(old_there & new_there & ~same).alias("updated"),
        F.count_if(old_there & new_there & same).alias("unchanged"),
    )


def enrich(meta: DataFrame, attributes: DataFrame) -> DataFrame:
    """Take new descriptive values for assets with a gap in their identifying fields."""
    fields = [c for c in DESCRIPTIVE if c in attributes.columns]
    new = attributes.select("ticker", *[F.col(c).alias(f"_new_{c}") for c in fields], F.lit(True).alias("_hit"))
    fetch = needs_enrichment() & F.coalesce("_hit", F.lit(False))

    def value(name: str):
        found = F.coalesce(f"_new_{name}", F.lit("N/A"))
        return F.when(F.col("_fetch"), found).otherwise(F.col(name)).alias(name)

    joined = meta.join(new, "ticker", "left").withColumn("_fetch", fetch)
    return joined.select(*[value(c) if c in fields else F.col(c) for c in meta.columns])


def pending(assets: DataFrame, meta: DataFrame, fields: list[str], key: str = "ticker") -> DataFrame:
    """Assets for which any of the metrics is absent, NULL, NaN or not a number."""
    kinds = dict(meta.dtypes)
    done = F.lit(True)
    for name in fields:
        if name not in kinds:
            done = F.lit(False)
        elif kinds[name] == "string":
            done = F.lit(False)
        elif kinds[name] in ("double", "float"):
            done = done & F.col(name).isNotNull() & ~F.isnan(name)
        else:
            done = done & F.col(name).isNotNull()
    finished = meta.where(done).select(key)
    return assets.select(key).distinct().join(finished, key, "left_anti")


def missing_names(meta: DataFrame) -> DataFrame:
    """Assets that ``enrich`` would look up."""
    return meta.where(needs_enrichment())
