"""Writers: CSV, append, versioned replacement, and counts taken while writing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str) -> None:
    """Replace a CSV folder; every part file has the header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def append_csv(df: DataFrame, path: str) -> None:
    """Add part files to a CSV folder, each with its own header."""
    df.write.mode("append").option("header", True).csv(path)


def append(df: DataFrame, path: str) -> None:
    """Add rows to a parquet table straight from the executors."""
    df.write.mode("append").parquet(path)


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the function that makes its paths."""
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path_of(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path_of


def complete_versions(spark: SparkSession, table: str) -> list[int]:
    fs, path_of = file_system(spark, table)
    if not fs.exists(path_of(table)):
        return []
    found = []
    for status in fs.listStatus(path_of(table)):
        name = status.getPath().getName()
        complete = path_of(status.getPath(), "_SUCCESS")
        if name.startswith("v") and name[1:].isdigit() and fs.exists(complete):
            found.append(int(name[1:]))
    return sorted(found)


def overwrite(df: DataFrame, table: str, compression: str | None = None) -> str:
    """Write the next version of a table. Readers of the current one are not disturbed.

    ``compression`` is that of the files, else the session's.

    Of two writers that take the same number one fails; an incomplete version
    that a lost job left behind must be removed first.
    """
    spark = df.sparkSession
    version = max(complete_versions(spark, table), default=0) + 1
    path = f"{table}/v{version}"
    df.write.mode("errorifexists").parquet(path, compression=compression)
    return path


def read_current(spark: SparkSession, table: str) -> DataFrame:
    """The newest complete version."""
    versions = complete_versions(spark, table)
    if not versions:
        raise ValueError(f"no complete version of {table}")
    return spark.read.parquet(f"{table}/v{versions[-1]}")


def observe_stage(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as they pass; read the observation after the write, without a second run."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def run_stage(df: DataFrame, name: str, write: Callable[[DataFrame], None]) -> tuple[str, int | None]:
    """Write a stage: ("success", rows), or ("failed: <reason>", None) if it raised."""
    observed, seen = observe_stage(df, name)
    try:
        write(observed)
    except Exception as error:
        return f"failed: {type(error).__name__}", None
    return "success", int(seen.get["rows"])


def stage_metrics(spark: SparkSession, stages: dict[str, Observation | tuple[str, int | None]]) -> DataFrame:
    """(stage, status, rows) of stages that were written or that ``run_stage`` ran."""
    rows = [
        (name, *(seen if isinstance(seen, tuple) else ("success", int(seen.get["rows"])))) for name, seen in stages.items()
    ]
    schema = T.StructType(
        [
            T.StructField("stage", T.StringType()),
            T.StructField("status", T.StringType()),
            T.StructField("rows", T.LongType()),
        ]
    )
    return spark.createDataFrame(rows, schema)
