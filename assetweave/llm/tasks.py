"""Python functions over partitions, with this package sent to the executors first."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import assetweave

Batches = Iterator[pa.RecordBatch]


@lru_cache(maxsize=None)
def _archive() -> str:
    root = Path(assetweave.__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="assetweave-code-")) / "assetweave-code.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    return str(path)


_sent: set[str] = set()


def send_code(spark: SparkSession) -> None:
    """Add the package to the Python path of the application's executors, once."""
    context = spark.sparkContext
    if context.applicationId not in _sent:
        context.addPyFile(_archive())
        _sent.add(context.applicationId)


def map_batches(df: DataFrame, fn: Callable[[Batches], Batches], schema) -> DataFrame:
    """``df.mapInArrow`` with a function of this package."""
    send_code(df.sparkSession)
    return df.mapInArrow(fn, schema)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out
