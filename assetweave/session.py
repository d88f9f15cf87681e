"""Session set-up and the shared folder for written intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def session(app: str = "assetweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; executor sizing stays with the cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local-mode session, where driver and executors are one process,
    may fall back to a folder of its own.
    """
    context = spark.sparkContext
    folder = (
        context.getConf().get("spark.checkpoint.dir")
        or spark.conf.get("spark.checkpoint.dir", None)
        or context.getCheckpointDir()
    )
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="assetweave-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


_own_folders: set[str] = set()


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses.

    All paths of an application are below one folder named after it, which the
    driver removes when the application ends.
    """
    folder = f"{shared_dir(spark)}/assetweave-{spark.sparkContext.applicationId}"
    if folder not in _own_folders:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        store.mkdirs(path)
        store.deleteOnExit(path)
        _own_folders.add(folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and continue from there.

    For rows that several passes read: they are computed once, and a lost
    executor costs a re-read instead of a re-computation.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, most: int, name: str) -> DataFrame:
    """``df`` written, and broadcast if it has ``most`` rows at most; else its size decides how it is joined."""
    df = stored(df, name)
    return F.broadcast(df) if df.count() <= most else df
