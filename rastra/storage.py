"""The folder that all executors share, and tables settled in it."""

from __future__ import annotations

import os
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """URI of the folder named by ``spark.checkpoint.dir``.

    Where the setting is absent and Spark runs on this machine alone, as in
    tests, a folder of this user in the temporary directory takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + os.path.join(tempfile.gettempdir(), f"rastra-shared-{os.getuid()}")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str = "table", **options) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.options(**options).parquet(path)
    settled = spark.read.schema(df.schema).parquet(path)
    _PATHS[settled] = path
    return settled


#: Where the tables that ``settle`` returned lie.
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def exchanged(df: DataFrame) -> DataFrame:
    """``df`` for a join that both sides are exchanged for.

    Spark sizes what a function or an explode makes by what went into it, and a
    file by its compressed bytes. By itself it sends a table whole to the driver
    and all tasks while it takes it for small, or the other side once it finds
    that this one isn't.
    """
    return df.hint("merge")


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``settle`` returned and nothing reads any more; what was settled from them has its own files."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(_PATHS.pop(df))
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
