"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only by local sessions that name no folder, as in tests.
DEFAULT_DIR = "/tmp/checkpoints"

#: What to call for each table that is still there, by its path.
_there: dict[str, object] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or else the checkpoint folder of the context; an error on a cluster that names neither."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return DEFAULT_DIR


def cut(df: DataFrame, *by: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back, which ends its lineage; it goes with dropped, or with the driver.

    With by, it lies in a folder for each value of those columns.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/probata/{uuid.uuid4().hex}"
    schema = df.schema
    df.write.partitionBy(*by).parquet(path) if by else df.write.parquet(path)
    _there[path] = lambda: _removed(spark, path)
    out = spark.read.schema(schema).parquet(path)
    out.cut_at = path
    return out


def _removed(spark: SparkSession, path: str) -> None:
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may have ended first
        pass


def dropped(*tables: DataFrame) -> None:
    """Removes tables that cut wrote, once nothing that is yet to run reads them."""
    for t in tables:
        remove = _there.pop(getattr(t, "cut_at", None), None)
        if remove is not None:
            remove()


def _all_dropped() -> None:
    while _there:
        _there.popitem()[1]()


atexit.register(_all_dropped)
