"""Tables that are written once and read again, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_made: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share; deleted when the driver ends.

    Only a session without that setting (a local one, as in tests) gets a folder of its own.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        found = sc._jsc.sc().getCheckpointDir()
        base = found.get() if found.isDefined() else None
    if not base:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = Path(tempfile.mkdtemp(prefix="listloom-shared-")).as_uri()
        sc.setCheckpointDir(base)
    folder = f"{base.rstrip('/')}/listloom-{uuid.uuid4().hex}"
    if sc.applicationId not in _made:
        _made[sc.applicationId] = []
        atexit.register(_clean, spark, sc.applicationId)
    _made[sc.applicationId].append(folder)
    return folder


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.sc().hadoopConfiguration()).delete(path, True)


def _clean(spark: SparkSession, application: str) -> None:
    try:
        for folder in _made.pop(application, []):
            delete(spark, folder)
    except Exception:  # noqa: BLE001  the JVM may have ended first
        pass


def stored(df: DataFrame, folder: str | None = None) -> DataFrame:
    """df, written as a table in the shared folder and read again: lineage ends there and survives lost executors."""
    spark = df.sparkSession
    path = folder or shared_folder(spark)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
