"""Sending this package to executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Make this package importable on executors, once a context. Workers import it by name, so what it caches lives on."""
    sc = spark.sparkContext
    if getattr(sc, "_listloom_shipped", False):
        return
    top = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="listloom-")) / "listloom.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(top.rglob("*.py")):
            archive.write(path, str(path.relative_to(top.parent)))
    sc.addPyFile(str(target))  # the driver serves it to every executor
    sc._listloom_shipped = True
