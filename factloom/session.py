"""Session helpers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    home = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="factloom-code-")  # the driver serves it as long as it lives
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/{home.name}.zip", "w") as z:
        for p in home.rglob("*.py"):
            z.write(p, p.relative_to(home.parent))
    spark.sparkContext.addPyFile(z.filename)
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
