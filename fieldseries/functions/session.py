"""Sending this package to the executors, and tables that outlive them."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Add the package to the application's Python files once, so that tasks can import it wherever they run."""
    app = spark.sparkContext.applicationId
    if app not in _sent:
        root = Path(__file__).resolve().parents[2]
        to = Path(tempfile.mkdtemp(prefix="fieldseries-"))
        shutil.copytree(root / "fieldseries", to / "src" / "fieldseries", ignore=shutil.ignore_patterns("__pycache__"))
        spark.sparkContext.addPyFile(shutil.make_archive(str(to / "fieldseries"), "zip", to / "src"))
        _sent.add(app)
    return spark


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written to the folder that driver and executors share (spark.checkpoint.dir) and read again: what follows starts from files that survive lost
    executors. Where the setting is unset, a temporary folder serves a local session."""
    spark = df.sparkSession
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        where = found.get() if found.isDefined() else None
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(where)
    path = f"{where.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
