"""Incremental loading: a file stream whose batches are merged into a versioned Parquet table.

A version's folder names its number, its stream (the checkpoint) and its batch. A batch that a stream runs again after a loss finds its complete version
and writes nothing; a folder without Spark's success mark is no version and is written anew; a stream with a new checkpoint goes on from the latest version.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from fieldseries.operators.sinks import last_of, upsert

VERSION = re.compile(r"v(\d{9})-([0-9a-f]{12})-(\d+)")


def versions(spark: SparkSession, target: str) -> list[tuple[int, str, int, str]]:
    """(number, stream, batch, path) of the complete versions, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if (m := VERSION.fullmatch(name)) and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found.append((int(m[1]), m[2], int(m[3]), f"{target}/{name}"))
    return sorted(found)


def current(spark: SparkSession, target: str) -> DataFrame | None:
    """The latest complete version; None before the first."""
    have = versions(spark, target)
    return spark.read.parquet(have[-1][3]) if have else None


def start(spark: SparkSession, source: str, schema: StructType, target: str, keys: list[str], checkpoint: str, merge: Callable[[DataFrame, DataFrame, list[str]], DataFrame] = upsert, order: list[str] | None = None) -> StreamingQuery:
    """Available files, one batch after another. Of rows with one key in a batch the greatest by `order` counts."""
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def load(batch: DataFrame, number: int) -> None:
        have = versions(spark, target)
        if any((s, b) == (stream, number) for _, s, b, _ in have):
            return
        new = last_of(batch, keys, order)
        made = merge(spark.read.parquet(have[-1][3]), new, keys) if have else new
        made.write.mode("overwrite").parquet(f"{target}/v{have[-1][0] + 1 if have else 0:09d}-{stream}-{number}")  # overwrites only what had not been completed

    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source).writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
