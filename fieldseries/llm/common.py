"""Helpers shared by the training-data operators: table access, cut points, batch loops."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

#: Words are runs of anything but ASCII white space.
WORD_CLASS = r"[^\x20\x09-\x0D]+"
#: Texts are worked on in chunks of about so many bytes inside a task; a longer text is a chunk of its own.
CHUNK_BYTES = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a temporary one serves a local session only."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        jsc = spark.sparkContext._jsc.sc().getCheckpointDir()
        where = jsc.get() if jsc.isDefined() else None
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it again: later stages start from files that survive lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def drop_cut(df: DataFrame) -> None:
    """Remove what cut() wrote, once nothing reads it any more."""
    path = getattr(df, "_cut_path", None)
    if path:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores in front until no column has it."""
    while name in df.columns:
        name = "_" + name
    return name


def set_aside(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """df with all columns under names by their position, and these names by the old ones: what an operator adds cannot clash. toDF(*columns) undoes it."""
    names = {c: f"__own{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def drop_cuts(*dfs: DataFrame) -> None:
    for df in dfs:
        drop_cut(df)


def chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, length) of runs of rows of about CHUNK_BYTES of text each."""
    if len(texts):
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        number = np.maximum(ends - 1, 0) // CHUNK_BYTES
        starts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]]).tolist()
        yield from ((a, b - a) for a, b in zip(starts, [*starts[1:], len(texts)], strict=True))


def by_text(df: DataFrame, fn: Callable[[list[str | None]], pd.DataFrame], schema: str, keys: list[str], text: str = "text") -> DataFrame:
    """Append fn's columns to the key columns of every row. fn gets the texts of a chunk of rows (None: null) and returns a frame with as many rows.

    Rows come as Arrow batches; only the text of one chunk at a time becomes Python objects, and its result leaves at once. Keys stay in
    Arrow, so the text itself may be among them and is sent once.
    """
    extra = [(f.name, to_arrow_type(f.dataType)) for f in StructType.fromDDL(schema)]
    others = [k for k in keys if k != text]
    picked = df.select(F.col(f"`{text}`").alias("__text"), *[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(others)])
    held = ["__text"] * (text in keys) + [f"__k{i}" for i in range(len(others))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("__text")
            for start, n in chunks(texts):
                made = fn(texts.slice(start, n).to_pylist())
                columns = [batch.column(h).slice(start, n) for h in held] + [pa.array(made[c], kind, from_pandas=True) for c, kind in extra]
                yield pa.RecordBatch.from_arrays(columns, names=[*held, *(f"__m{i}" for i in range(len(extra)))])

    types = dict(picked.dtypes)
    made = [f"__m{i} {f.dataType.simpleString()}" for i, f in enumerate(StructType.fromDDL(schema))]
    out = picked.mapInArrow(run, ", ".join([*(f"`{h}` {types[h]}" for h in held), *made]))
    names = {k: f"__k{i}" for i, k in enumerate(others)} | {text: "__text"}
    return out.select(*[F.col(names[k]).alias(k) for k in keys], *[F.col(f"__m{i}").alias(c) for i, (c, _) in enumerate(extra)])
