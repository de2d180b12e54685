"""Incremental merges into a table of buckets: a batch rewrites only the buckets that its keys fall into.

    target/data/<folder>/bucket=<n>/*.parquet   rows whose keys hash to bucket n, as some batch left them
    target/manifests/<number>.json              which folder holds each bucket, and the last batch of every stream

A manifest is written beside its place and renamed to it, so a version is there as a whole or not at all; the rename fails where another writer was first.
A batch lost between its data and its manifest leaves a folder that no manifest names: the batch runs again, and expire() removes the folder.
One writer at a time: two that merge at once do not lose rows, but the later one raises.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from fieldseries.operators.sinks import last_of, upsert


@dataclass(frozen=True)
class Manifest:
    """One version: buckets maps a bucket's number to its folder under data, streams a stream to its last batch."""

    number: int
    keys: list[str]
    n_buckets: int
    schema: str
    buckets: dict[str, str] = field(default_factory=dict)
    streams: dict[str, int] = field(default_factory=dict)


class Store:
    """The files of one table, on whatever file system its path names."""

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target = spark, target.rstrip("/")
        self.path = lambda name: spark._jvm.org.apache.hadoop.fs.Path(f"{self.target}/{name}")
        self.fs = self.path("data").getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def numbers(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.names("manifests") if n.endswith(".json") and n[0] != "."]

    def manifest(self, number: int) -> Manifest:
        stream = self.fs.open(self.path(f"manifests/{number:09d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Manifest(**json.loads(text))

    def latest(self) -> Manifest | None:
        have = self.numbers()
        return self.manifest(have[-1]) if have else None

    def commit(self, made: Manifest) -> None:
        draft, place = self.path(f"manifests/.{uuid.uuid4().hex}"), self.path(f"manifests/{made.number:09d}.json")
        out = self.fs.create(draft, False)
        out.write(bytearray(json.dumps(made.__dict__).encode()))
        out.close()
        if self.fs.exists(place) or not self.fs.rename(draft, place):
            self.fs.delete(draft, False)
            raise RuntimeError(f"version {made.number} of {self.target} was written by another")

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def read(spark: SparkSession, target: str, number: int | None = None) -> DataFrame | None:
    """The table as the latest version, or an earlier one that has not expired, has it; None before the first."""
    store = Store(spark, target)
    m = store.latest() if number is None else store.manifest(number)
    return None if m is None else _rows(spark, store, m, m.buckets)


def _rows(spark: SparkSession, store: Store, m: Manifest, buckets: dict[str, str]) -> DataFrame:
    schema = StructType.fromJson(json.loads(m.schema))
    if not buckets:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{store.target}/data/{folder}/bucket={b}" for b, folder in sorted(buckets.items(), key=lambda x: int(x[0]))])


def merge(spark: SparkSession, target: str, new: DataFrame, keys: list[str], buckets: int = 256, how: Callable[[DataFrame, DataFrame, list[str]], DataFrame] = upsert, stream: str = "", batch: int | None = None, before_commit: Callable[[], None] = lambda: None) -> int:
    """New rows (one a key) merged by `how` into their buckets, whose old rows alone are read; the number of the version after it.

    The number of buckets is fixed by the first merge: choose it so that a bucket of the full table is some hundred MB. A batch that its stream has
    merged before changes nothing. Which buckets are touched (no more than there are) comes to the driver, rows do not.
    """
    store = Store(spark, target)
    old = store.latest()
    if old and batch is not None and old.streams.get(stream, -1) >= batch:
        return old.number
    if old and old.keys != keys:
        raise ValueError(f"the table's keys are {old.keys}")
    n = old.n_buckets if old else buckets
    schema = StructType.fromJson(json.loads(old.schema)) if old else new.schema
    if sorted(new.columns) != sorted(schema.names):
        raise ValueError(f"the table's columns are {schema.names}")
    bucket = F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")
    new = new.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    touched = {str(r[0]) for r in new.select(bucket).distinct().collect()}
    folder, held = f"{uuid.uuid4().hex}", {b: f for b, f in (old.buckets if old else {}).items() if b in touched}
    made = how(_rows(spark, store, old, held), new, keys) if held else new
    if touched:
        # A bucket's rows go to one task; the buckets are many and each is a bounded part of the table.
        made.withColumn("bucket", bucket).repartition("bucket").write.partitionBy("bucket").parquet(f"{store.target}/data/{folder}")
    before_commit()
    written = {b: folder for b in touched if store.fs.exists(store.path(f"data/{folder}/bucket={b}"))}
    kept = {b: f for b, f in (old.buckets if old else {}).items() if b not in touched}
    streams = (old.streams if old else {}) | ({stream: batch} if batch is not None else {})
    number = old.number + 1 if old else 0
    store.commit(Manifest(number, keys, n, schema.json(), kept | written, streams))
    return number


def expire(spark: SparkSession, target: str, keep: int = 2) -> int:
    """Remove all but the last `keep` versions and the data that none of them names; how many folders went. A bucket's folder within a written folder goes
    as soon as no kept version has it. Not while a merge runs: its data have no version yet."""
    store = Store(spark, target)
    numbers = store.numbers()
    kept = [store.manifest(n) for n in numbers[-keep:]]
    named = {(f, b) for m in kept for b, f in m.buckets.items()}
    for n in numbers[:-keep]:
        store.remove(f"manifests/{n:09d}.json")
    gone = 0
    for folder in store.names("data"):
        parts = [p for p in store.names(f"data/{folder}") if p.startswith("bucket=")]
        unused = [p for p in parts if (folder, p.removeprefix("bucket=")) not in named]
        for p in [f"data/{folder}"] if len(unused) == len(parts) else [f"data/{folder}/{p}" for p in unused]:
            store.remove(p)
            gone += 1
    return gone


def start(spark: SparkSession, source: str, schema: StructType, target: str, keys: list[str], checkpoint: str, buckets: int = 256, order: list[str] | None = None, keep: int = 2) -> StreamingQuery:
    """Available files, one batch after another, merged into the buckets of their keys. Of rows with one key in a batch the greatest by `order` counts."""
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def load(batch: DataFrame, number: int) -> None:
        merge(spark, target, last_of(batch, keys, order), keys, buckets, stream=stream, batch=number)
        expire(spark, target, keep)

    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source).writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
