"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups (rows with one key) are sorted by size; each enters the bin with the tightest remaining capacity that holds it, found
in a balanced tree of open bins. One task cannot hold the groups of a large corpus, so packing has two levels: every
task packs its share of the groups into bundles of a fixed capacity, then the bundles - whose number is bounded by
`bundles`, not by the corpus - are packed into shards the same way.

Defined results: a null text counts as an empty one; equal texts stay in one shard; ties in size are ordered by the
group's digest; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import random
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldseries.llm.common import cut


class OpenBins:
    """Open bins by (remaining capacity, number) in a treap: a balanced search tree, its priorities seeded so that runs repeat."""

    def __init__(self) -> None:
        self.root: list | None = None  # node: [key, priority, left, right]
        self.random = random.Random(0).random

    def add(self, key: tuple[int, int]) -> None:
        small, large = self._split(self.root, key)
        self.root = self._join(self._join(small, [key, self.random(), None, None]), large)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least remaining capacity of at least size; the lowest number among equals."""
        small, large = self._split(self.root, (size, -1))
        if large is None:
            self.root = small
            return None
        path, node = [], large
        while node[2] is not None:
            path.append(node)
            node = node[2]
        if path:
            path[-1][2] = node[3]
        else:
            large = node[3]
        self.root = self._join(small, large)
        return node[0]

    @staticmethod
    def _split(node: list | None, key: tuple[int, int]) -> tuple[list | None, list | None]:
        """The nodes below key, and the others."""
        ends = [None, None, None, None]  # 2: where the next large part goes, 3: the next small one
        small, large = ends, ends
        while node is not None:
            if node[0] < key:
                small[3], small, node = node, node, node[3]
            else:
                large[2], large, node = node, node, node[2]
        small[3], large[2] = None, (None if large is not ends else ends[2])
        if small is ends:
            ends[3] = None
        return ends[3], ends[2]

    @classmethod
    def _join(cls, a: list | None, b: list | None) -> list | None:
        """Every key of a is below every key of b."""
        top = [None, None, None, None]
        at, side = top, 2
        while a is not None and b is not None:
            if a[1] > b[1]:
                at[side], at, side, a = a, a, 3, a[3]
            else:
                at[side], at, side, b = b, b, 2, b[2]
        at[side] = a if a is not None else b
        return top[2]


def best_fit(sizes: Iterable[int], capacity: int) -> Iterator[int]:
    """The bin of each size, which come in descending order. A size above the capacity gets a bin of its own."""
    tree, bins = OpenBins(), 0
    for size in sizes:
        found = tree.take(size)
        if found is None:
            left, number = max(0, capacity - size), bins
            bins += 1
        else:
            left, number = found[0] - size, found[1]
        if left > 0:
            tree.add((left, number))
        yield number


def least_capacity(sizes: list[int], bins: int) -> int:
    """The least capacity found by bisection with which best fit decreasing needs no more than so many bins."""
    low = max([1, *sizes[:1], -(-sum(sizes) // bins)])
    high = max(low, 2 * low)
    while max(best_fit(sizes, high), default=0) >= bins:
        high *= 2
    while low < high:
        mid = (low + high) // 2
        if max(best_fit(sizes, mid), default=0) < bins:
            high = mid
        else:
            low = mid + 1
    return high


def pack(groups: DataFrame, capacity: int | None = None, shards: int | None = None, bundles: int | None = None) -> DataFrame:
    """groups(key, size) -> (key, shard): few shards of the capacity, or, given a number of shards, the least capacity found for it.

    bundles bounds what the driver packs: a bundle takes total / bundles bytes, so at most 2 * bundles + tasks of them arise. It grows with the
    groups, from 4096 to 65536. Where the capacity is no larger than a bundle, tasks pack the shards themselves, and each task may leave one
    part-filled shard beyond what one packing of all groups would need.
    """
    spark = groups.sparkSession
    if (capacity is None) == (shards is None):
        raise ValueError("give a capacity or a number of shards")
    total, n = groups.agg(F.sum("size"), F.count("*")).first()
    total = total or 0
    bundles = bundles or min(65_536, max(4096, n // 20_000))
    room = max(1, total // bundles)
    single = capacity is not None and capacity <= room  # then the tasks' bins are the shards
    room = capacity if single else room
    parts = int(min(bundles // 8, max(1, n // 2000)))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, sizes = TaskContext.get().partitionId(), []
        kept: list[pd.DataFrame] = []

        def stream() -> Iterator[int]:
            for pdf in (x for x in frames if len(x)):
                kept.append(pdf[["key"]])
                sizes.append(len(pdf))
                yield from pdf["size"].tolist()

        done, pending = [], 0
        for b in best_fit(stream(), room):
            done.append(b)
            pending += 1
            if pending == sizes[0]:
                sizes.pop(0)
                yield kept.pop(0).assign(bundle=[part * 2**32 + x for x in done])
                done, pending = [], 0

    keyed = groups.select("key", F.col("size").cast("long").alias("size"))
    in_bundles = keyed.repartition(parts, "key").sortWithinPartitions(F.desc("size"), "key").mapInPandas(run, "key " + dict(groups.dtypes)["key"] + ", bundle long")
    placed = cut(in_bundles, "bundles")
    if single:
        part = F.shiftright("bundle", 32).alias("part")
        counts = placed.groupBy(part).agg((F.max(F.col("bundle").bitwiseAND(2**32 - 1)) + 1).alias("n")).orderBy("part").collect()
        starts = [(r["part"], sum(x["n"] for x in counts[:i])) for i, r in enumerate(counts)]
        offsets = F.broadcast(spark.createDataFrame(starts, "part long, start long"))
        return placed.withColumn("part", part).join(offsets, "part").select("key", (F.col("start") + F.col("bundle").bitwiseAND(2**32 - 1)).cast("int").alias("shard"))
    sums = placed.join(keyed, "key").groupBy("bundle").agg(F.sum("size").alias("size")).orderBy(F.desc("size"), "bundle").collect()
    sizes = [r["size"] for r in sums]
    if shards is not None:
        capacity = least_capacity(sizes, shards)
    table = [(r["bundle"], s) for r, s in zip(sums, best_fit(sizes, capacity), strict=True)]
    return placed.join(F.broadcast(spark.createDataFrame(table, "bundle long, shard int")), "bundle").select("key", "shard")


def slots(df: DataFrame, shard: str, order: list[str], rows_per_block: int = 50_000) -> DataFrame:
    """Append slot: gapless from 0 in each shard, in blocks by a hash of the order columns and within them by these; rows that agree in all of them may change
    places. Blocks of a shard start where the blocks before end, so no task numbers more than a block (rows that agree in all order columns share one)."""
    n = df.count()
    blocks = max(1, n // rows_per_block)
    df = df.withColumn("__shard_block", F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
    counts = df.groupBy(shard, "__shard_block").agg(F.count("*").alias("__shard_n"))
    starts = counts.withColumn("__shard_start", F.sum("__shard_n").over(Window.partitionBy(shard).orderBy("__shard_block")) - F.col("__shard_n")).drop("__shard_n")
    within = F.row_number().over(Window.partitionBy(shard, "__shard_block").orderBy(*order)) - 1
    placed = df.withColumn("__shard_row", within).join(F.broadcast(starts) if blocks <= 10_000 else starts, [shard, "__shard_block"])
    return placed.withColumn("slot", (F.col("__shard_row") + F.col("__shard_start")).cast("long")).drop("__shard_block", "__shard_row", "__shard_start")


def shard_documents(df: DataFrame, shards: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, size, text_crc32, shard, slot of every row; equal texts share a shard and the shards' bytes are near equal. A text that very many rows share is one
    group and summed up before the shuffle; the join that brings its shard back is split by adaptive execution."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = cut(df.select(F.col(f"`{id}`").alias(id), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(body.cast("binary"), 256)).alias("key")), "rows")
    groups = cut(rows.groupBy("key").agg(F.sum("size").alias("size")), "groups")
    placed = rows.join(pack(groups, shards=shards), "key").drop("key")
    return slots(placed, "shard", [id, "size", "text_crc32"])
