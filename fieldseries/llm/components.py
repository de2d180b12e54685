"""Connected components of a table of links, by contraction.

Every round each vertex points at the one of its closed neighbourhood that a hash of vertex and round ranks lowest; links
are rewritten to those and loops and repeats drop out. The links shrink by a constant factor a round, whatever their shape (chains, stars),
and every round starts from files in the shared folder. The last LAST links, which no input makes more, are finished in one step. A vertex of very many links is summed up before the shuffle, and its
joins are split by adaptive execution. Labels are composed backwards at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldseries.llm.common import cut, drop_cut


#: A task of a round works on about so many links; a round has at least so many tasks.
LINKS, TASKS = 200_000, 8
#: Rounds end when so few links are left: a fixed number, so the step that finishes them does not grow with the input.
LAST = 1000


def finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(a, b) of all of at most LAST links -> (a, to): every vertex and one vertex that stands for its component."""
    to: dict[int, int] = {}

    def root(v: int) -> int:
        while to.setdefault(v, v) != v:
            to[v] = v = to[to[v]]
        return v

    for links in frames:
        for a, b in zip(links["a"].tolist(), links["b"].tolist(), strict=True):
            to[root(a)] = root(b)
    yield pd.DataFrame({"a": list(to), "to": [root(v) for v in to]}, dtype="int64")


def components(links: DataFrame) -> DataFrame:
    """links(a long, b long) -> (id, component): the smallest id reachable, for every id that occurs in a link."""
    work = cut(links.select("a", "b").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    steps: list[DataFrame] = []
    while (n := work.count()) > LAST:
        tasks = max(TASKS, n // LINKS)  # as the links shrink, so do the files of a round
        rank = lambda c: F.struct(F.xxhash64(F.lit(len(steps)), c), F.col(c).alias("v"))
        both = work.select("a", "b").union(work.select(F.col("b"), F.col("a")))
        points = both.groupBy("a").agg(F.min(rank("b")).alias("low")).select("a", F.least(F.col("low"), rank("a"))["v"].alias("to"))
        step = cut(points.coalesce(tasks), "points")
        steps.append(step)
        moved = work.join(step.withColumnRenamed("to", "x"), "a").select("x", "b").join(step.select(F.col("a").alias("b"), F.col("to").alias("y")), "b")
        less = cut(moved.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct().coalesce(tasks), "links")
        drop_cut(work)
        work = less
    if n:
        steps.append(cut(work.coalesce(1).mapInPandas(finish, "a long, to long"), "points"))
    drop_cut(work)
    if not steps:
        return links.select(F.col("a").alias("id"), F.col("a").alias("component")).limit(0)
    label = steps[-1].select("a", "to")
    for step in reversed(steps[:-1]):
        later = label.select(F.col("a").alias("to"), F.col("to").alias("last"))
        label = step.join(later, "to", "left").select("a", F.coalesce("last", "to").alias("to"))
    label = cut(label, "labels")
    for step in steps:
        drop_cut(step)
    lowest = label.groupBy("to").agg(F.min("a").alias("component"))
    return label.join(lowest, "to").select(F.col("a").alias("id"), "component")
