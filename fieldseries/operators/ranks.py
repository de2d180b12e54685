"""Ranks and exact percentiles at any size: rows are sorted by range over many tasks, and each part counts on from the parts before it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from fieldseries.functions.session import kept

#: Distinct values of a group that one task may sort; a table with a larger group is sorted by range over many.
ONE_TASK = 2_000_000


def numbered(df: DataFrame, order: list[Column], keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Append __part and __place: df sorted by range, part by part, and within a part from 0. keep writes the rows and reads them again, as another
    run of the same plan could cut the ranges elsewhere. Rows that agree in all of order lie in one part: order by something that tells rows apart."""
    at = F.monotonically_increasing_id()  # the part's number above 33 bits of the row's place in it
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", at)
    return keep(placed.withColumns({"__part": F.shiftright("__at", 33), "__place": F.col("__at").bitwiseAND(2**33 - 1)}).drop("__at"))


def ranked(df: DataFrame, order: list[Column], name: str, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Append name: the row's rank from 1 over the whole table. No task sees more than its range of rows; only a row per part is added up in one place."""
    placed = numbered(df, order, keep)
    parts = placed.groupBy("__part").agg(F.count("*").alias("__n"))
    before = parts.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    return placed.join(F.broadcast(before), "__part").withColumn(name, F.col("__before") + F.col("__place") + 1).drop("__part", "__place", "__before")


def percentiles(df: DataFrame, keys: list[str], value: str, cuts: list[float], one_task: int = ONE_TASK) -> DataFrame:
    """keys, n, n_rows, p (array of the exact percentiles, linear between neighbours, of the n non-null values of n_rows rows; nulls for a group without any). Keys may be null, or none
    at all; an empty table gives no row.

    Equal values of a group are counted together before anything is sorted, so ties never crowd. The counts are written down; where a group has more
    distinct values than one task may sort, they are sorted by range over (keys, value), and each part takes its start from the parts before it.
    """
    made = df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(value).cast("double").alias("__v")).agg(F.count(value).alias("__n"), F.count("*").alias("__m"))  # no value counts 0
    by = [f"__k{i}" for i in range(len(keys))]
    seen = Observation()
    held = kept(made.observe(seen, F.count(F.lit(1)).alias("rows")), "value-counts")
    # All groups together may be small enough; if not, the largest is looked at.
    if seen.get.get("rows", 0) > one_task and held.groupBy(*by).count().agg(F.max("count")).first()[0] > one_task:
        held = numbered(held, [*map(F.col, by), F.col("__v")], lambda x: kept(x, "value-ranges"))
        sums = held.groupBy(*by, "__part").agg(F.sum("__n").alias("__in"))
        over = Window.partitionBy(*by).orderBy("__part")
        starts = sums.select(*[F.col(b).alias(f"{b}s") for b in by], F.col("__part").alias("__parts"), (F.sum("__in").over(over) - F.col("__in")).alias("__before"), F.sum("__in").over(Window.partitionBy(*by)).alias("__all"))
        same = F.col("__part") == F.col("__parts")
        for b in by:
            same = same & F.col(b).eqNullSafe(F.col(f"{b}s"))
        held = held.join(starts, same)
        up_to = F.col("__before") + F.sum("__n").over(Window.partitionBy(*by, "__part").orderBy("__v"))
    else:
        held = held.withColumn("__all", F.sum("__n").over(Window.partitionBy(*by)))
        up_to = F.sum("__n").over(Window.partitionBy(*by).orderBy("__v"))
    ranked_values = held.withColumn("__to", up_to)
    at = lambda place: F.max(F.when((F.col("__to") - F.col("__n") <= place) & (place < F.col("__to")), F.col("__v")))
    spots = [(F.col("__all") - 1) * F.lit(float(q)) for q in cuts]
    picks = [c for i, s in enumerate(spots) for c in (at(F.floor(s)).alias(f"__a{i}"), at(F.ceil(s)).alias(f"__b{i}"))]
    found = ranked_values.groupBy(*by).agg(F.max("__all").alias("__all"), F.sum("__m").alias("n_rows"), *picks)
    between = [F.col(f"__a{i}") + (F.col(f"__b{i}") - F.col(f"__a{i}")) * (s - F.floor(s)) for i, s in enumerate(spots)]
    return found.where("__all IS NOT NULL").select(*[F.col(b).alias(k) for b, k in zip(by, keys, strict=True)], F.col("__all").alias("n"), "n_rows", F.array(*between).alias("p"))
