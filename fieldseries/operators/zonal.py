"""Zonal statistics: exact moments and percentiles of pixel values per parcel."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldseries.functions.session import ship


def zonal_stats(pixels: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Mean, population std, p10 and p90 (exact, linear) of the non-null values; groups without any have no row."""
    cuts = F.percentile(value, F.array(F.lit(0.1), F.lit(0.9)))
    made = pixels.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), cuts.alias("p"))
    return made.select(*keys, "mean", "std", F.get("p", F.lit(0)).alias("p10"), F.get("p", F.lit(1)).alias("p90"))


def ordered_means(pixels: DataFrame, keys: list[str], variables: list[str], order: str) -> DataFrame:
    """Keys and the mean of each variable's non-null values, added up in a column's order: the same to the last digit however rows are dealt to tasks, which
    counts where means are rounded next. A group's values are held together (one parcel's pixels of a month)."""
    rows = pixels.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(order, *variables))).alias("__rows"))

    def mean(v: str) -> Column:
        held = F.filter(F.transform("__rows", lambda r: r[v]), lambda x: x.isNotNull())
        return F.try_divide(F.aggregate(held, F.lit(0.0), lambda acc, x: acc + x), F.size(held)).alias(v)

    return rows.select(*keys, *map(mean, variables))


#: The columns of a group's statistics.
STATS = ("mean", "std", "p10", "p90")


def _group_stats(group: np.ndarray, n_groups: int, value: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(groups with a value, their mean, population std, p10 and p90) of values whose group is given; NaN is no value."""
    some = ~np.isnan(value)
    group, value = group[some], value[some]
    n = np.bincount(group, minlength=n_groups)
    with np.errstate(invalid="ignore"):
        mean = np.bincount(group, value, n_groups) / n
        std = np.sqrt(np.bincount(group, (value - mean[group]) ** 2, n_groups) / n)
    held = np.flatnonzero(n)
    value = value[np.lexsort((value, group))]
    start, most = (np.cumsum(n) - n)[held], n[held] - 1

    def cut(q: float) -> np.ndarray:
        at = most * q
        low, high = value[start + np.floor(at).astype(np.int64)], value[start + np.ceil(at).astype(np.int64)]
        return low + (high - low) * (at - np.floor(at))

    return held, [mean[held], std[held], cut(0.1), cut(0.9)]


def zonal_stats_of(pixels: DataFrame, keys: list[str], variables: list[str]) -> DataFrame:
    """A01 over several variables (columns): keys, variable, mean, std, p10, p90, exact and linear between neighbours; a variable without values in a group has no row.

    Rows are shuffled once for all variables and sorted by key; a task then takes the groups of a batch together, column by column, and carries only the rows
    of the group that a batch may have cut (at most one parcel's pixels of a month).
    """
    ship(pixels.sparkSession)
    picked = pixels.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *[F.col(v).cast("double").alias(f"__v{i}") for i, v in enumerate(variables)])
    names, values = [f"__k{i}" for i in range(len(keys))], [f"__v{i}" for i in range(len(variables))]
    made = ["__variable", *(f"__{s}" for s in STATS)]

    def close(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks()
        starts = _starts(rows, names)
        group = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(rows)]))
        found = [_group_stats(group, len(starts), rows.column(v).to_numpy()) for v in values]
        at = pa.array(np.concatenate([starts[held] for held, _ in found]))
        which = np.repeat(np.arange(len(values), dtype=np.int32), [len(held) for held, _ in found])
        columns = [rows.column(k).combine_chunks().take(at) for k in names] + [pa.array(which)] + [pa.array(np.concatenate([f[j] for _, f in found])) for j in range(len(STATS))]
        return pa.RecordBatch.from_arrays(columns, names=[*names, *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # a closed stretch of groups, then the last one, still open
        for batch in (b for b in batches if len(b)):
            cut = int(_starts(pa.Table.from_batches([batch]), names)[-1])
            if held and _starts(pa.Table.from_batches([held[-1].slice(len(held[-1]) - 1), batch.slice(0, 1)]), names)[-1]:
                yield close(held)
                held = []
            if cut:
                yield close([*held, batch.slice(0, cut)])
                held = []
            held.append(batch.slice(cut))
        if held:
            yield close(held)

    types = dict(picked.dtypes)
    out = picked.repartition(*names).sortWithinPartitions(*names).mapInArrow(run, ", ".join([*(f"{k} {types[k]}" for k in names), "__variable int", *(f"__{s} double" for s in STATS)]))
    named = F.element_at(F.array(*map(F.lit, variables)), F.col("__variable") + 1).alias("variable")
    return out.select(*[F.col(n).alias(k) for n, k in zip(names, keys, strict=True)], named, *[F.col(f"__{s}").alias(s) for s in STATS])


def _starts(rows: pa.Table, names: list[str]) -> np.ndarray:
    """Where a new key begins, in rows sorted by key; null is a key like any other."""
    new = np.zeros(len(rows), bool)
    new[:1] = True
    for n in names:
        codes = pc.fill_null(rows.column(n).combine_chunks().dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def completeness(counts: DataFrame, keys: list[str], n: str = "n_valid") -> DataFrame:
    """Mean count of valid dates and share of pixels with any, in percent; pixels with none count as 0."""
    return counts.groupBy(*keys).agg(F.avg(n).alias("n_dates_valides_moy"), (100 * F.avg((F.col(n) > 0).cast("int"))).alias("pct_pixels_couverts"))


def stats_by_date(pixels: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Mean, population std and number of valid pixels."""
    return pixels.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.count("*").cast("int").alias("n_pixels"))


def without_pixels(parcels: DataFrame, stats: DataFrame, id: str, area: str) -> DataFrame:
    """How many parcels have no pixel, their share and their area, in one row."""
    held = parcels.join(stats.select(id).distinct().withColumn("__held", F.lit(1)), id, "left")
    gone = F.col("__held").isNull()
    return held.agg(F.count_if(gone).alias("n_absent"), (100 * F.avg(gone.cast("int"))).alias("pct_absent"), F.sum(F.when(gone, F.col(area)).otherwise(0.0)).alias("area_absent"))
