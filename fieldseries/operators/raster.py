"""Grids, labels and overlays: rasters as long tables of cells (row, col), counted from the grid's upper left corner."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldseries.functions.session import ship
from fieldseries.operators import geo, ringsets


@dataclass(frozen=True)
class Grid:
    """Bounds snapped outwards to the resolution."""

    xmin: float
    ymin: float
    xmax: float
    ymax: float
    res: float = 20.0

    @classmethod
    def around(cls, xmin: float, ymin: float, xmax: float, ymax: float, res: float = 20.0) -> Grid:
        down, up = (lambda v: math.floor(v / res) * res), (lambda v: math.ceil(v / res) * res)
        return cls(down(xmin), down(ymin), up(xmax), up(ymax), res)

    @classmethod
    def of(cls, rings: DataFrame, ring: str = "ring", res: float = 20.0) -> Grid:
        """The grid around all rings: four numbers come to the driver."""
        single = rings.schema[ring].dataType.elementType.typeName() == "struct"
        e = geo.envelope(F.col(ring) if single else F.flatten(ring))
        low = rings.select(e.alias("e")).agg(F.min("e.xmin"), F.min("e.ymin"), F.max("e.xmax"), F.max("e.ymax")).first()
        return cls.around(*low, res)

    @property
    def width(self) -> int:
        return round((self.xmax - self.xmin) / self.res)

    @property
    def height(self) -> int:
        return round((self.ymax - self.ymin) / self.res)

    def x(self, col: Column) -> Column:
        return self.xmin + (col + 0.5) * self.res

    def y(self, row: Column) -> Column:
        return self.ymax - (row + 0.5) * self.res


def scanlines(p: np.ndarray, q: np.ndarray, owner: np.ndarray, grid: Grid) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(owner, row, first column, last column) of the runs of cells whose centre lies inside, for the sides from p to q of many shapes at once: each row's crossings
    with a shape's sides, sorted and taken in pairs (even-odd), so a cell costs the same however many sides its shape has. A centre on a left or lower
    border counts as inside."""
    low, high = np.minimum(p[:, 1], q[:, 1]), np.maximum(p[:, 1], q[:, 1])
    # A row more on either side than the bounds ask for; the exact test follows.
    top = np.clip(np.floor((grid.ymax - high) / grid.res - 0.5), 0, grid.height).astype(np.int64)
    bottom = np.clip(np.ceil((grid.ymax - low) / grid.res - 0.5), -1, grid.height - 1).astype(np.int64)
    count = np.maximum(bottom - top + 1, 0)
    side = np.repeat(np.arange(len(p)), count)
    row = np.repeat(top, count) + np.arange(len(side)) - np.repeat(np.cumsum(count) - count, count)
    y = grid.ymax - (row + 0.5) * grid.res
    met = (p[side, 1] > y) != (q[side, 1] > y)
    side, row, y = side[met], row[met], y[met]
    a, b = p[side], q[side]
    x = (b[:, 0] - a[:, 0]) * (y - a[:, 1]) / (b[:, 1] - a[:, 1]) + a[:, 0]
    by = np.lexsort((x, row, owner[side]))
    who, row, x = owner[side][by][::2], row[by][::2], x[by]
    centre = lambda col: grid.xmin + (col + 0.5) * grid.res

    def first_not_left_of(edge: np.ndarray) -> np.ndarray:
        col = np.ceil((edge - grid.xmin) / grid.res - 0.5)
        col = np.where(centre(col - 1) >= edge, col - 1, col)
        return np.where(centre(col) < edge, col + 1, col)

    first, last = np.maximum(first_not_left_of(x[::2]), 0), np.minimum(first_not_left_of(x[1::2]) - 1, grid.width - 1)
    some = first <= last
    return who[some], row[some], first[some].astype(np.int64), last[some].astype(np.int64)


def runs_within(shapes: DataFrame, grid: Grid, rings: str = "rings") -> DataFrame:
    """Every row of shapes, without its geometry (a ring set or one ring), for each run of cells inside: row, first and last column."""
    ship(shapes.sparkSession)

    @F.arrow_udf("array<struct<row:int,first:int,last:int>>")
    def scan(values: pa.Array) -> pa.Array:
        who, *columns = scanlines(*ringsets.all_sides(values), grid)
        ends = np.searchsorted(who, np.arange(len(values) + 1))
        made = pa.StructArray.from_arrays([pa.array(c.astype(np.int32)) for c in columns], names=["row", "first", "last"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), made)

    single = shapes.schema[rings].dataType.elementType.typeName() == "struct"
    given = F.array(F.col(rings)) if single else F.col(rings)
    others = [c for c in shapes.columns if c != rings]
    # Explicit runs are cheap rows; cells follow from them after the shuffle-free explode.
    return shapes.where(F.col(rings).isNotNull()).select(*others, F.inline(scan(given)))


def cells_within(shapes: DataFrame, grid: Grid, rings: str = "rings") -> DataFrame:
    """Every row of shapes, without its geometry, with the cells (row, col) whose centre lies inside."""
    runs = runs_within(shapes, grid, rings)
    return runs.withColumn("col", F.explode(F.sequence("first", "last"))).drop("first", "last")


#: Columns of a block: runs and pixels meet by row and block.
BLOCK = 256


def crop(pixels: DataFrame, areas: DataFrame, grid: Grid, rings: str = "rings") -> DataFrame:
    """The pixels (row, col, ...) whose centre lies in any of the areas. Runs are cut at blocks of columns and meet pixels by row and block, so neither a
    large area nor a wide row gathers in one task; a pixel in several areas stays once, and repeated pixel rows stay."""
    runs = runs_within(areas.select(rings), grid, rings)
    cut = runs.withColumn("__block", F.explode(F.sequence(F.floor(F.col("first") / BLOCK), F.floor(F.col("last") / BLOCK)))).select(F.col("row").alias("__row"), "__block", "first", "last")
    on = (F.col("row") == F.col("__row")) & (F.floor(F.col("col") / BLOCK) == F.col("__block")) & F.col("col").between(F.col("first"), F.col("last"))
    return pixels.join(cut.distinct(), on, "left_semi")


def rasterize(parcels: DataFrame, grid: Grid, label: str = "label", ring: str = "ring") -> DataFrame:
    """(row, col, label); where parcels overlap the greatest label wins, as the last drawn would. ring: one ring or a ring set."""
    return cells_within(parcels.select(label, ring), grid, ring).groupBy("row", "col").agg(F.max(label).alias(label))


def overlay(pixels: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    """Pixels (row, col, ...) with the label of their cell; cells without a parcel (no row, or label 0) drop out. Both sides partition by (row, col)."""
    return pixels.join(labels.where(F.col(label) > 0), ["row", "col"])


def not_rasterized(parcels: DataFrame, labels: DataFrame, label: str = "label", ring: str = "ring", hectares: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """(one row of counts and shares, the absent parcels above the size by falling compactness)."""
    sized = parcels.withColumn("surface_ha", geo.area(F.col(ring)) / 1e4).withColumn("perimetre_m", geo.perimeter(F.col(ring)))
    held = sized.join(labels.select(label).distinct().withColumn("__held", F.lit(True)), label, "left").withColumn("__gone", F.col("__held").isNull())
    gone = F.col("__gone").cast("int")
    lost = F.sum(F.when(F.col("__gone"), F.col("surface_ha")).otherwise(0.0))
    summary = held.agg(F.sum(gone).alias("n_absentes"), (100 * F.avg(gone)).alias("pct_absentes"), lost.alias("surface_absentes_ha"), (100 * lost / F.sum("surface_ha")).alias("pct_surface"))
    shape = F.col("perimetre_m") * F.col("perimetre_m") / (4 * F.pi() * F.col("surface_ha") * 1e4)
    large = held.where(F.col("__gone") & (F.col("surface_ha") > hectares)).withColumn("compacite", shape)
    return summary, large.drop("__held", "__gone", "perimetre_m").orderBy(F.desc("compacite"))


#: Rows and columns of a patch of pixels that one task writes.
PATCH = 512


def write_pixels(pixels: DataFrame, path: str, by: tuple[str, ...] = ("mois", "variable")) -> None:
    """The pixel table as Parquet folders by month and variable, which filters on them prune. A month's raster is dealt to tasks, and to files, by patches of
    rows and columns where it has these."""
    patch = [F.floor(F.col(c) / PATCH) for c in ("row", "col") if c in pixels.columns]
    pixels.repartition(*by, *patch).write.partitionBy(*by).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
