"""Joins of geometries by the cells they cover, and tables laid out so that a box reads few files."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldseries.operators import geo, ringsets

BOX = ("xmin", "ymin", "xmax", "ymax")
#: Left rows of one cell beyond which it is dealt over pieces.
CROWDED = 10_000
#: Crowded cells of more rows than this are joined by a shuffle.
BROADCAST_ROWS = 100_000


def cell_size(*tables: DataFrame) -> float:
    """The side of the cells: doubled from the mean extent until all rows of the tables together cover few cells each. One row a table comes to the driver."""
    n = wide = cover = 0.0
    for t in tables:
        w, h = F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")
        row = t.agg(F.count("*"), F.sum(w + h), F.sum(w * h)).first()
        n, wide, cover = n + row[0], wide + (row[1] or 0.0), cover + (row[2] or 0.0)
    size = max(1e-6, wide / max(1.0, n))
    while cover / size**2 + wide / size > 4 * n + 1000:
        size *= 2
    return size


def _cells(size: float) -> Column:
    at = lambda c: F.floor(F.col(c) / size)
    across = F.transform(F.sequence(at("xmin"), at("xmax")), lambda i: F.transform(F.sequence(at("ymin"), at("ymax")), lambda j: F.struct(i.alias("i"), j.alias("j"))))
    return F.explode(F.flatten(across))


def spatial_join(left: DataFrame, right: DataFrame, condition: Column, size: float | None = None, crowded: int = CROWDED) -> DataFrame:
    """Pairs of rows whose boxes meet and for which the condition holds (an inner join; a row with a null box has no partner).

    Both sides have columns xmin, ymin, xmax, ymax, which come from the left side, and no other names in common. Rows go to the cells their boxes cover
    and meet by cell; of the cells that a pair shares only the one with the lower left corner of the common box counts, so no pair comes twice. A cell of more than
    `crowded` left rows is dealt over pieces, to each of which its right rows go.
    """
    size = size or cell_size(left, right)
    whole = lambda t: t.where(" AND ".join(f"{c} IS NOT NULL" for c in BOX))
    a = whole(left).withColumn("__cell", _cells(size))
    b = whole(right).withColumn("__cell", _cells(size)).withColumnsRenamed({c: f"__{c}" for c in BOX})
    full = a.groupBy("__cell").agg(F.count("*").alias("__n")).where(F.col("__n") > crowded).select("__cell", F.ceil(F.col("__n") / crowded).cast("int").alias("__pieces"))
    several = full.limit(BROADCAST_ROWS + 1).count()
    if several:
        few = F.broadcast(full) if several <= BROADCAST_ROWS else full
        pieces = F.coalesce(F.col("__pieces"), F.lit(1))
        a = a.join(few, "__cell", "left").withColumn("__piece", F.pmod(F.xxhash64(*BOX), pieces)).drop("__pieces")
        b = b.join(few, "__cell", "left").withColumn("__piece", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1))).drop("__pieces")
    on = ["__cell", "__piece"] if several else ["__cell"]
    corner = (F.floor(F.greatest("xmin", "__xmin") / size) == F.col("__cell.i")) & (F.floor(F.greatest("ymin", "__ymin") / size) == F.col("__cell.j"))
    meet = (F.col("xmin") <= F.col("__xmax")) & (F.col("xmax") >= F.col("__xmin")) & (F.col("ymin") <= F.col("__ymax")) & (F.col("ymax") >= F.col("__ymin"))
    # The condition is dear and the rows are small: as many tasks as a shuffle has, which adaptive execution would merge by size alone.
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a, b = a.repartition(tasks, *on), b.repartition(tasks, *on)
    return a.join(b, on).where(corner & meet).where(condition).drop(*on, *[f"__{c}" for c in BOX])


def in_areas(parcels: DataFrame, areas: DataFrame, ring: str = "ring", area_ring: str = "aoi") -> DataFrame:
    """Parcels, whole, with every area that they meet (a parcel in two areas has two rows). Geometries are ring sets or single rings; parcels have
    their envelope columns. Any number of areas."""
    as_set = lambda df, c: F.array(F.col(c)) if df.schema[c].dataType.elementType.typeName() == "struct" else F.col(c)
    a, b = as_set(parcels, ring), as_set(areas, area_ring)
    boxed = areas.withColumn("__e", geo.envelope(F.flatten(b))).select("*", "__e.*").drop("__e")
    # A rectangle along the axes is its box: it need not travel, and two of them meet where their boxes do.
    left, right = parcels.withColumn("__a", F.when(~_is_box(a), a)), boxed.withColumn("__b", F.when(~_is_box(b), b))
    of_box = lambda *names: F.array(F.array(*[F.struct(F.col(names[i]).alias("x"), F.col(names[j]).alias("y")) for i, j in ((0, 1), (2, 1), (2, 3), (0, 3), (0, 1))]))
    looked_at = ringsets.intersects(F.coalesce("__a", of_box(*BOX)), F.coalesce("__b", of_box(*(f"__{c}" for c in BOX))))
    return spatial_join(left, right, F.when(F.col("__a").isNull() & F.col("__b").isNull(), True).otherwise(looked_at)).drop("__a", "__b")


def _is_box(rings: Column) -> Column:
    """Whether a ring set is one rectangle along the axes that fills the box of the envelope columns."""
    ring = F.get(rings, F.lit(0))
    p = [F.get(ring, F.lit(i)) for i in range(5)]
    turn = lambda p, q, r, s: (q["x"] == r["x"]) & (q["y"] == p["y"]) & (s["x"] == p["x"]) & (s["y"] == r["y"])
    corners = (turn(p[0], p[1], p[2], p[3]) | turn(p[0], p[3], p[2], p[1])) & (p[4] == p[0]) & (p[0]["x"] != p[2]["x"]) & (p[0]["y"] != p[2]["y"])
    ends = [(f(p[0][c], p[2][c]) == F.col(n)) for f, c, n in zip((F.least, F.least, F.greatest, F.greatest), "xyxy", BOX, strict=True)]
    return F.coalesce((F.size(rings) == 1) & (F.size(ring) == 5) & corners & ends[0] & ends[1] & ends[2] & ends[3], F.lit(False))


def z_order(x: Column, y: Column, box: tuple[float, float, float, float], bits: int = 20) -> Column:
    """The place of a point on the Z curve through a box: the bits of both coordinates in turn. Points outside take the nearest border."""
    xmin, ymin, xmax, ymax = box
    top = 2**bits - 1

    def spread(v: Column) -> Column:
        """A zero bit behind each bit. The masks of the usual bit spreading."""
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    scaled = lambda v, lo, hi: F.greatest(F.lit(0), F.least(F.lit(top), F.floor((v - lo) / max(hi - lo, 1e-9) * top))).cast("long")
    return spread(scaled(x, xmin, xmax)).bitwiseOR(F.shiftleft(spread(scaled(y, ymin, ymax)), 1))


def write_clustered(df: DataFrame, path: str, files: int | None = None, bits: int = 20) -> None:
    """Df with envelope columns as Parquet whose files, and row groups within them, each hold a compact patch: sorted by range along the Z curve of the box
    centres. The statistics of the envelope columns then let a box skip the others. The bounds of all rows are one row for the driver."""
    low = df.agg(F.min("xmin"), F.min("ymin"), F.max("xmax"), F.max("ymax")).first()
    box = tuple(0.0 if v is None else float(v) for v in low)
    keyed = df.withColumn("__z", z_order((F.col("xmin") + F.col("xmax")) / 2, (F.col("ymin") + F.col("ymax")) / 2, box, bits))
    # Equal centres share a key; the corner tells them apart, so that a crowd is not one task's.
    order = ["__z", "xmin", "ymin"]
    dealt = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).drop("__z").write.mode("overwrite").parquet(path)


def read_box(spark: SparkSession, path: str, box: tuple[float, float, float, float]) -> DataFrame:
    """The rows whose envelope meets the box; plain comparisons, which reach the Parquet statistics."""
    xmin, ymin, xmax, ymax = (float(v) for v in box)
    if any(map(math.isnan, (xmin, ymin, xmax, ymax))):
        raise ValueError("a box needs four numbers")
    return spark.read.parquet(path).where((F.col("xmin") <= xmax) & (F.col("xmax") >= xmin) & (F.col("ymin") <= ymax) & (F.col("ymax") >= ymin))
