"""Scene catalogue: deduplication, retention and availability over a calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldseries.functions.columns import half_even, month, tile_pair


def retained(scenes: DataFrame, least: float = 0.01) -> DataFrame:
    """Scenes of at least that valid fraction (missing fractions are left out), with their month and eight-digit date."""
    return scenes.where(F.col("f_valid_aoi") >= least).withColumns({"mois": month(F.col("date")), "date8": F.date_format("date", "yyyyMMdd")})


def dedup_latest(scenes: DataFrame, keys: list[str], order: str = "scene_id") -> DataFrame:
    """The row of the greatest name (as text) for each key: a partial aggregate, not a sort of every group."""
    rest = [c for c in scenes.columns if c not in keys]
    best = scenes.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("b"))
    return best.select(*keys, "b.*").select(*scenes.columns)


def first_nonnull(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of each column the first non-null value by the descending order (ties: the other order columns)."""
    rank = F.struct(*[F.col(c) for c in order])
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(c) for c in rest])


def daily(scenes: DataFrame) -> DataFrame:
    """Scenes per day, and whether both strips occur."""
    return scenes.groupBy("date").agg(F.count("*").alias("n_scenes"), (F.bool_or(F.col("pair") == "nord") & F.bool_or(F.col("pair") == "sud")).alias("complet"))


def every_day(daily_: DataFrame, first: str, last: str) -> DataFrame:
    """Every day of a window, both ends included, with its scenes (0) and whether it is full (false)."""
    days = daily_.sparkSession.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date"))
    return days.join(daily_, "date", "left").select("date", F.coalesce("n_scenes", F.lit(0)).alias("n_scenes"), F.coalesce("complet", F.lit(False)).alias("complet"))


def strips(north: DataFrame, south: DataFrame) -> DataFrame:
    """Two series of days side by side, false where a day is missing in one."""
    one = lambda df, name: df.select("date").distinct().withColumn(name, F.lit(True))
    both = one(north, "nord").join(one(south, "sud"), "date", "full")
    return both.select("date", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("nord", "sud")])


def selected(scenes: DataFrame, tiles: list[str], first: str, last: str, pairs: dict[str, str]) -> DataFrame:
    """Scenes of some tiles and days (both ends included) with their strip, by time and tile. The filters reach the scan."""
    found = scenes.where(F.col("tile_id").isin(tiles) & F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return found.withColumn("pair", tile_pair(F.col("tile_id"), pairs)).orderBy("date", "tile_id", "scene_id")


def scenes_by_orbit(scenes: DataFrame) -> DataFrame:
    """Scenes per tile, strip and orbit."""
    return scenes.groupBy("tile_id", "pair", "orbit_relative").agg(F.count("*").alias("n"))


def repeated_days(scenes: DataFrame) -> DataFrame:
    """Tiles and dates with more than one scene."""
    return scenes.groupBy("tile_id", "date").agg(F.count("*").alias("n")).where("n > 1")


def monthly_availability(scenes: DataFrame) -> DataFrame:
    """Per month between the first and the last seen (empty ones as zeros): scenes, days with any, full days, and shares of the calendar month."""
    seen = daily(scenes)
    bounds = seen.agg(F.trunc(F.min("date"), "month").alias("lo"), F.trunc(F.max("date"), "month").alias("hi"))
    months = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("m"))
    sums = seen.groupBy(F.trunc("date", "month").alias("m")).agg(F.sum("n_scenes").alias("n_scenes"), F.count("*").alias("n_jours"), F.count_if("complet").alias("n_jours_complets"))
    length = F.day(F.last_day("m"))
    zero = {c: F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n_scenes", "n_jours", "n_jours_complets")}
    made = months.join(sums, "m", "left").select("m", *zero.values())
    return made.select(month(F.col("m")).alias("mois"), *zero, length.alias("jours_mois"), half_even(100 * F.col("n_jours") / length, 1).alias("pct_jours"), half_even(100 * F.col("n_jours_complets") / length, 1).alias("pct_complets"))


def window_totals(scenes: DataFrame, first: str, last: str) -> DataFrame:
    """Days of the window (both ends included), days with a scene, their share."""
    covered = scenes.where(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))).agg(F.count_distinct("date").alias("n_couverts"))
    n = F.datediff(F.lit(last).cast("date"), F.lit(first).cast("date")) + 1
    return covered.select(n.alias("n_jours"), "n_couverts", half_even(100 * F.col("n_couverts") / n, 1).alias("pct"))


def orbits_per_tile(scenes: DataFrame) -> DataFrame:
    """A10: sorted distinct orbits of each tile, joined by commas."""
    return scenes.groupBy("tile_id").agg(F.array_join(F.sort_array(F.collect_set("orbit_relative")), ",").alias("orbites"))


def keep_first(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of each key the first row by the named columns, and its rang (1); the order must tell rows apart for equal results."""
    return rows.withColumn("rang", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("rang = 1")
