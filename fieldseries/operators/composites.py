"""Monthly composites of pixels: two-stage medians and coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldseries.functions.columns import half_even, month


def two_stage_median(pixels: DataFrame, pixel: list[str], date: str = "date", value: str = "value") -> DataFrame:
    """Median over tiles per pixel and date, then over dates per pixel and month; pixels never valid get NULL."""
    daily = pixels.groupBy(*pixel, date).agg(F.median(value).alias("v"))
    return daily.groupBy(*pixel, month(F.col(date)).alias("mois")).agg(F.median("v").alias("composite"))


def coverage(pixels: DataFrame, grid: DataFrame, pixel: list[str], date: str = "date") -> DataFrame:
    """Share of the grid's pixels (whole rectangle) without a valid date in each month, in percent."""
    dated = pixels.groupBy(month(F.col(date)).alias("mois"), *pixel).agg(F.count_distinct(date).alias("n")).where("n > 0")
    covered = dated.join(grid.select(*pixel).distinct(), pixel, "left_semi").groupBy("mois").agg(F.count("*").alias("covered"))
    total = grid.select(*pixel).distinct().agg(F.count("*").alias("total"))
    return covered.crossJoin(F.broadcast(total)).select("mois", half_even(100 * (F.col("total") - F.col("covered")) / F.col("total"), 1).alias("pct_pixels_0_date"))  # one row


def valid_fraction(pixels: DataFrame, scene: list[str], present: str, invalid: str) -> DataFrame:
    """Share of the present pixels that are not invalid; NULL without a present pixel."""
    n = F.count_if(F.expr(present))
    return pixels.groupBy(*scene).agg(F.try_divide(n - F.count_if(F.expr(f"({present}) AND ({invalid})")), n).alias("f_valid_aoi"))
