"""Column expressions of the scalar operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

# Scene classes whose pixels are invalid.
INVALID_CLASSES = (1, 3, 7, 8, 9, 10, 11)
# Crop class of each group code; any other group is "autres".
GROUP_CLASSES = {1: "cereales_hiver", 2: "mais", 3: "cereales_hiver", 5: "colza", 9: "lin", 18: "prairie", 19: "prairie", 25: "legumes_fleurs"}


def nan_to_null(df: DataFrame, *names: str) -> DataFrame:
    """NaN to NULL in the named (default: all) floating-point columns; aggregates then skip missing values."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, DoubleType | FloatType) and (not names or f.name in names)]
    return df.withColumns({n: F.when(~F.isnan(n), F.col(n)) for n in floats})


def _clipped(x: Column, most: float) -> Column:
    return F.greatest(F.lit(-most), F.least(F.lit(most), x))


def normalized_difference(a: Column, b: Column) -> Column:
    """(a - b) / (a + b) of reflectances scaled by 10000, clipped to [-1, 1]; NDVI is (B08, B04), NDWI (B08, B11), NDRE."""
    x, y = a / 10000, b / 10000
    return _clipped((x - y) / (x + y + F.lit(1e-10)), 1.0)


def evi(nir: Column, red: Column, blue: Column) -> Column:
    """2.5 (nir - red) / (nir + 6 red - 7.5 blue + 1), the denominator kept off zero, clipped to [-2, 2]."""
    n, r, b = nir / 10000, red / 10000, blue / 10000
    below = n + 6 * r - 7.5 * b + 1
    return _clipped(2.5 * (n - r) / F.when(F.abs(below) < 0.001, F.lit(0.001)).otherwise(below), 2.0)


def valid_pixel(scl: Column, band: Column) -> Column:
    """The band's value, NULL where the scene class is invalid or the band holds its nodata value 0."""
    return F.when(~scl.isin(*INVALID_CLASSES), F.nullif(band, F.lit(0).cast("double")))


def crop_class(group: Column, code: Column) -> Column:
    """Class of a parcel: by group code, "autres" if unknown; the code BTN is "betterave" whatever its group."""
    known = F.create_map(*[F.lit(x) for pair in GROUP_CLASSES.items() for x in pair])
    return F.when(code == "BTN", F.lit("betterave")).otherwise(F.coalesce(F.try_element_at(known, group.try_cast("int")), F.lit("autres")))


def month(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def scene_tile(scene: Column) -> Column:
    """Sixth part of a scene name, without its first letter."""
    return F.substring(F.get(F.split(scene, "_"), F.lit(5)), 2, 99)


def scene_date(scene: Column) -> Column:
    return F.substring(F.get(F.split(scene, "_"), F.lit(2)), 1, 8)


def attribute(attributes: Column, name: str) -> Column:
    """Value of the first struct(Name, Value) of an array that has the name; NULL if none has."""
    return F.get(F.filter(attributes, lambda a: a["Name"] == name), 0)["Value"]


def utm_epsg(tile: Column) -> Column:
    return F.lit(32600) + F.substring(tile, 1, 2).cast("int")


def compactness(perimeter: Column, area: Column) -> Column:
    return perimeter * perimeter / (4 * F.pi() * area)


def half_even(x: Column, digits: int = 0) -> Column:
    """Rounding of arrays of doubles, halves to the even neighbour; SQL's own round takes halves away from zero."""
    return F.rint(x * 10.0**digits) / 10.0**digits


def version_name(prefix: str, date: Column | None = None) -> Column:
    """a version's name by its day."""
    return F.concat(F.lit(f"{prefix}_"), F.date_format(F.current_date() if date is None else date, "yyyyMMdd"))


def tile_pair(tile: Column, pairs: dict[str, str]) -> Column:
    """The strip of a tile; null for a tile that is in none."""
    return F.try_element_at(F.create_map(*[F.lit(x) for item in pairs.items() for x in item]), tile)


def without_nodata(x: Column, nodata: float = -9999.0) -> Column:
    """The composites' nodata as NULL."""
    return F.nullif(x, F.lit(nodata))


def group_code(group: Column) -> Column:
    """P10: the group as a number; text that is none raises (crop_class takes it as unknown instead)."""
    return group.cast("int")
