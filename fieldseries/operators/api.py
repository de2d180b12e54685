"""The read queries: one parcel, its monthly profile, and parcels of a box."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldseries.operators import geo

# The variables of a profile, the largest box in square kilometres, the largest page.
PROFILE_VARIABLES = ("NDVI", "EVI", "NDWI", "NDRE")
MOST_KM2, MOST_ROWS = 50.0, 2000


#: The names that the read interface gives to columns of the tables.
RENAMES = {"divergent": "divergente", "dist_classe": "distance_rms", "code_cultu": "code_culture"}


class UnknownParcelError(LookupError):
    """Q02, Q03: what a server answers with 404."""


class BboxTooLargeError(ValueError):
    """Q05: carries the box's area and the limit."""

    def __init__(self, area: float, limit: float = MOST_KM2):
        super().__init__(f"box of {area} km² is above {limit} km²")
        self.area, self.limit = area, limit


def parse_bbox(text: str) -> tuple[float, float, float, float]:
    """P20: exactly four numbers."""
    parts = text.split(",")
    if len(parts) != 4:
        raise ValueError("a box is xmin,ymin,xmax,ymax")
    return tuple(float(x) for x in parts)


def parcel_card(classification: DataFrame, divergence: DataFrame, phenology: DataFrame, parcels: DataFrame, id: str) -> DataFrame:
    """All that is known of the classified parcels; filter by id before or after, the filter reaches every scan."""
    return classification.join(divergence, id, "left").join(phenology, id, "left").join(parcels, id, "left")


def parcel_detail(card: DataFrame, id: str, value: object) -> DataFrame:
    """One parcel under the interface's names; raises UnknownParcelError where it is not classified."""
    one = card.where(F.col(id) == F.lit(value)).dropDuplicates([id])
    if one.isEmpty():
        raise UnknownParcelError(value)
    return one.select(*[F.col(c).alias(RENAMES.get(c, c)) for c in one.columns])


def parcel_profile(monthly: DataFrame, classification: DataFrame, id: str, value: object, months: list[str], variables: tuple[str, ...] = PROFILE_VARIABLES) -> DataFrame:
    """Q03: one parcel's aligned lists; raises UnknownParcelError where it is not classified."""
    one = classification.where(F.col(id) == F.lit(value)).select(id).limit(1)
    if one.isEmpty():
        raise UnknownParcelError(value)
    return aligned_profile(monthly.where(F.col(id) == F.lit(value)), one, id, months, variables)


def aligned_profile(monthly: DataFrame, ids: DataFrame, id: str, months: list[str], variables: tuple[str, ...] = PROFILE_VARIABLES, value: str = "mean") -> DataFrame:
    """Per id one array for each variable, aligned with the months, null where a month has no row."""
    cells = monthly.where(F.col("variable").isin(*variables) & F.col("mois").isin(*months))
    maps = cells.groupBy(id).agg(*[F.map_from_entries(F.collect_list(F.when(F.col("variable") == v, F.struct("mois", value)))).alias(f"m_{v}") for v in variables])  # one entry a month
    dates = F.array(*[F.lit(m) for m in months])
    aligned = lambda held: F.transform(dates, lambda m: F.try_element_at(held, m))
    return ids.select(id).distinct().join(maps, id, "left").select(id, *[aligned(F.col(f"m_{v}")).alias(v.lower()) for v in variables])


def box_area_km2(box: tuple[float, float, float, float]) -> float:
    """The area of a box of degrees in Lambert-93, rounded to a tenth before it is compared."""
    corners = geo.box_corners(box)
    twice = sum(x0 * y1 - x1 * y0 for (x0, y0), (x1, y1) in zip(corners, corners[1:], strict=False))
    return math.floor(abs(twice) / 2e6 * 10 + 0.5) / 10


def in_box(ring: str, box: tuple[float, float, float, float]) -> Column:
    """Rings that meet a box of degrees. The tables' envelope columns (geo.with_envelope) come first: plain comparisons, which reach the Parquet scan."""
    corners = geo.box_corners(box)
    xs, ys = [p[0] for p in corners], [p[1] for p in corners]
    near = (F.col("xmin") <= max(xs)) & (F.col("xmax") >= min(xs)) & (F.col("ymin") <= max(ys)) & (F.col("ymax") >= min(ys))
    return near & geo.intersects(F.col(ring), geo.ring_of(corners))


def box_candidates(classification: DataFrame, parcels: DataFrame, divergence: DataFrame, hit: Column, id: str) -> DataFrame:
    """Classified parcels of a box with their flag; the box is applied before the joins."""
    return classification.join(parcels.where(hit), id).join(divergence, id, "left")


@dataclass
class Page:
    rows: DataFrame
    total: int
    truncated: bool


def parcels_in_box(candidates: DataFrame, box: tuple[float, float, float, float], order: str, limit: int = MOST_ROWS) -> Page:
    """Rows in id order, one more read than shown; the total is counted only if there are more. The page is cut once, at most limit + 1 rows."""
    if not 0 < limit <= MOST_ROWS:
        raise ValueError(f"a page has 1 to {MOST_ROWS} rows")
    if (size := box_area_km2(box)) > MOST_KM2:
        raise BboxTooLargeError(size)
    found = candidates.orderBy(order).limit(limit + 1).collect()  # at most MOST_ROWS + 1 rows
    rows = candidates.sparkSession.createDataFrame(found[:limit], candidates.schema)
    return Page(rows, candidates.count() if len(found) > limit else len(found), len(found) > limit)


def feature_collection(page: DataFrame, ring: str, order: str, total: int, truncated: bool) -> DataFrame:
    """One row of GeoJSON for a page of at most MOST_ROWS rows, in the order of a column; rings in metres are simplified, then written in degrees."""
    thin = geo.simplify(page, ring).withColumn(ring, geo.reproject(F.col(ring), "degrees"))
    props = F.struct(*[F.col(c).alias(RENAMES.get(c, c)) for c in page.columns if c != ring])
    feature = F.concat(F.lit('{"type":"Feature","geometry":'), geo.to_geojson(F.col(ring)), F.lit(',"properties":'), F.to_json(props, {"ignoreNullFields": "false"}), F.lit("}"))
    made = thin.select(F.struct(F.col(order).alias("o"), feature.alias("f")).alias("s")).agg(F.sort_array(F.collect_list("s")).alias("s"))
    texts = F.transform("s", lambda x: x["f"])
    tail = F.concat(F.lit('],"retourne":'), F.size("s").cast("string"), F.lit(f',"total_disponible":{total},"tronque":{str(truncated).lower()}}}'))
    return made.select(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(texts, ","), tail).alias("geojson"))
