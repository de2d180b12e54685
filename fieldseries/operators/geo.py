"""Planar geometry on rings (arrays of struct(x, y), closed: the last point equals the first), as column expressions."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The Lambert-93 conic (EPSG:2154): ellipsoid, parallels, origin, false easting and northing.
A_AXIS, E = 6378137.0, 0.08181919106
N_CONE, C_CONE, LON0, XS, YS = 0.7256077650, 11754255.426, math.radians(3.0), 700000.0, 12655612.05


def _sides(ring: Column) -> Column:
    return F.zip_with(F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1), lambda p, q: F.struct(p.alias("p"), q.alias("q")))


def _sum(sides: Column, f) -> Column:  # noqa: ANN001
    return F.aggregate(sides, F.lit(0.0), lambda acc, s: acc + f(s["p"], s["q"]))


def _cross(p: Column, q: Column) -> Column:
    return p["x"] * q["y"] - q["x"] * p["y"]


def area(ring: Column) -> Column:
    """Shoelace."""
    return F.abs(_sum(_sides(ring), _cross)) / 2


def perimeter(ring: Column) -> Column:
    """G04."""
    return _sum(_sides(ring), lambda p, q: F.hypot(p["x"] - q["x"], p["y"] - q["y"]))


def centroid(ring: Column) -> Column:
    """Area-weighted; null for a ring without area."""
    twice = F.nullif(_sum(_sides(ring), _cross), F.lit(0.0))
    part = lambda c: _sum(_sides(ring), lambda p, q: (p[c] + q[c]) * _cross(p, q)) / (3 * twice)
    return F.struct(part("x").alias("x"), part("y").alias("y"))


def closed(ring: Column) -> Column:
    """G02, in part: at least four points, and the last equals the first."""
    return (F.size(ring) >= 4) & (F.element_at(ring, 1) == F.element_at(ring, -1))


def contains(ring: Column, x: Column, y: Column) -> Column:
    """Ray casting; points on a left or lower border count as inside."""
    crosses = lambda s: ((s["p"]["y"] > y) != (s["q"]["y"] > y)) & (x < (s["q"]["x"] - s["p"]["x"]) * (y - s["p"]["y"]) / (s["q"]["y"] - s["p"]["y"]) + s["p"]["x"])
    safe = F.filter(_sides(ring), lambda s: s["p"]["y"] != s["q"]["y"])
    return F.size(F.filter(safe, crosses)) % 2 == 1


def distance_to_line(line: Column, x: Column, y: Column) -> Column:
    """Least distance of a point to the segments of a line or ring."""

    def one(s: Column) -> Column:
        dx, dy = s["q"]["x"] - s["p"]["x"], s["q"]["y"] - s["p"]["y"]
        t = F.coalesce(F.try_divide((x - s["p"]["x"]) * dx + (y - s["p"]["y"]) * dy, dx * dx + dy * dy), F.lit(0.0))
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
        return F.hypot(x - s["p"]["x"] - t * dx, y - s["p"]["y"] - t * dy)

    return F.array_min(F.transform(_sides(line), one))


def envelope(ring: Column) -> Column:
    """struct(xmin, ymin, xmax, ymax)."""
    axis = lambda c: F.transform(ring, lambda p: p[c])
    return F.struct(F.array_min(axis("x")).alias("xmin"), F.array_min(axis("y")).alias("ymin"), F.array_max(axis("x")).alias("xmax"), F.array_max(axis("y")).alias("ymax"))


def meets_box(ring: Column, box: tuple[float, float, float, float]) -> Column:
    """G01 with an envelope: boxes overlap, and a side crosses the box, a corner lies inside, or the box lies within the ring."""
    xmin, ymin, xmax, ymax = (F.lit(float(v)) for v in box)
    e = envelope(ring)
    overlap = (e["xmin"] <= xmax) & (e["xmax"] >= xmin) & (e["ymin"] <= ymax) & (e["ymax"] >= ymin)
    inside = F.exists(ring, lambda p: p["x"].between(xmin, xmax) & p["y"].between(ymin, ymax))

    def clipped(s: Column) -> Column:
        lo, hi = F.lit(0.0), F.lit(1.0)
        ok = F.lit(True)
        for a, d, low, high in ((s["p"]["x"], s["q"]["x"] - s["p"]["x"], xmin, xmax), (s["p"]["y"], s["q"]["y"] - s["p"]["y"], ymin, ymax)):
            t0, t1 = F.try_divide(low - a, d), F.try_divide(high - a, d)
            ok = ok & F.when(d == 0, a.between(low, high)).otherwise(F.lit(True))
            lo, hi = F.greatest(lo, F.least(t0, t1)), F.least(hi, F.greatest(t0, t1))
        return ok & (lo <= hi)

    return overlap & (inside | F.exists(_sides(ring), clipped) | contains(ring, xmin, ymin))


def lambert93(lon: Column, lat: Column) -> Column:
    """Degrees to metres."""
    phi = F.radians(lat)
    iso = F.log(F.tan(F.pi() / 4 + phi / 2)) + (E / 2) * F.log((1 - E * F.sin(phi)) / (1 + E * F.sin(phi)))
    r = C_CONE * F.exp(-N_CONE * iso)
    gamma = N_CONE * (F.radians(lon) - LON0)
    return F.struct((XS + r * F.sin(gamma)).alias("x"), (YS - r * F.cos(gamma)).alias("y"))


def from_lambert93(x: Column, y: Column, rounds: int = 6) -> Column:
    """G06, the other way: metres to degrees, the latitude by fixed-point steps."""
    r = F.hypot(x - XS, y - YS)
    iso = -F.log(r / C_CONE) / N_CONE
    step = lambda phi, _: 2 * F.atan(F.exp(iso + (E / 2) * F.log((1 + E * F.sin(phi)) / (1 - E * F.sin(phi))))) - F.pi() / 2
    phi = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), 2 * F.atan(F.exp(iso)) - F.pi() / 2, step)
    return F.struct(F.degrees(LON0 + F.atan((x - XS) / (YS - y)) / N_CONE).alias("lon"), F.degrees(phi).alias("lat"))


def ring_of(points: list[tuple[float, float]]) -> Column:
    """A ring of fixed points."""
    return F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in points])


def _turn(a: Column, b: Column, c: Column) -> Column:
    return F.signum((b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"]))


def _between(a: Column, b: Column, c: Column) -> Column:
    """c, on the line through a and b, lies within their box."""
    return c["x"].between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & c["y"].between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))


def _cut(s: Column, t: Column) -> Column:
    """Two sides have a point in common."""
    p, q, r, o = s["p"], s["q"], t["p"], t["q"]
    a, b, c, d = _turn(p, q, r), _turn(p, q, o), _turn(r, o, p), _turn(r, o, q)
    touch = ((a == 0) & _between(p, q, r)) | ((b == 0) & _between(p, q, o)) | ((c == 0) & _between(r, o, p)) | ((d == 0) & _between(r, o, q))
    return ((a != b) & (c != d) & (a * b <= 0) & (c * d <= 0)) | touch


def envelopes_meet(a: Column, b: Column) -> Column:
    return (a["xmin"] <= b["xmax"]) & (a["xmax"] >= b["xmin"]) & (a["ymin"] <= b["ymax"]) & (a["ymax"] >= b["ymin"])


def intersects(a: Column, b: Column) -> Column:
    """Two rings have a point in common: sides meet, or one lies within the other."""
    meet = F.exists(_sides(a), lambda s: F.exists(_sides(b), lambda t: _cut(s, t)))
    p, q = F.element_at(a, 1), F.element_at(b, 1)
    return envelopes_meet(envelope(a), envelope(b)) & (meet | contains(b, p["x"], p["y"]) | contains(a, q["x"], q["y"]))


def valid(ring: Column) -> Column:
    """Closed, with an area, and no two sides meet but neighbours in their common point. Repair is left to the source."""
    n = F.size(ring) - 1
    numbered = F.transform(_sides(ring), lambda s, i: F.struct(s["p"].alias("p"), s["q"].alias("q"), i.alias("i")))
    apart = lambda s, t: (t["i"] > s["i"] + 1) & ~((s["i"] == 0) & (t["i"] == n - 1))
    crossed = F.exists(numbered, lambda s: F.exists(numbered, lambda t: apart(s, t) & _cut(s, t)))
    return closed(ring) & (area(ring) > 0) & ~crossed


def wrong_srid(df: DataFrame, srid: str, expected: int = 2154) -> DataFrame:
    """Rows whose reference system is not the expected one, null included, in one row."""
    return df.agg(F.count("*").alias("n"), F.count_if(~F.col(srid).eqNullSafe(F.lit(expected))).alias("n_faux"))


def to_geojson(ring: Column) -> Column:
    """The text of a polygon."""
    return F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(F.transform(ring, lambda p: F.array(p["x"], p["y"]))).alias("coordinates")))


def wkt_ring(text: Column) -> Column:
    """The points of the first ring of a POLYGON, or of a LINESTRING."""
    first = F.regexp_extract(text, r"\(+([^()]*)\)", 1)
    numbers = lambda pair: F.transform(F.split(F.trim(pair), r"\s+"), lambda x: x.cast("double"))
    return F.transform(F.split(first, ","), lambda pair: F.struct(F.get(numbers(pair), 0).alias("x"), F.get(numbers(pair), 1).alias("y")))


def footprint(text: Column) -> Column:
    """A catalogue's footprint ("geography'SRID=4326;POLYGON((...))'") as WKT."""
    return F.regexp_replace(F.element_at(F.split(text, ";", 2), -1), "'$", "")


def reproject(ring: Column, to: str = "metres") -> Column:
    """A ring between degrees and metres of Lambert-93."""
    if to == "metres":
        return F.transform(ring, lambda p: lambert93(p["x"], p["y"]))
    at = lambda p: from_lambert93(p["x"], p["y"])
    return F.transform(F.transform(ring, at), lambda d: F.struct(d["lon"].alias("x"), d["lat"].alias("y")))


def lambert93_point(lon: float, lat: float) -> tuple[float, float]:
    """G06 for one point of the driver's."""
    phi = math.radians(lat)
    iso = math.log(math.tan(math.pi / 4 + phi / 2)) + (E / 2) * math.log((1 - E * math.sin(phi)) / (1 + E * math.sin(phi)))
    r, gamma = C_CONE * math.exp(-N_CONE * iso), N_CONE * (math.radians(lon) - LON0)
    return XS + r * math.sin(gamma), YS - r * math.cos(gamma)


def box_corners(box: tuple[float, float, float, float]) -> list[tuple[float, float]]:
    """The closed ring of a box of degrees, in metres."""
    xmin, ymin, xmax, ymax = box
    return [lambert93_point(*p) for p in ((xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax), (xmin, ymin))]


def with_envelope(df: DataFrame, ring: str = "ring") -> DataFrame:
    """The envelope as columns of their own; spatial.write_clustered lays a table out by them."""
    return df.withColumn("__e", envelope(F.col(ring))).select("*", "__e.*").drop("__e")


def keep_points(x: np.ndarray, y: np.ndarray, tolerance: float) -> np.ndarray:
    """Douglas-Peucker between the first and the last point: which points stay."""
    keep = np.zeros(len(x), bool)
    keep[[0, -1]] = True
    spans = [(0, len(x) - 1)]
    while spans:
        a, b = spans.pop()
        if b - a < 2:
            continue
        dx, dy = x[b] - x[a], y[b] - y[a]
        px, py = x[a + 1 : b] - x[a], y[a + 1 : b] - y[a]
        length = math.hypot(dx, dy)
        away = np.abs(dx * py - dy * px) / length if length else np.hypot(px, py)
        i = int(away.argmax())
        if away[i] > tolerance:
            m = a + 1 + i
            keep[m] = True
            spans += [(a, m), (m, b)]
    return keep


def simplify(df: DataFrame, ring: str = "ring", tolerance: float = 5.0) -> DataFrame:
    """Df with fewer points in its rings: halves between the first point and the one farthest from it are thinned; a ring that would
    fall below four points stays as it is. Other columns pass through in Arrow batches of the pandas function's argument only."""

    @F.pandas_udf(df.schema[ring].dataType)
    def thin(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rings in parts:
            out = []
            for points in rings:
                if points is None or len(points) < 5:
                    out.append(points)
                    continue
                x, y = np.array([p["x"] for p in points], float), np.array([p["y"] for p in points], float)
                far = int(np.hypot(x - x[0], y - y[0]).argmax())
                on = np.r_[keep_points(x[: far + 1], y[: far + 1], tolerance)[:-1], keep_points(x[far:], y[far:], tolerance)]
                out.append([points[i] for i in np.flatnonzero(on)] if on.sum() >= 4 else points)
            yield pd.Series(out)

    return df.withColumn(ring, thin(F.col(ring)))
