"""Multi-part geometry: a ring set is an array of closed rings (arrays of struct(x, y)), outer ones counter-clockwise and holes clockwise.

With this orientation the interior lies to the left of every side, so areas and centroids are signed sums over all sides, a point is inside where
an odd number of sides lies to its right, and sides that two adjoining parts share run in opposite directions. An empty array is an empty geometry.
"""

from __future__ import annotations

import json
import math
import struct
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldseries.functions.session import ship
from fieldseries.operators import geo

RINGS = "array<array<struct<x:double,y:double>>>"
Shape = list[np.ndarray]  # closed rings of points (n, 2)
#: How far from a side its right is looked at, in the units of the coordinates: two sides nearer than this count as one.
BESIDE = 1e-6
#: Parts of one id that are united in one go; more are united in groups first.
PARTS_AT_ONCE = 256


def shapes(column: pa.Array) -> Iterator[Shape | None]:
    """The rows of a ring set column as point arrays."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rings = column.values
    points = rings.values
    xy = np.column_stack([points.field(n).to_numpy(zero_copy_only=False) for n in ("x", "y")]) if len(points) else np.zeros((0, 2))
    outer, inner = column.offsets.to_numpy(), rings.offsets.to_numpy()
    for i, known in enumerate(column.is_valid().to_pylist()):
        yield [xy[inner[k] : inner[k + 1]] for k in range(outer[i], outer[i + 1])] if known else None


def all_sides(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sides of all rows of a ring set column, end to end: their starts, their ends, and the row of each."""
    rings = column.values
    points = rings.values
    xy = np.column_stack([points.field(n).to_numpy(zero_copy_only=False) for n in ("x", "y")]) if len(points) else np.zeros((0, 2))
    outer, inner = column.offsets.to_numpy(), rings.offsets.to_numpy().astype(np.int64)
    start, length = inner[outer[0] : outer[-1]], np.diff(inner[outer[0] : outer[-1] + 1])
    count = np.maximum(length - 1, 0)
    at = np.repeat(start, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    row = np.repeat(np.repeat(np.arange(len(column)), np.diff(outer)), count)
    return xy[at], xy[at + 1], row


def column_of(rows: list[Shape | None]) -> pa.Array:
    """The reverse of shapes()."""
    rings = [r for s in rows if s is not None for r in s]
    xy = np.concatenate(rings) if rings else np.zeros((0, 2))
    points = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], names=["x", "y"])
    inner = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rings)]), pa.int32()), points)
    at, outer = 0, []
    for s in rows:
        outer.append(None if s is None else at)
        at += len(s or [])
    return pa.ListArray.from_arrays(pa.array([*outer, at], pa.int32()), inner)


def signed(ring: np.ndarray) -> float:
    """Twice the area, positive counter-clockwise."""
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum())


def read_wkb(value: bytes) -> Shape:
    """A polygon or multipolygon of either byte order, with or without Z, M and a reference system. Anything else raises."""
    at = 0

    def take(form: str, size: int) -> int:
        nonlocal at
        if at + size > len(value):
            raise ValueError("WKB ends early")
        (out,) = struct.unpack_from(form, value, at)
        at += size
        return out

    def head() -> tuple[str, int, int]:
        order = take("B", 1)
        if order > 1:
            raise ValueError(f"WKB byte order {order}")
        end = "<" if order else ">"
        code = take(end + "I", 4)
        if code & 0x20000000:
            take(end + "I", 4)
        plain = code & 0x0FFFFFFF
        dims = 2 + bool(code & 0x80000000) + bool(code & 0x40000000) + (0, 1, 1, 2)[min(plain // 1000, 3)]
        return end, plain % 1000, dims

    def polygon(end: str, dims: int) -> Shape:
        nonlocal at
        rings = []
        for k in range(take(end + "I", 4)):
            n = take(end + "I", 4)
            if at + 8 * n * dims > len(value):
                raise ValueError("WKB ends early")
            ring = np.frombuffer(value, end + "f8", n * dims, at).reshape(n, dims)[:, :2].astype(float)
            at += 8 * n * dims
            if n < 4 or (ring[0] != ring[-1]).any():
                raise ValueError("a WKB ring is not closed")
            rings.append(ring if (signed(ring) < 0) == (k > 0) else ring[::-1])
        return rings

    end, kind, dims = head()
    if kind == 3:
        out = polygon(end, dims)
    elif kind == 6:
        out = []
        for _ in range(take(end + "I", 4)):
            inner_end, inner, inner_dims = head()
            if inner != 3:
                raise ValueError(f"WKB type {inner} in a multipolygon")
            out += polygon(inner_end, inner_dims)
    else:
        raise ValueError(f"WKB type {kind} is neither a polygon nor a multipolygon")
    if at != len(value):
        raise ValueError("WKB has bytes left over")
    return out


def polygons(shape: Shape) -> list[Shape]:
    """The rings by polygon: each hole behind the smallest outer ring around it."""
    outer = [r for r in shape if signed(r) > 0]
    out = [[r] for r in outer]
    for hole in (r for r in shape if signed(r) <= 0):
        probe = (hole[:1] + hole[1:2]) / 2
        around = [k for k, r in enumerate(outer) if _windings(probe, r[:-1], r[1:])[0]]
        if not around:
            raise ValueError("a hole lies in no outer ring")
        out[min(around, key=lambda k: signed(outer[k]))].append(hole)
    return out


def write_wkb(shape: Shape, big: bool = False) -> bytes:
    """A multipolygon of two dimensions, in little-endian order unless big."""
    end = ">" if big else "<"
    head = lambda kind, n: struct.pack(end + "BII", 0 if big else 1, kind, n)
    made = polygons(shape)
    return head(6, len(made)) + b"".join(head(3, len(p)) + b"".join(struct.pack(end + "I", len(r)) + r.astype(end + "f8").tobytes() for r in p) for p in made)


def to_wkb(rings: Column, big: bool = False) -> Column:
    """A ring set as WKB."""

    @F.arrow_udf("binary")
    def write(values: pa.Array) -> pa.Array:
        return pa.array([None if s is None else write_wkb(s, big) for s in shapes(values)], pa.binary())

    return write(rings)


def from_wkb(wkb: Column) -> Column:
    """The ring set of WKB; null stays null."""

    @F.arrow_udf(RINGS)
    def read(values: pa.Array) -> pa.Array:
        return column_of([None if v is None else read_wkb(v) for v in values.to_pylist()])

    return read(wkb)


def doubled(ring: Column) -> Column:
    """Twice a ring's area, positive counter-clockwise."""
    return geo._sum(geo._sides(ring), geo._cross)


def of_ring(ring: Column) -> Column:
    """The ring set of one outer ring of either direction."""
    return F.when(ring.isNotNull(), F.array(F.when(doubled(ring) < 0, F.reverse(ring)).otherwise(ring)))


def sides(rings: Column) -> Column:
    return F.flatten(F.transform(rings, geo._sides))


def area(rings: Column) -> Column:
    """Outer rings less holes."""
    return geo._sum(sides(rings), geo._cross) / 2


def perimeter(rings: Column) -> Column:
    """Of all rings, holes included."""
    return geo._sum(sides(rings), lambda p, q: F.hypot(p["x"] - q["x"], p["y"] - q["y"]))


def centroid(rings: Column) -> Column:
    """Area-weighted over all parts, holes taken off; null without area. Sums are taken from the first point, which keeps their digits."""
    o = F.get(F.get(rings, F.lit(0)), F.lit(0))
    near = F.transform(sides(rings), lambda s: F.struct(*[F.struct((s[e]["x"] - o["x"]).alias("x"), (s[e]["y"] - o["y"]).alias("y")).alias(e) for e in "pq"]))
    twice = F.nullif(geo._sum(near, geo._cross), F.lit(0.0))
    part = lambda c: o[c] + geo._sum(near, lambda p, q: (p[c] + q[c]) * geo._cross(p, q)) / (3 * twice)
    return F.struct(part("x").alias("x"), part("y").alias("y"))


def _odd(some: Column, x: Column, y: Column) -> Column:
    right = lambda s: F.when((s["p"]["y"] > y) != (s["q"]["y"] > y), x < (s["q"]["x"] - s["p"]["x"]) * (y - s["p"]["y"]) / (s["q"]["y"] - s["p"]["y"]) + s["p"]["x"])
    return F.size(F.filter(some, right)) % 2 == 1


def contains(rings: Column, x: Column, y: Column) -> Column:
    """An odd number of sides lies to the right; points on a left or lower border count as inside."""
    return _odd(sides(rings), x, y)


def envelope(rings: Column) -> Column:
    return geo.envelope(F.flatten(rings))


def with_envelope(df: DataFrame, rings: str = "rings") -> DataFrame:
    """The envelope as columns xmin, ymin, xmax, ymax."""
    return df.withColumn("__e", envelope(F.col(rings))).select("*", "__e.*").drop("__e")


def intersects(a: Column, b: Column) -> Column:
    """Two ring sets have a point in common. Of b only the sides level with a's envelope and not left of it matter, so a large b is read once and not a side
    of a at a time."""
    e = envelope(a)
    some = F.filter(sides(b), lambda s: (F.least(s["p"]["y"], s["q"]["y"]) <= e["ymax"]) & (F.greatest(s["p"]["y"], s["q"]["y"]) >= e["ymin"]) & (F.greatest(s["p"]["x"], s["q"]["x"]) >= e["xmin"]))
    close = F.filter(some, lambda s: F.least(s["p"]["x"], s["q"]["x"]) <= e["xmax"])
    meet = F.exists(close, lambda t: F.exists(sides(a), lambda s: geo._cut(s, t)))
    inside = F.exists(a, lambda r: _odd(some, F.get(r, F.lit(0))["x"], F.get(r, F.lit(0))["y"]))
    around = F.exists(b, lambda r: contains(a, F.get(r, F.lit(0))["x"], F.get(r, F.lit(0))["y"]))
    return geo.envelopes_meet(e, envelope(b)) & (meet | inside | around)


def _spread(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row as often as its count says: the rows, and 0, 1, 2 ... within each."""
    owner = np.repeat(np.arange(len(count)), count)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)


def _grid(low: np.ndarray, high: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(size, cells, boxes): the cells that boxes cover, on a grid about as fine as the boxes are large: few cells a box on average."""
    size = max(float((high - low).mean()) * 2, 1e-9)
    while True:
        a, b = np.floor(low / size).astype(np.int64), np.floor(high / size).astype(np.int64)
        spread = b - a + 1
        cells = spread[:, 0] * spread[:, 1]
        if cells.sum() <= 16 * len(low) + 64:
            break
        size *= 2
    owner, nth = _spread(cells)
    return size, np.column_stack([a[owner, 0] + nth % spread[owner, 0], a[owner, 1] + nth // spread[owner, 0]]), owner


def near_pairs(p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs i < j of sides whose boxes share a cell of a grid about as fine as the sides are long: all that can meet, and few others."""
    n = len(p)
    low, high = np.minimum(p, q), np.maximum(p, q)
    _, key, owner = _grid(low, high)
    by = np.lexsort((owner, key[:, 1], key[:, 0]))
    key, owner = key[by], owner[by]
    first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)])
    length = np.diff(np.r_[first, len(owner)])
    behind = np.repeat(first + length, length) - np.arange(len(owner)) - 1  # sides after each in its cell
    i = np.repeat(np.arange(len(owner)), behind)
    j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(behind) - behind, behind)
    pairs = np.unique(owner[i] * n + owner[j])
    i, j = pairs // n, pairs % n
    meet = ((low[i] <= high[j]) & (low[j] <= high[i])).all(1)
    return i[meet], j[meet]


def _turns(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (b[:, 0] - a[:, 0]) * (c[:, 1] - a[:, 1]) - (b[:, 1] - a[:, 1]) * (c[:, 0] - a[:, 0])


def _on(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """c lies on the side from a to b."""
    return (_turns(a, b, c) == 0) & (np.minimum(a, b) <= c).all(1) & (c <= np.maximum(a, b)).all(1)


def _sides_of(shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([r[:-1] for r in shape]), np.concatenate([r[1:] for r in shape])


def is_valid(shape: Shape) -> bool:
    """Closed rings with an area; within a ring no two sides meet but neighbours in their common point, and sides of two rings may touch in a point but
    neither cross nor run along each other. Sides are compared with those near them only. Rings that change sides exactly in a corner are not told apart."""
    if not shape or any(len(r) < 4 or (r[0] != r[-1]).any() or not signed(r) for r in shape):
        return False
    p, q = _sides_of(shape)
    ring = np.repeat(np.arange(len(shape)), [len(r) - 1 for r in shape])
    size = np.array([len(r) - 1 for r in shape])[ring]
    place = np.concatenate([np.arange(len(r) - 1) for r in shape])
    i, j = near_pairs(p, q)
    return not _meet_wrongly(p, q, ring, place, size, i, j).any()


def _meet_wrongly(p: np.ndarray, q: np.ndarray, ring: np.ndarray, place: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs i < j of sides meet though they should not. Of each side its ring, its place in it and the ring's number of sides are given."""
    gap = place[j] - place[i]
    after, around = (ring[i] == ring[j]) & (gap == 1), (ring[i] == ring[j]) & (gap == size[i] - 1)
    pi, qi, pj, qj = p[i], q[i], p[j], q[j]
    cross = (np.sign(_turns(pi, qi, pj)) * np.sign(_turns(pi, qi, qj)) < 0) & (np.sign(_turns(pj, qj, pi)) * np.sign(_turns(pj, qj, qi)) < 0)
    touch = _on(pi, qi, pj) | _on(pi, qi, qj) | _on(pj, qj, pi) | _on(pj, qj, qi)
    low, high = np.maximum(np.minimum(pi, qi), np.minimum(pj, qj)), np.minimum(np.maximum(pi, qi), np.maximum(pj, qj))
    along = (_turns(pi, qi, pj) == 0) & (_turns(pi, qi, qj) == 0) & ((high - low).max(1) > 0)  # they share a stretch
    one = ring[i] == ring[j]
    return along | cross | (one & ~(after | around) & touch)


#: Shapes of up to so many sides are looked at many at once, all their sides against each other, in runs of about so many pairs of sides.
SMALL, PAIRS_AT_ONCE = 64, 1_000_000


def _wrong_sides(some: list[Shape]) -> list[set[tuple[int, int]]]:
    """_sides_in_the_way() of each shape."""
    out: list[set[tuple[int, int]]] = [set() for _ in some]
    run, pairs = [], 0
    for n, shape in enumerate(some):
        sides = sum(len(r) - 1 for r in shape)
        if sides > SMALL:
            out[n] = _sides_in_the_way(shape)
            continue
        run.append(n)
        pairs += sides * (sides - 1) // 2
        if pairs > PAIRS_AT_ONCE:
            _look_at([some[k] for k in run], [out[k] for k in run])
            run, pairs = [], 0
    if run:
        _look_at([some[k] for k in run], [out[k] for k in run])
    return out


def _look_at(some: list[Shape], out: list[set[tuple[int, int]]]) -> None:
    """Adds to out what _sides_in_the_way() has of each of some small shapes."""
    p, q = _sides_of([r for s in some for r in s])
    sizes = np.array([len(r) - 1 for s in some for r in s])
    ring, place = _spread(sizes)
    of = np.repeat(np.arange(len(some)), [len(s) for s in some])  # the shape of each ring
    shape = of[ring]
    i, nth = _spread(np.cumsum(np.bincount(shape))[shape] - np.arange(len(p)) - 1)
    j = i + 1 + nth
    low, high = np.minimum(p, q), np.maximum(p, q)
    meet = (low[i, 0] <= high[j, 0]) & (low[j, 0] <= high[i, 0]) & (low[i, 1] <= high[j, 1]) & (low[j, 1] <= high[i, 1])
    i, j = i[meet], j[meet]
    wrong = _meet_wrongly(p, q, ring, place, sizes[ring], i, j)
    first = np.searchsorted(of, np.arange(len(some)))
    for k in np.unique(np.r_[i[wrong], j[wrong]]).tolist():
        out[shape[k]].add((int(ring[k] - first[shape[k]]), int(place[k])))


def are_valid(some: list[Shape]) -> list[bool]:
    """is_valid() of each shape."""
    sound = [bool(s) and not any(len(r) < 4 or (r[0] != r[-1]).any() or not signed(r) for r in s) for s in some]
    wrong = iter(_wrong_sides([s for s, ok in zip(some, sound, strict=True) if ok]))
    return [ok and not next(wrong) for ok in sound]


def valid(rings: Column) -> Column:
    """G02 over ring sets, in time that grows little faster than the sides."""

    @F.arrow_udf("boolean")
    def check(values: pa.Array) -> pa.Array:
        some = list(shapes(values))
        checked = iter(are_valid([s for s in some if s is not None]))
        return pa.array([None if s is None else next(checked) for s in some], pa.bool_())

    return check(rings)


def _noded(p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sides cut wherever another one touches or crosses them."""
    i, j = near_pairs(p, q)
    cuts: list[tuple[np.ndarray, np.ndarray]] = []
    for a, b in ((i, j), (j, i)):
        for end in (p, q):
            on = _on(p[a], q[a], end[b])
            cuts.append((a[on], end[b][on]))
    d, e = q[i] - p[i], q[j] - p[j]
    cross = (np.sign(_turns(p[i], q[i], p[j])) * np.sign(_turns(p[i], q[i], q[j])) < 0) & (np.sign(_turns(p[j], q[j], p[i])) * np.sign(_turns(p[j], q[j], q[i])) < 0)
    i, j, d, e = i[cross], j[cross], d[cross], e[cross]
    t = ((p[j] - p[i])[:, 0] * e[:, 1] - (p[j] - p[i])[:, 1] * e[:, 0]) / (d[:, 0] * e[:, 1] - d[:, 1] * e[:, 0])
    at = p[i] + t[:, None] * d
    cuts += [(i, at), (j, at)]
    side = np.concatenate([np.arange(len(p)), np.arange(len(p)), *(c[0] for c in cuts)])
    point = np.concatenate([p, q, *(c[1] for c in cuts)])
    along = ((point - p[side]) * (q - p)[side]).sum(1)
    by = np.lexsort((along, side))
    side, point = side[by], point[by]
    inside = (side[1:] == side[:-1]) & (point[1:] != point[:-1]).any(1)
    return point[:-1][inside], point[1:][inside]


def _windings(at: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """How many parts cover each point, of parts with the interior to the left of their sides."""
    out = np.zeros(len(at), np.int64)
    step = max(1, 4_000_000 // max(1, len(p)))
    for k in range(0, len(at), step):
        x, y = at[k : k + step, :1], at[k : k + step, 1:]
        up, down = (p[:, 1] <= y) & (q[:, 1] > y), (q[:, 1] <= y) & (p[:, 1] > y)
        turn = (q[:, 0] - p[:, 0]) * (y - p[:, 1]) - (q[:, 1] - p[:, 1]) * (x - p[:, 0])
        out[k : k + step] = (up & (turn > 0)).sum(1) - (down & (turn < 0)).sum(1)
    return out


def _windings_near(at: np.ndarray, p: np.ndarray, q: np.ndarray, ring: np.ndarray) -> np.ndarray:
    """_windings() by closed rings (of each side its ring, in order): of a point only the rings whose box holds it are asked, and of these the sides in the
    same slab of height, so the time grows little faster than points and sides."""
    first = np.flatnonzero(np.r_[True, ring[1:] != ring[:-1]])
    low, high = np.minimum.reduceat(p, first), np.maximum.reduceat(p, first)
    size, cell, box = _grid(low, high)
    mine = np.floor(at / size).astype(np.int64)
    least = np.minimum(cell.min(0), mine.min(0))
    wide = max(cell[:, 1].max(), mine[:, 1].max()) - least[1] + 1
    key, want = ((c[:, 0] - least[0]) * wide + c[:, 1] - least[1] for c in (cell, mine))
    by = np.argsort(key, kind="stable")
    key, box = key[by], box[by]
    start = np.searchsorted(key, want)
    point, nth = _spread(np.searchsorted(key, want, "right") - start)
    box = box[start[point] + nth]
    held = ((low[box] <= at[point]) & (at[point] <= high[box])).all(1)
    point, box = point[held], box[held]
    # The sides of each ring by slabs, which are as high as its sides are on average.
    rise = np.abs(q - p)[:, 1]
    tall = np.maximum(np.bincount(ring, rise) / np.bincount(ring), 1e-9)
    slab = lambda y, r: np.floor((y - low[r, 1]) / tall[r]).astype(np.int64)
    under = slab(np.minimum(p, q)[:, 1], ring)
    side, nth = _spread(slab(np.maximum(p, q)[:, 1], ring) - under + 1)
    slabs = slab(high[:, 1], np.arange(len(low))) + 1
    base = np.cumsum(slabs) - slabs
    key = base[ring[side]] + under[side] + nth
    by = np.argsort(key, kind="stable")
    key, side = key[by], side[by]
    want = base[box] + slab(at[point, 1], box)
    start = np.searchsorted(key, want)
    count = np.searchsorted(key, want, "right") - start
    out = np.zeros(len(at), np.int64)
    ends = np.cumsum(count)
    k = 0
    while k < len(count):  # so many pairs of a point and a side at once
        to = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + 2_000_000)))
        row, nth = _spread(count[k:to])
        s, i = side[start[k:to][row] + nth], point[k:to][row]
        x, y = at[i, 0], at[i, 1]
        up, down = (p[s, 1] <= y) & (q[s, 1] > y), (q[s, 1] <= y) & (p[s, 1] > y)
        turn = (q[s, 0] - p[s, 0]) * (y - p[s, 1]) - (q[s, 1] - p[s, 1]) * (x - p[s, 0])
        out += np.bincount(i, (up & (turn > 0)).astype(np.int64) - (down & (turn < 0)), len(at)).astype(np.int64)
        k = to
    return out


def union(parts: list[Shape]) -> Shape:
    """The outline of parts that adjoin, overlap, lie apart or within each other. Sides are cut where they meet; pieces that two parts run along in
    opposite directions cancel, of equal ones a single one stays, and so do only those with nothing to their right. What is left is chained into rings."""
    parts = [s for s in parts if s]
    if len(parts) < 2:
        return parts[0] if parts else []
    rings = [r for s in parts for r in s]
    p, q = _sides_of(rings)
    a, b = _noded(p, q)
    points, where = np.unique(np.concatenate([a, b]), axis=0, return_inverse=True)
    where = where.reshape(-1)
    ia, ib = where[: len(a)], where[len(a) :]
    edges = np.unique(ia * len(points) + ib)
    ia, ib = edges // len(points), edges % len(points)
    single = ~np.isin(ib * len(points) + ia, edges)
    ia, ib = ia[single], ib[single]
    d = points[ib] - points[ia]
    length = np.hypot(d[:, 0], d[:, 1])[:, None]
    beside = (points[ia] + points[ib]) / 2 + BESIDE * np.column_stack([d[:, 1], -d[:, 0]]) / length
    free = _windings_near(beside, p, q, np.repeat(np.arange(len(rings)), [len(r) - 1 for r in rings])) <= 0
    return _chained(points, ia[free], ib[free])


def _chained(points: np.ndarray, ia: np.ndarray, ib: np.ndarray) -> Shape:
    """Directed edges as rings, each from its smallest point; where several go on from a point, the one most to the left is taken."""
    onward: dict[int, list[int]] = defaultdict(list)
    for x, y in zip(ia.tolist(), ib.tolist(), strict=True):
        onward[x].append(y)
    rings = []
    for start in sorted(onward):
        while onward[start]:
            path = [start, onward[start].pop(0)]
            while path[-1] != start:
                choices = onward[path[-1]]
                if not choices:
                    raise ValueError("the sides do not close")
                if len(choices) == 1:
                    path.append(choices.pop())
                    continue
                here, before = points[path[-1]], points[path[-2]]
                back = math.atan2(*(before - here)[::-1])
                turn = [(back - math.atan2(*(points[c] - here)[::-1])) % (2 * math.pi) or 2 * math.pi for c in choices]
                path.append(choices.pop(int(np.argmin(turn))))
            if len(path) > 3:
                rings.append(points[path])
    return rings


def _united(column: Column) -> Column:
    @F.arrow_udf(RINGS)
    def unite(values: pa.Array) -> pa.Array:
        flat, offsets = list(shapes(values.values)), values.offsets.to_numpy()
        return column_of([union([s for s in flat[offsets[i] : offsets[i + 1]] if s is not None]) for i in range(len(values))])

    return unite(column)


def dissolve(parts: DataFrame, id: str, rings: str = "rings", at_once: int = PARTS_AT_ONCE) -> DataFrame:
    """(id, rings, n_parts): the outline of all parts of each id. Parts equal to each other count once in the outline. An id of one part keeps it as it
    is and is not sent to Python; one of very many is united in groups of about at_once first."""
    ship(parts.sparkSession)
    rows = parts.select(id, F.col(rings).alias("__rings"))
    counts = rows.groupBy(id).agg(F.count("__rings").alias("n_parts"))
    crowded = counts.where(F.col("n_parts") > at_once).select(F.col(id).alias("__id"), F.ceil(F.col("n_parts") / at_once).cast("int").alias("__groups"))
    if crowded.limit(1).count():
        held = rows.join(crowded, F.col(id).eqNullSafe(F.col("__id")), "left")
        grouped = held.groupBy(id, F.pmod(F.xxhash64("__rings"), F.coalesce("__groups", F.lit(1))).alias("__group"))
        rows = grouped.agg(F.sort_array(F.collect_list("__rings")).alias("__parts")).select(id, _united(F.col("__parts")).alias("__rings"))
        made = rows.groupBy(id).agg(F.sort_array(F.collect_list("__rings")).alias("__parts")).join(counts.withColumnRenamed(id, "__id"), F.col(id).eqNullSafe(F.col("__id"))).drop("__id")
    else:
        made = rows.groupBy(id).agg(F.sort_array(F.collect_list("__rings")).alias("__parts"), F.count("__rings").alias("n_parts"))
    one = made.where(F.size("__parts") == 1).select(id, F.get("__parts", F.lit(0)).alias(rings), "n_parts")
    more = made.where(F.size("__parts") != 1).select(id, _united(F.col("__parts")).alias(rings), "n_parts")
    return one.unionByName(more)


def to_geojson(rings: Column) -> Column:
    """The text of a MultiPolygon."""

    @F.arrow_udf("string")
    def text(values: pa.Array) -> pa.Array:
        made = [None if s is None else [[r.tolist() for r in p] for p in polygons(s)] for s in shapes(values)]
        return pa.array([None if m is None else json.dumps({"type": "MultiPolygon", "coordinates": m}) for m in made], pa.string())

    return text(rings)


def simplified(shape: Shape, tolerance: float) -> Shape:
    """Fewer points, none farther than the tolerance from the new sides, and the topology of the shape: a ring keeps four points or stays whole; where
    new sides would meet others, or cut a ring off its place, the farthest of the points that they leave out come back until they do not. The result of a valid
    shape is valid."""
    return simplified_all([shape], tolerance)[0]


def simplified_all(some: list[Shape], tolerance: float) -> list[Shape]:
    """simplified() of each shape, of many at once."""
    kept = _kept_points([r for s in some for r in s], tolerance)
    keep = [kept[e - len(s) : e] for s, e in zip(some, np.cumsum([len(s) for s in some]).tolist(), strict=True)]
    made = [[r[k] for r, k in zip(s, on, strict=True)] for s, on in zip(some, keep, strict=True)]
    wrong = _wrong_sides(made)
    return [_mended(s, on) if bad or _cutting_off(s, on) else m for s, on, m, bad in zip(some, keep, made, wrong, strict=True)]


def _kept_points(rings: list[np.ndarray], tolerance: float) -> list[np.ndarray]:
    """Which points of each ring stay, by Douglas-Peucker on its halves between the first point and the one farthest from it, the spans of all rings at once; a
    ring keeps four points or stays whole."""
    if not rings:
        return []
    xy, sizes = np.concatenate(rings), np.array([len(r) for r in rings])
    first = np.cumsum(sizes) - sizes
    away = xy - xy[np.repeat(first, sizes)]
    far = _first_largest(np.hypot(away[:, 0], away[:, 1]), sizes)
    a, b = np.r_[first, far], np.r_[far, first + sizes - 1]
    keep = np.zeros(len(xy), bool)
    keep[a] = keep[b] = True
    while True:
        wide = b - a > 1
        a, b = a[wide], b[wide]
        if not len(a):
            break
        span, nth = _spread(b - a - 1)
        at = a[span] + 1 + nth
        d, e = (xy[b] - xy[a])[span], xy[at] - xy[a[span]]
        length = np.array([math.hypot(x, y) for x, y in (xy[b] - xy[a]).tolist()])[span]
        with np.errstate(invalid="ignore", divide="ignore"):
            away = np.where(length > 0, np.abs(d[:, 0] * e[:, 1] - d[:, 1] * e[:, 0]) / length, np.hypot(e[:, 0], e[:, 1]))
        m = _first_largest(away, b - a - 1)
        more = away[m] > tolerance
        m, a, b = at[m[more]], a[more], b[more]
        keep[m] = True
        a, b = np.r_[a, m], np.r_[m, b]
    parts = np.split(keep, first[1:])
    return [k if k.sum() >= 4 else np.ones(len(k), bool) for k in parts]


def _first_largest(value: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The place of the first largest value (NaN before all) of each run, of runs of these sizes."""
    start = np.cumsum(sizes) - sizes
    most = np.maximum.reduceat(value, start)
    run = np.repeat(np.arange(len(sizes)), sizes)
    hit = np.flatnonzero((value == most[run]) | np.isnan(value))
    return hit[np.unique(run[hit], return_index=True)[1]]


def _mended(shape: Shape, keep: list[np.ndarray]) -> Shape:
    """The shape of the points kept and of those that come back until no side is in the way."""
    while True:
        made = [r[k] for r, k in zip(shape, keep, strict=True)]
        bad = _sides_in_the_way(made) | _cutting_off(shape, keep)
        grown = False
        for ring_no, side in sorted(bad):
            places = np.flatnonzero(keep[ring_no])
            a, b = places[side], places[side + 1]
            if b - a > 1:
                ring = shape[ring_no]
                d, away = ring[b] - ring[a], ring[a + 1 : b] - ring[a]
                length = math.hypot(*d)
                distance = np.abs(d[0] * away[:, 1] - d[1] * away[:, 0]) / length if length else np.hypot(*away.T)
                keep[ring_no][a + 1 + int(distance.argmax())] = grown = True
        if not grown:
            return made


def _sides_in_the_way(shape: Shape) -> set[tuple[int, int]]:
    """(ring, side) of the sides that meet another one where they should not."""
    p, q = _sides_of(shape)
    sizes = [len(r) - 1 for r in shape]
    ring, place = np.repeat(np.arange(len(shape)), sizes), np.concatenate([np.arange(n) for n in sizes])
    i, j = near_pairs(p, q)
    wrong = _meet_wrongly(p, q, ring, place, np.array(sizes)[ring], i, j)
    return {(int(ring[k]), int(place[k])) for k in np.r_[i[wrong], j[wrong]]}


def _cutting_off(shape: Shape, keep: list[np.ndarray]) -> set[tuple[int, int]]:
    """(ring, side) of the new sides that have a corner of another ring between them and the points they leave out."""
    if len(shape) < 2:
        return set()
    out = set()
    for n, (ring, on) in enumerate(zip(shape, keep, strict=True)):
        others = np.concatenate([r[:1] for m, r in enumerate(shape) if m != n])
        places = np.flatnonzero(on)
        for side in np.flatnonzero(np.diff(places) > 1).tolist():
            part = ring[places[side] : places[side + 1] + 1]
            near = others[((others >= part.min(0)) & (others <= part.max(0))).all(1)]
            if len(near) and _windings(near, part, np.roll(part, -1, axis=0)).any():
                out.add((n, side))
    return out


def simplify(df: DataFrame, rings: str = "rings", tolerance: float = 5.0) -> DataFrame:
    """Df with simplified() shapes."""
    ship(df.sparkSession)

    @F.arrow_udf(RINGS)
    def thin(values: pa.Array) -> pa.Array:
        some = list(shapes(values))
        made = iter(simplified_all([s for s in some if s], tolerance))
        return column_of([next(made) if s else s for s in some])

    return df.withColumn(rings, thin(F.col(rings)))
