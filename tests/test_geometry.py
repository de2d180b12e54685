"""Ring sets, rasters, joins by cell, layout and percentiles against plain versions."""

import json
import math
import random
import struct
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fieldseries.functions.session import kept
from fieldseries.operators import geo, ranks, raster, ringsets, spatial
from fieldseries.sources import tables


def box(x, y, w=1.0, h=1.0):
    return np.array([[x, y], [x + w, y], [x + w, y + h], [x, y + h], [x, y]], float)


def size(shape):
    return sum(map(ringsets.signed, shape)) / 2


def wkb(kind, rings, end="<", flags=0, dims=2):
    code = struct.pack(end + "BI", end == "<", kind | flags) + (struct.pack(end + "I", 2154) if flags & 0x20000000 else b"")
    body = b"".join(struct.pack(end + "I", len(r)) + b"".join(struct.pack(f"{end}{dims}d", *p, *[9.0] * (dims - 2)) for p in r.tolist()) for r in rings)
    return code + struct.pack(end + "I", len(rings)) + body


SQUARE, HOLE = box(0, 0, 4, 4), box(1, 1, 2, 2)


def test_wkb_of_both_byte_orders_dimensions_and_parts():
    for end in "<>":
        assert size(ringsets.read_wkb(wkb(3, [SQUARE[::-1], HOLE], end))) == 12  # turned into place
        for flags, code, dims in ((0x80000000, 3, 3), (0xC0000000, 3, 4), (0x20000000, 3, 2), (0, 1003, 3), (0, 2003, 3), (0, 3003, 4)):
            assert size(ringsets.read_wkb(wkb(code, [SQUARE, HOLE], end, flags, dims))) == 12
        many = struct.pack(end + "BII", end == "<", 6, 2) + wkb(3, [SQUARE, HOLE], end) + wkb(3, [box(9, 9)], "<")
        assert size(ringsets.read_wkb(many)) == 13
    assert ringsets.read_wkb(wkb(3, [])) == []
    whole = wkb(3, [SQUARE])
    for bad in (whole[:-1], whole + b"\0", wkb(1, []), wkb(3, [SQUARE[:-1]]), b"\x02" + whole[1:], struct.pack("<BII", 1, 6, 1) + struct.pack("<BI", 1, 2)):
        with pytest.raises(ValueError, match="WKB"):
            ringsets.read_wkb(bad)
    for big in (False, True):
        assert size(ringsets.read_wkb(ringsets.write_wkb([SQUARE, HOLE[::-1], box(9, 9)], big))) == 13


def test_a_bad_geometry_fails_the_query(spark):
    with pytest.raises(Exception, match="neither a polygon nor a multipolygon"):
        tables.wkb_rings(spark.createDataFrame([(wkb(2, []),)], "g binary"), "g").collect()


def test_geojson_areas_of_all_kinds(spark, tmp_path):
    feature = lambda kind, c: {"properties": {"n": kind}, "geometry": kind and {"type": kind, "coordinates": c}}
    ring = lambda r: r.tolist()
    made = [feature("Polygon", [ring(SQUARE[::-1]), ring(HOLE)]), feature("MultiPolygon", [[ring(SQUARE), ring(HOLE)], [ring(box(9, 9))]]), feature(None, None)]
    (tmp_path / "a.json").write_text(json.dumps({"features": made}))
    got = tables.shapes(spark, str(tmp_path / "a.json"))
    assert [r[0] for r in got.select(ringsets.area(F.col("rings"))).collect()] == [12.0, 13.0, None]
    text = json.loads(got.select(ringsets.to_geojson(F.col("rings"))).collect()[1][0])
    assert text["type"] == "MultiPolygon" and sorted(map(len, text["coordinates"])) == [1, 2]
    (tmp_path / "b.json").write_text(json.dumps({"features": [feature("Point", [1, 2])]}))
    with pytest.raises(Exception, match="no polygon: Point"):
        tables.shapes(spark, str(tmp_path / "b.json")).collect()


def test_union_of_rectangles_covers_their_cells():
    r = random.Random(0)
    for _ in range(150):
        found = [(r.randint(0, 12), r.randint(0, 12), r.randint(1, 6), r.randint(1, 6)) for _ in range(r.randint(1, 14))]
        cells = {(x + i, y + j) for x, y, w, h in found for i in range(w) for j in range(h)}
        made = ringsets.union([[box(*f)] for f in found])
        assert size(made) == pytest.approx(len(cells)) and all((x[0] == x[-1]).all() for x in made)


def test_union_of_slanted_shapes_covers_their_points():
    r = random.Random(1)
    for k in range(25):
        parts = []
        for _ in range(r.randint(2, 8)):
            at, a = np.array([r.uniform(0, 10) + 7e5, r.uniform(0, 10) + 6.9e6]), np.sort([r.uniform(0, 2 * math.pi) for _ in range(r.randint(3, 9))])
            ring = at + np.column_stack([np.cos(a), np.sin(a)]) * r.uniform(1, 4)
            ring = np.vstack([ring, ring[:1]])
            if ringsets.signed(ring) > 0:
                parts.append([ring])
        g = np.random.default_rng(k)
        probes = np.column_stack([g.uniform(7e5 - 4, 7e5 + 14, 2000), g.uniform(6.9e6 - 4, 6.9e6 + 14, 2000)])
        cover = lambda shapes: ringsets._windings(probes, *ringsets._sides_of([x for s in shapes for x in s]))
        made = cover([ringsets.union(parts)])
        assert ((made > 0) == (cover(parts) > 0)).all() and set(made.tolist()) <= {0, 1}


def test_union_cases():
    ring = [box(0, 0, 3, 1), box(0, 2, 3, 1), box(0, 0, 1, 3), box(2, 0, 1, 3)]
    assert [ringsets.signed(x) / 2 for x in ringsets.union([[x] for x in ring])] == [9, -1]
    assert ringsets.union([[SQUARE], [SQUARE]])[0].tolist() == SQUARE.tolist()
    assert size(ringsets.union([[SQUARE, HOLE[::-1]], [HOLE]])) == 16 and len(ringsets.union([[SQUARE, HOLE[::-1]], [HOLE]])) == 1
    assert len(ringsets.union([[box(0, 0)], [box(1, 1)]])) == 2  # one common corner
    assert ringsets.union([]) == ringsets.union([[], []]) == []


def test_validity_of_large_rings_in_little_time():
    import time

    def wave(n):
        a = np.arange(n) * 2 * math.pi / n
        ring = np.column_stack([np.cos(a), np.sin(a)]) * (1000 + 50 * np.sin(37 * a))[:, None]
        return np.vstack([ring, ring[:1]])

    start = time.process_time()
    large = wave(10_000)
    assert ringsets.is_valid([large])
    large[[100, 101]] = large[[101, 100]]
    assert not ringsets.is_valid([large])
    assert ringsets.is_valid([wave(60_000)])
    assert time.process_time() - start < 5  # all pairs of the last would be 1.8 thousand million
    good = [[SQUARE, HOLE[::-1]], [box(0, 0), box(1, 1)]]
    bad = [[], [box(0, 0), box(1, 0)], [box(0, 0, 4, 4), box(2, 2, 4, 4)], [np.array([[0, 0], [2, 2], [2, 0], [0, 2], [0, 0]], float)], [np.array([[0, 0], [4, 0], [2, 0], [2, 2], [0, 0]], float)]]
    assert all(map(ringsets.is_valid, good)) and not any(map(ringsets.is_valid, bad))


def test_near_pairs_miss_no_meeting_boxes():
    g = np.random.default_rng(2)
    p = g.uniform(0, 100, (300, 2))
    q = p + g.normal(0, 1, (300, 2)) * g.choice([0.1, 3, 60], (300, 1))
    i, j = ringsets.near_pairs(p, q)
    low, high = np.minimum(p, q), np.maximum(p, q)
    want = {(a, b) for a in range(300) for b in range(a + 1, 300) if (low[a] <= high[b]).all() and (low[b] <= high[a]).all()}
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == want


def frame(spark, rows, names="id long"):
    return spark.createDataFrame([(*k, None if s is None else [[{"x": x, "y": y} for x, y in r.tolist()] for r in s]) for *k, s in rows], f"{names}, rings {ringsets.RINGS}")


def test_dissolve_keeps_single_parts_and_unites_many(spark):
    chain = [(1, [box(i, 0)]) for i in range(40)]
    df = frame(spark, [*chain, (2, [SQUARE, HOLE[::-1]]), (None, [box(0, 0)]), (None, [box(0.5, 0)]), (3, None)])
    for at_once in (256, 7):
        got = {r["id"]: (r["n_parts"], r["n"], r["a"]) for r in ringsets.dissolve(df, "id", at_once=at_once).select("id", "n_parts", F.size("rings").alias("n"), ringsets.area(F.col("rings")).alias("a")).collect()}
        assert got == {1: (40, 1, 40.0), 2: (1, 2, 12.0), None: (2, 1, 1.5), 3: (0, 0, 0.0)}
    assert ringsets.dissolve(df.limit(0), "id").count() == 0


def test_scanlines_equal_a_test_of_every_cell(spark):
    r = random.Random(4)
    grid = raster.Grid.around(0, 0, 100, 80, 5.0)
    for _ in range(60):
        shape = [np.array([(r.choice([r.uniform(-20, 120), 2.5 + 5 * r.randint(0, 20)]), r.choice([r.uniform(-20, 100), 2.5 + 5 * r.randint(0, 16)])) for _ in range(r.randint(3, 12))]) for _ in range(r.randint(1, 3))]
        shape = [np.vstack([x, x[:1]]) for x in shape]
        p, q = ringsets._sides_of(shape)

        def inside(x, y, p=p, q=q):
            met = (p[:, 1] > y) != (q[:, 1] > y)
            a, b = p[met], q[met]
            return ((x < (b[:, 0] - a[:, 0]) * (y - a[:, 1]) / (b[:, 1] - a[:, 1]) + a[:, 0]).sum()) % 2 == 1

        want = {(i, k) for i in range(grid.height) for k in range(grid.width) if inside(grid.xmin + (k + 0.5) * 5, grid.ymax - (i + 0.5) * 5)}
        who, row, first, last = raster.scanlines(*ringsets.all_sides(ringsets.column_of([[], shape])), grid)
        assert set(who.tolist()) <= {1}
        assert {(i, k) for i, a, b in zip(row.tolist(), first.tolist(), last.tolist(), strict=True) for k in range(a, b + 1)} == want and int((last - first + 1).sum()) == len(want)
    cells = raster.cells_within(frame(spark, [(1, [SQUARE * 10]), (2, []), (3, None)]), grid).collect()
    assert len(cells) == 64 and {c["id"] for c in cells} == {1}


def test_crop_keeps_repeated_pixels_and_counts_overlaps_once(spark):
    grid = raster.Grid.around(0, 0, 10_000, 20, 1.0)
    pixels = spark.createDataFrame([(5, c, v) for c in (0, 255, 256, 600, 601, 9_999) for v in (1, 1)] + [(None, 3, 1)], "row int, col int, v int")
    areas = frame(spark, [(1, [box(250, 0, 351, 20)]), (2, [box(255, 0, 346, 20)])])
    assert sorted(r["col"] for r in raster.crop(pixels, areas, grid).collect()) == [255, 255, 256, 256, 600, 600]
    assert raster.crop(pixels, areas.limit(0), grid).count() == 0


def test_spatial_join_equals_all_pairs(spark):
    r = random.Random(6)
    tri = lambda s: [np.array([[x, y], [x + r.uniform(0, s), y + r.uniform(0, s)], [x - r.uniform(0, s), y + r.uniform(0, s)], [x, y]]) for x, y in [(r.uniform(-50, 50), r.uniform(-50, 50))]]
    a = [(i, tri(r.choice([1, 5, 40]))) for i in range(120)] + [(200 + i, [box(0, 0, 2, 2)]) for i in range(30)]
    b = [(i, tri(r.choice([1, 30]))) for i in range(60)] + [(100, [box(-60, -60, 120, 120), box(-40, -40, 80, 80)[::-1]]), (101, [box(-1, -1, 9, 9)])]
    left = ringsets.with_envelope(frame(spark, a))
    right = frame(spark, b).withColumnsRenamed({"id": "other", "rings": "aoi"})
    got = sorted((x["id"], x["other"]) for x in spatial.in_areas(left, right, "rings").select("id", "other").collect())
    plain = left.crossJoin(right).where(ringsets.intersects(F.col("aoi"), F.col("rings")))
    want = sorted((x["id"], x["other"]) for x in plain.select("id", "other").collect())
    assert got == want and len(got) > 150
    boxed = ringsets.with_envelope(right, "aoi")
    for crowded, cells in ((5, 3.0), (10_000, 1000.0), (20, 1000.0)):
        again = spatial.spatial_join(left, boxed, ringsets.intersects(F.col("rings"), F.col("aoi")), cells, crowded)
        assert sorted((x["id"], x["other"]) for x in again.select("id", "other").collect()) == want
    plan = spatial.in_areas(left, right, "rings")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert spatial.in_areas(left, right.limit(0), "rings").count() == 0


def test_ring_sets_meet_as_single_rings_do(spark):
    r = random.Random(9)
    pairs = [(box(0, 0, 3, 3), box(r.uniform(-4, 4), r.uniform(-4, 4), r.uniform(0.1, 5), r.uniform(0.1, 5))) for _ in range(60)]
    df = spark.createDataFrame([([{"x": x, "y": y} for x, y in a.tolist()], [{"x": x, "y": y} for x, y in b.tolist()]) for a, b in pairs], "a array<struct<x:double,y:double>>, b array<struct<x:double,y:double>>")
    got = df.select(geo.intersects(F.col("a"), F.col("b")), ringsets.intersects(F.array("a"), F.array("b"))).collect()
    assert all(x == y for x, y in got) and 5 < sum(x for x, _ in got) < 55


def test_a_box_reads_few_row_groups(spark, tmp_path):
    fields = spark.range(40_000).select("id", (F.col("id") * 7919 % 60_000).cast("double").alias("xmin"), (F.col("id") * 104_729 % 50_000).cast("double").alias("ymin"))
    fields = fields.withColumns({"xmax": F.col("xmin") + 30, "ymax": F.col("ymin") + 20})
    wanted, path = (10_000.0, 10_000.0, 12_000.0, 12_000.0), str(tmp_path / "t")
    spatial.write_clustered(fields, path, files=32)
    got = spatial.read_box(spark, path, wanted)
    inside = lambda c: (c["xmin"] <= wanted[2]) & (c["xmax"] >= wanted[0]) & (c["ymin"] <= wanted[3]) & (c["ymax"] >= wanted[1])
    assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in fields.where(inside({c: F.col(c) for c in spatial.BOX})).collect()) and got.count() > 20
    groups = met = 0
    for f in map(pq.ParquetFile, Path(path).glob("*.parquet")):
        for g in range(f.metadata.num_row_groups):
            stat = {c.path_in_schema: c.statistics for c in map(f.metadata.row_group(g).column, range(f.metadata.num_columns))}
            groups += 1
            met += stat["xmin"].min <= wanted[2] and stat["xmax"].max >= wanted[0] and stat["ymin"].min <= wanted[3] and stat["ymax"].max >= wanted[1]
    assert groups >= 16 and met <= groups / 4
    assert "PushedFilters: [IsNotNull(xmin)" in got._jdf.queryExecution().toString()


def test_simplified_shapes_stay_valid_and_near(spark):
    r = random.Random(12)
    changed = 0
    for k in range(60):
        n = r.randint(12, 150)
        a = np.arange(n) * 2 * math.pi / n
        spike = np.array([r.choice([1.0, 1.0, r.uniform(0.15, 1.6)]) for _ in range(n)])
        ring = np.column_stack([np.cos(a), np.sin(a)]) * (30 * spike)[:, None]
        shape = [np.vstack([ring, ring[:1]])]
        if k % 2:
            shape.append(box(-2, -2, 4, 4)[::-1])
        if not ringsets.is_valid(shape):
            continue
        made = ringsets.simplified(shape, r.choice([2.0, 6.0, 12.0]))
        assert ringsets.is_valid(made) and len(made) == len(shape)
        assert all({tuple(x) for x in m.tolist()} <= {tuple(x) for x in s.tolist()} for m, s in zip(made, shape, strict=True))
        plain = [s[geo.keep_points(s[:, 0], s[:, 1], 12.0)] for s in shape]
        changed += sum(map(len, made)) < sum(map(len, shape)) and not ringsets.is_valid(plain)
    assert changed > 3  # shapes whose plain thinning is not valid
    bump = np.array([[0, 0], [40, 0], [40, 20], [22, 20], [20, 26], [18, 20], [0, 20], [0, 0]], float)
    pin = np.array([[20, 22], [19.8, 21.5], [20.2, 21.5], [20, 22]], float)[::-1]
    pin = pin if ringsets.signed(pin) < 0 else pin[::-1]
    held = ringsets.simplified([bump, pin], 10.0)
    assert ringsets._windings(held[1][:1], held[0][:-1], held[0][1:])[0] == 1  # the hole is still inside
    assert ringsets.simplified([bump], 10.0)[0].shape[0] < len(held[0])
    assert ringsets.simplify(frame(spark, [(1, None), (2, []), (3, [bump])]), tolerance=1.0).count() == 3


def test_z_order_interleaves_bits(spark):
    got = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (0.0, 1.0), (3.0, 5.0), (7.0, 7.0), (99.0, -5.0)], "x double, y double").select(spatial.z_order(F.col("x"), F.col("y"), (0, 0, 7, 7), 3)).collect()
    assert [r[0] for r in got] == [0, 1, 2, 0b100111, 63, 0b010101]


@pytest.mark.parametrize("one_task", [2_000_000, 3])
def test_percentiles_equal_numpy(spark, one_task):
    r = random.Random(8)
    rows = [(r.choice(["a", "b", None]), r.choice([1, 2]), r.choice([None, 0.0, 0.0, r.uniform(-5, 5)])) for _ in range(600)] + [("c", 1, None), ("d", 1, 4.0)]
    df = spark.createDataFrame(rows, "k string, m int, v double").repartition(7)
    cuts = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(x["k"], x["m"]): (x["n"], list(x["p"])) for x in ranks.percentiles(df, ["k", "m"], "v", cuts, one_task).collect()}
    assert set(got) == {x[:2] for x in rows} and got["c", 1] == (0, [None] * 6)
    assert sum(x["n_rows"] for x in ranks.percentiles(df, ["k", "m"], "v", cuts, one_task).collect()) == len(rows)
    for key, (n, p) in got.items():
        v = [x[2] for x in rows if x[:2] == key and x[2] is not None]
        assert n == len(v) and (not v or p == pytest.approx(np.percentile(v, [100 * c for c in cuts])))
    whole = ranks.percentiles(df, [], "v", cuts, one_task).first()
    assert list(whole["p"]) == pytest.approx(np.percentile([x[2] for x in rows if x[2] is not None], [100 * c for c in cuts]))
    assert ranks.percentiles(df.limit(0), [], "v", cuts, one_task).count() == 0


def test_ranks_over_many_parts(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v"), "id").repartition(9)
    got = ranks.ranked(df, [F.desc("v"), F.asc("id")], "rank", lambda x: kept(x, "ranked")).collect()
    assert [r["rank"] for r in sorted(got, key=lambda r: (-r["v"], r["id"]))] == list(range(1, 5001))


def test_fields_at_one_corner_are_dissolved_in_layers(spark, tmp_path):
    import duckdb
    import pyarrow as pa

    from fieldseries.plans import registry

    keys = [5, 105, 205, 300005, 600005, 300105, 7, 300007]
    pq.write_table(pa.table({"c_custkey": keys, "c_mktsegment": ["X"] * 8, "c_nationkey": [1, 2, 3, 9, 1, 2, 4, 4], "c_acctbal": [0.0] * 8}), f"{tmp_path}/customer.parquet")
    con = duckdb.connect()
    con.execute(f"create view customer as select * from '{tmp_path}/customer.parquet'")
    want = sorted(con.sql(registry.oracle_sql()["dissolve"]).fetchall())
    assert sorted(map(tuple, registry.queries()["dissolve"](spark, str(tmp_path)).select("id", "n_parties", "surface").collect())) == want


def test_the_union_of_many_parts_compares_near_sides_only(monkeypatch):
    """Windings by box and slab equal those over all sides; a union of very many parts no longer takes the latter."""
    r = np.random.default_rng(5)
    star = lambda x, y, n: np.array([[x + k * math.cos(t), y + k * math.sin(t)] for t, k in zip(np.linspace(0, 2 * math.pi, n, endpoint=False), r.uniform(0.3, 3, n), strict=True)])
    rings = [np.vstack([s, s[:1]]) for s in (star(*r.uniform(0, 30, 2), int(r.integers(3, 40))) for _ in range(80))]
    rings += [box(-5, -5, 60, 60), box(10, 10, 5, 5)[::-1], box(10, 10, 5, 5)]
    p, q = ringsets._sides_of(rings)
    at = np.vstack([r.uniform(-10, 60, (2000, 2)), r.integers(-6, 20, (500, 2)), p[:300]])
    ring = np.repeat(np.arange(len(rings)), [len(x) - 1 for x in rings])
    assert (ringsets._windings_near(at, p, q, ring) == ringsets._windings(at, p, q)).all()

    def never(*_):
        raise AssertionError("all points against all sides")

    monkeypatch.setattr(ringsets, "_windings", never)
    made = ringsets.union([[box(3 * (i % 100), 3 * (i // 100))] for i in range(5000)] + [[box(0.5, 0.5, 2.6)]])
    assert len(made) == 4999 and size(made) == pytest.approx(5000 + 2.6 - 0.25 - 0.05)


def test_rectangles_are_joined_by_their_boxes_and_others_by_their_sides(spark):
    r = np.random.default_rng(2)
    star = lambda x, y: np.array([[x + k * math.cos(t), y + k * math.sin(t)] for t, k in zip(np.linspace(0, 2 * math.pi, 7, endpoint=False), r.uniform(0.5, 4, 7), strict=True)])
    shape = lambda i: box(*r.uniform(0, 30, 2), *r.uniform(0.5, 5, 2))[:: 1 - 2 * (i % 2)] if i % 3 else (lambda s: np.vstack([s, s[:1]]))(star(*r.uniform(0, 30, 2)))
    frame = lambda n, id, ring: spark.createDataFrame([(i, shape(i).tolist()) for i in range(n)], f"{id} int, p array<array<double>>").selectExpr(id, f"transform(p, q -> struct(q[0] as x, q[1] as y)) as {ring}")
    parcels, areas = geo.with_envelope(frame(90, "id", "ring")), frame(60, "zone", "aoi")
    got = sorted(map(tuple, spatial.in_areas(parcels, areas).select("id", "zone").collect()))
    want = parcels.select("id", "ring").crossJoin(areas).where(ringsets.intersects(F.array("ring"), F.array("aoi"))).select("id", "zone")
    assert got == sorted(map(tuple, want.collect())) and got
    assert sorted(spatial.in_areas(parcels, areas).columns) == sorted([*parcels.columns, "zone", "aoi"])
    flags = parcels.select("id", spatial._is_box(F.array("ring")).alias("b")).collect()
    assert all(x["b"] == (x["id"] % 3 > 0) for x in flags)


def test_many_shapes_at_once_are_thinned_and_checked_as_each_alone(monkeypatch):
    r, some = np.random.default_rng(4), []
    for i in range(300):
        rings = []
        for k in range(1 + i % 3):
            n = int(r.integers(3, 120 if i % 50 == 0 else 25))
            t, far = np.sort(r.uniform(0, 2 * math.pi, n)), r.uniform(3, 30, n) / (k + 1)
            p = np.column_stack([far * np.cos(t), far * np.sin(t)]) + (0 if k < 2 else 15)
            p = np.round(p) if i % 7 == 0 else p
            rings.append(np.vstack([p, p[:1]])[:: 1 if k == 0 else -1])
        some.append(rings)
    monkeypatch.setattr(ringsets, "PAIRS_AT_ONCE", 5000, raising=False)
    alone = [ringsets.is_valid(s) for s in some]
    assert ringsets.are_valid(some) == alone and 0 < sum(alone) < 300
    thin = ringsets.simplified_all(some, 5.0)
    for shape, made in zip(some, thin, strict=True):
        keep = [np.r_[geo.keep_points(*x[: (f := int(np.hypot(*(x - x[0]).T).argmax())) + 1].T, 5.0)[:-1], geo.keep_points(*x[f:].T, 5.0)] for x in shape]
        plain = ringsets._mended(shape, [k if k.sum() >= 4 else np.ones(len(k), bool) for k in keep])
        assert all(np.array_equal(a, b) for a, b in zip(made, plain, strict=True))
    small = [s for s in some if sum(map(len, s)) < 60]
    monkeypatch.setattr(ringsets, "near_pairs", lambda *_: pytest.fail("a small shape on its own"))
    assert len(ringsets.are_valid(small)) == len(small)
