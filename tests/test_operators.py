"""Hand-computed fixtures of the operators and their traps."""

import math
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldseries.functions import columns as C
from fieldseries.operators import api, catalog, composites, divergence, features, geo, imputation, phenology, quality, ringsets, sinks, smoothing, split, zonal


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_zonal_percentiles_are_exact_and_missing_values_do_not_count(spark):
    px = spark.createDataFrame([("a", 5.0), ("b", 1.0), ("b", 2.0), ("b", 4.0), ("b", 8.0), ("b", math.nan), ("c", math.nan)], "id string, value double")
    got = {r["id"]: r for r in zonal.zonal_stats(C.nan_to_null(px), ["id"]).collect()}
    assert set(got) == {"a", "b"}
    assert got["a"]["std"] == 0.0
    assert got["b"]["p10"] == pytest.approx(1.3) and got["b"]["p90"] == pytest.approx(6.8) and got["b"]["std"] == pytest.approx(2.68095, abs=1e-5)


def test_two_stage_median_is_not_the_overall_one(spark):
    px = spark.createDataFrame([(1, date(2024, 1, 1), 0.0), (1, date(2024, 1, 1), 1.0), (1, date(2024, 1, 1), 2.0), (1, date(2024, 1, 2), 9.0), (2, date(2024, 1, 1), None)], "px int, date date, value double")
    assert rows(composites.two_stage_median(px, ["px"]), "px") == [(1, "2024-01", 5.0), (2, "2024-01", None)]


def test_completeness_counts_zeros(spark):
    n = spark.createDataFrame([("a", x) for x in (0, 0, 3, 1)], "id string, n_valid int")
    assert rows(zonal.completeness(n, ["id"]), "id") == [("a", 1.0, 50.0)]


def test_indices_guard_their_denominators(spark):
    one = spark.range(1).select(C.normalized_difference(F.lit(0.0), F.lit(0.0)).alias("a"), C.evi(F.lit(0.0), F.lit(0.0), F.lit(10000 / 7.5)).alias("b"), C.valid_pixel(F.lit(7), F.lit(3.0)).alias("c"), C.valid_pixel(F.lit(4), F.lit(0.0)).alias("d")).first()
    assert (one["a"], one["b"], one["c"], one["d"]) == (0.0, 0.0, None, None)


def test_class_map(spark):
    df = spark.createDataFrame([("1", "X"), ("24", "BTN"), ("1", "BTN"), ("99", "X"), (None, "X"), ("z", None)], "g string, c string")
    assert [r[0] for r in df.select(C.crop_class(F.col("g"), F.col("c"))).collect()] == ["cereales_hiver", "betterave", "betterave", "autres", "autres", "autres"]


def test_scene_names(spark):
    name = F.lit("S2B_MSIL2A_20240105T105339_N0510_R051_T30UYV_20240105")
    assert spark.range(1).select(C.scene_tile(name), C.scene_date(name), C.utm_epsg(F.lit("30UYV"))).first() == ("30UYV", "20240105", 32630)


def test_catalogue_keeps_the_greatest_name_and_fills_months(spark):
    s = spark.createDataFrame([("S2A_N0509", "t", date(2024, 1, 3), "nord"), ("S2B_N0510", "t", date(2024, 1, 3), "sud"), ("S2A_x", "t", date(2024, 3, 1), "nord")], "scene_id string, tile_id string, date date, pair string")
    assert [r["scene_id"] for r in catalog.dedup_latest(s, ["tile_id", "date"]).orderBy("date").collect()] == ["S2B_N0510", "S2A_x"]
    assert rows(catalog.monthly_availability(s), "mois") == [("2024-01", 2, 1, 1, 31, 3.2, 3.2), ("2024-02", 0, 0, 0, 29, 0.0, 0.0), ("2024-03", 1, 1, 0, 31, 3.2, 0.0)]


def test_first_non_null_of_each_column(spark):
    df = spark.createDataFrame([("a", 3, None, "x"), ("a", 2, 1.0, None), ("a", 1, 2.0, "y")], "k string, o int, v double, w string")
    assert rows(catalog.first_nonnull(df, ["k"], ["o"]), "k") == [("a", 3, 1.0, "x")]


def test_imputation_tiers_and_edges(spark):
    assert [r[0] for r in spark.createDataFrame([(0.0,), (0.3,), (40.0,), (None,)], "p double").select(imputation.qc_action(F.col("p"))).collect()] == ["exclure", "imputer", "conserver", "conserver"]
    months = [f"2024-0{m}" for m in range(1, 7)]
    tiers = ["imputer", "conserver", "imputer", "exclure", "imputer", "exclure"]
    v, w = [None, 4.0, None, 8.0, None, None], [None, None, 7.0, None, None, None]
    cells = spark.createDataFrame([("a", *x) for x in zip(months, tiers, v, w, strict=True)] + [("b", months[0], "imputer", None, None)], "id string, mois string, action string, v double, w double")
    got = {(r["id"], r["variable"], r["mois"]): (r["action"], r["value"]) for r in imputation.impute(cells, "id", ["v", "w"]).collect()}
    forced = {(r["id"], r["mois"]): r["value"] for r in imputation.impute(cells.where("id = 'a'").na.fill({"v": 1.0}), "id", ["v"], force=True).collect()}
    assert forced["a", months[2]] == 6.0 and forced["a", months[1]] == 4.0  # between 4 and 8, whatever stood there
    with pytest.raises(Exception, match="(?i)duplicate"):
        imputation.impute(cells.union(cells), "id", ["v"]).collect()
    assert got["a", "v", months[0]] == ("imputer", 4.0)  # constant beyond the first value
    assert got["a", "v", months[2]] == ("imputer", 6.0)
    assert got["a", "w", months[2]] == ("imputer", 7.0)  # a value that is there stays
    assert got["a", "v", months[4]] == ("exclure", None)  # no neighbour within a month
    assert got["b", "v", months[0]] == ("imputer", None)  # a missing cell is a neighbour, but gives no value


def test_divergence(spark):
    data = [("p", "c", "f", 1.0), ("q", "c", "f", 1.0), ("r", "c", "f", 4.0), ("p", "c", "g", 2.0), ("q", "c", "g", 2.0), ("r", "c", "g", 2.0), ("s", "c", "f", None), ("s", "c", "g", None)]
    df = spark.createDataFrame(data, "id string, classe string, feature string, value double")
    d = divergence.rms_distance(divergence.zscore(df), "id")
    got = {r["id"]: r for r in d.collect()}
    assert got["p"]["dist_classe"] == 0.0 and got["s"]["dist_classe"] is None and got["s"]["pct_features_valides"] == 0.0
    assert got["r"]["dist_classe"] == pytest.approx(math.sqrt((3 / math.sqrt(2)) ** 2 / 2))
    assert {r["id"]: r["divergent"] for r in divergence.flags(d).collect()} == {"p": False, "q": False, "r": False, "s": False}
    assert divergence.rates(divergence.flags(d, k=-1.0)).first()["taux"] == 0.75


def test_bins_round_up_and_clip(spark):
    days = [0, 1, 4, 5, 6, 10]
    obs = spark.createDataFrame([("a", date(2024, 1, 1 + d), float(d), 2) for d in days] + [("a", date(2024, 1, 12), 1.0, 1)], "id string, date date, ndvi double, n_pixels int")
    assert [r["idx"] for r in smoothing.weighted_bins(obs, "id").orderBy("idx").collect()] == [0, 1, 2]
    assert smoothing.weighted_bins(obs, "id").where("idx = 2").first()["v"] == pytest.approx((6 * 2 + 10 * 2 + 1) / 5)


def test_whittaker_equals_a_dense_solve(spark):
    rng = np.random.default_rng(1)
    y, w = rng.normal(size=(5, 12)), rng.integers(0, 3, (5, 12)).astype(float)
    w[3] = 0
    w[4] = 0
    w[4, 2] = 1
    d2 = np.diff(np.eye(12), 2, axis=0)
    want = [np.linalg.solve(np.diag(b) + 800 * d2.T @ d2 + 1e-6 * np.eye(12), b * a) for a, b in zip(y[:3], w[:3], strict=True)]
    got = smoothing.smooth_rows(y, w)
    assert np.allclose(got[:3], want, atol=1e-8) and np.isnan(got[3:]).all()
    series = spark.createDataFrame([(i, y[i].tolist(), w[i].tolist()) for i in range(5)], "id int, y array<double>, w array<double>")
    out = {r["id"]: r["z"] for r in smoothing.whittaker(series, "id").collect()}
    assert out[3] is None and np.allclose(out[1], want[1], atol=1e-8)


def season_by_hand(y, lo, hi, step=5, fraction=0.2):
    pts = [(i, v) for i, v in enumerate(y) if v is not None and lo <= i * step <= hi]
    if not pts:
        return None
    top = max(v for _, v in pts)
    p = next(i for i, v in pts if v == top)
    left, right = [x for x in pts if x[0] <= p], [x for x in pts if x[0] >= p]
    a, b = min(v for _, v in left), min(v for _, v in right)
    if top <= a and top <= b:
        return None
    s = [i for i, v in left if v <= (a + fraction * (top - a) if top > a else top)]
    e = [i for i, v in right if v <= (b + fraction * (top - b) if top > b else top)]
    return (s[-1] if s else pts[0][0], p, e[0] if e else pts[-1][0])


def test_seasons_equal_a_plain_version(spark):
    rng = np.random.default_rng(2)
    cases = [[float(x) for x in rng.integers(0, 6, 100)] for _ in range(20)] + [[0.0] * 100, [None] * 100, [float(i) for i in range(100)], [float(-i) for i in range(100)]]
    df = spark.createDataFrame([(i, "colza" if i % 2 else "prairie", y) for i, y in enumerate(cases)], "id int, classe string, z array<double>")
    for r in phenology.seasons(df, "2023-09-01").collect():
        want = season_by_hand(cases[r["id"]], *((5, 380) if r["id"] % 2 else (0, 10**6)))
        day = lambda x: (x - date(2023, 9, 1)).days // 5
        if want is None:
            assert r["sos_date"] is None and r["fiable"] and not r["pos_en_bord"]
        else:
            assert (day(r["sos_date"]), day(r["pos_date"]), day(r["eos_date"])) == want
            assert r["los_jours"] == 5 * (want[2] - want[0])


def test_block_split_draws_whole_blocks(spark):
    p = spark.createDataFrame([(i, float(i % 7 * 10000), float(i % 3 * 10000)) for i in range(100)], "id int, cx double, cy double")
    got = split.block_split(split.block_ids(p), "id").collect()
    kinds = {}
    for r in got:
        kinds.setdefault(r["block_id"], set()).add(r["split"])
    assert all(len(v) == 1 for v in kinds.values()) and sum(v == {"test"} for v in kinds.values()) == int(0.2 * 21)


def test_geometry(spark):
    def ring(*xy):
        return F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in xy])

    t = ring((0, 0), (4, 0), (0, 3), (0, 0))
    one = spark.range(1).select(geo.area(t), geo.perimeter(t), geo.centroid(t)["x"], geo.contains(t, F.lit(1.0), F.lit(1.0)), geo.contains(t, F.lit(3.0), F.lit(3.0)), geo.closed(t), geo.distance_to_line(t, F.lit(-3.0), F.lit(-4.0))).first()
    assert tuple(one) == (6.0, 12.0, pytest.approx(4 / 3), True, False, True, 5.0)
    hit = spark.range(1).select(geo.meets_box(t, (3.5, 2.5, 5, 5)), geo.meets_box(t, (1, 1, 1.1, 1.1)), geo.meets_box(t, (-9, -9, 9, 9)), geo.meets_box(t, (1, -1, 1.5, 9))).first()
    assert tuple(hit) == (False, True, True, True)


def test_lambert_and_back(spark):
    p = geo.lambert93(F.lit(0.75), F.lit(49.4))
    back = spark.range(1).select(p["x"], p["y"], geo.from_lambert93(p["x"], p["y"])["lon"], geo.from_lambert93(p["x"], p["y"])["lat"]).first()
    assert 536_000 < back[0] < 538_000 and 6_924_000 < back[1] < 6_928_000
    assert back[2] == pytest.approx(0.75, abs=1e-9) and back[3] == pytest.approx(49.4, abs=1e-9)


def test_box_limits(spark):
    assert 16 < api.box_area_km2((0.72, 49.39, 0.79, 49.42)) < 18
    df = spark.createDataFrame([(i,) for i in range(4)], "id int")
    small = (0.72, 49.39, 0.73, 49.40)
    assert api.parcels_in_box(df, small, "id", 4).truncated is False
    page = api.parcels_in_box(df, small, "id", 3)
    assert page.truncated and page.total == 4 and page.rows.count() == 3
    with pytest.raises(api.BboxTooLargeError) as e:
        api.parcels_in_box(df, (-5, 42, 8, 51), "id")
    assert e.value.area > 900_000
    with pytest.raises(ValueError):
        api.parse_bbox("1,2,3")


def test_the_limit_is_compared_after_rounding(spark, monkeypatch):
    df = spark.createDataFrame([(1,)], "id int")
    for metres, accepted in ((50.04e6, True), (50.06e6, False)):
        monkeypatch.setattr(geo, "box_corners", lambda box, m=metres: [(0, 0), (m, 0), (m, 1), (0, 1), (0, 0)])
        if accepted:
            assert api.parcels_in_box(df, (0, 0, 1, 1), "id").total == 1
        else:
            with pytest.raises(api.BboxTooLargeError):
                api.parcels_in_box(df, (0, 0, 1, 1), "id")


def ring(*points):
    return geo.ring_of(list(points))


def test_rings_meet_and_are_valid(spark):
    a, b = ring((0, 0), (4, 0), (4, 4), (0, 4), (0, 0)), ring((1, 1), (2, 1), (2, 2), (1, 1))
    c, d = ring((4, 4), (6, 4), (6, 6), (4, 4)), ring((5, 0), (6, 0), (6, 1), (5, 0))
    cross, bow = ring((-1, 1), (9, 1), (9, 2), (-1, 2), (-1, 1)), ring((0, 0), (2, 2), (2, 0), (0, 2), (0, 0))
    got = spark.range(1).select(geo.intersects(a, b), geo.intersects(b, a), geo.intersects(a, c), geo.intersects(a, d), geo.intersects(a, cross), geo.valid(a), geo.valid(bow), geo.valid(ring((0, 0), (1, 0), (0, 0)))).first()
    assert tuple(got) == (True, True, True, False, True, True, False, False)


def test_wkt_and_footprints(spark):
    df = spark.createDataFrame([("geography'SRID=4326;POLYGON((0 0, 4 0, 4 4, 0 0))'",)], "t string")
    got = df.select(geo.wkt_ring(geo.footprint(F.col("t"))).alias("r")).first()["r"]
    assert [tuple(p) for p in got] == [(0, 0), (4, 0), (4, 4), (0, 0)]


def test_unknown_parcels_and_feature_order(spark):
    m = spark.createDataFrame([("a", "2024-02", "NDVI", 0.5)], "id string, mois string, variable string, mean double")
    known = spark.createDataFrame([("a", True)], "id string, divergent boolean")
    assert api.parcel_detail(known, "id", "a").columns == ["id", "divergente"]
    assert api.parcel_profile(m, known, "id", "a", ["2024-01", "2024-02"]).first()["ndvi"] == [None, 0.5]
    for call in (lambda: api.parcel_detail(known, "id", "b"), lambda: api.parcel_profile(m, known, "id", "b", ["2024-01"])):
        with pytest.raises(api.UnknownParcelError):
            call()
    page = spark.createDataFrame([(i,) for i in (10, 2, 1)], "id int").withColumn("ring", ring((7e5, 6.6e6), (7.1e5, 6.6e6), (7e5, 6.7e6), (7e5, 6.6e6)))
    import json

    made = json.loads(api.feature_collection(page, "ring", "id", 9, True).first()["geojson"])
    assert [f["properties"]["id"] for f in made["features"]] == [1, 2, 10] and (made["retourne"], made["total_disponible"], made["tronque"]) == (3, 9, True)
    assert made["features"][0]["geometry"]["coordinates"][0][0] == pytest.approx([3.0, 46.5], abs=1e-6)


def test_profile_is_aligned_with_the_calendar(spark):
    m = spark.createDataFrame([("a", "2024-02", "NDVI", 0.5), ("a", "2024-01", "XX", 0.1)], "id string, mois string, variable string, mean double")
    ids = spark.createDataFrame([("a",), ("b",)], "id string")
    assert rows(api.aligned_profile(m, ids, "id", ["2024-01", "2024-02"]).select("id", "ndvi"), "id") == [("a", [None, 0.5]), ("b", [None, None])]


def test_profile_means_are_added_up_in_the_order_of_the_table(spark, tmp_path):
    """Sums of doubles in another order end in other digits, and a mean just below a half is rounded otherwise."""
    import duckdb
    import pyarrow as pa
    import pyarrow.parquet as pq
    from datetime import datetime

    from fieldseries.plans import registry
    from fieldseries.sources import analogues as A

    r, n = np.random.default_rng(3), 4000
    order = r.permutation(n)
    at = [datetime(1998, 1 + int(k) % 8, 3) for k in r.integers(0, 8, n)]
    ids, zeros = pa.array(order), pa.array(np.zeros(n))
    pq.write_table(pa.table({"l_orderkey": ids, "l_shipdate": pa.array(at, pa.timestamp("us")), "l_quantity": zeros, "l_extendedprice": pa.array(r.integers(90000, 10000000, n) / 100), "l_discount": pa.array(r.integers(0, 11, n) / 100), "l_tax": pa.array(r.integers(0, 9, n) / 100)}), f"{tmp_path}/lineitem.parquet", row_group_size=500)
    pq.write_table(pa.table({"o_orderkey": pa.array(np.arange(n)), "o_custkey": pa.array(np.arange(n) % 40)}), f"{tmp_path}/orders.parquet")
    c = np.arange(40)
    pq.write_table(pa.table({"c_custkey": pa.array(c), "c_mktsegment": pa.array(["X"] * 40), "c_nationkey": pa.array(c % 5), "c_acctbal": pa.array(c * 1.0)}), f"{tmp_path}/customer.parquet")
    con = duckdb.connect()
    con.execute("set threads = 1")  # several threads add up in no fixed order
    for t in ("lineitem", "orders", "customer"):
        con.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet'")
    columns = ["id_parcel", *A.VARIABLES]
    want = sorted(con.sql(registry.oracle_sql()["aligned_profile"]).select(*columns).fetchall())
    other = spark.newSession()
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    got = sorted(tuple(x) for x in registry.queries()["aligned_profile"](other, str(tmp_path)).select(*columns).collect())
    assert got == want


def test_sinks_and_manifest(spark, tmp_path):
    old, new = spark.createDataFrame([(1, "o"), (2, "o")], "k int, v string"), spark.createDataFrame([(2, "n"), (3, "n")], "k int, v string")
    assert rows(sinks.insert_if_absent(old, new, ["k"]), "k") == [(1, "o"), (2, "o"), (3, "n")]
    assert rows(sinks.upsert(old, new, ["k"]), "k") == [(1, "o"), (2, "n"), (3, "n")]
    with pytest.raises(Exception, match="two new rows have one key"):
        sinks.upsert(old, new.union(new), ["k"]).collect()
    assert sinks.upsert(old.withColumn("t", F.lit(None).cast("timestamp")), new, ["k"], stamp="t").where("t IS NULL").count() == 1
    assert sinks.replace_table(old, "replaced_once", 2) == sinks.replace_table(old, "replaced_once") == 2
    with pytest.raises(ValueError, match="expected"):
        sinks.replace_table(old, "replaced_once", 3)
    want = spark.createDataFrame([(1, 5), (2, 5), (3, 5)], "k int, src_max_ts int")
    have = spark.createDataFrame([(1, "v", 5), (2, "v", 4), (3, "u", 9)], "k int, version string, src_max_ts int")
    assert rows(sinks.pending(want, have, ["k"], "v"), "k") == [(2, 5), (3, 5)]
    sinks.write_version(old, str(tmp_path / "t"), 1)
    with pytest.raises(Exception, match="already exists"):
        sinks.write_version(old, str(tmp_path / "t"), 1)


def test_wide_features_refuse_repeated_keys(spark):
    df = spark.createDataFrame([(1, "NDVI", "2024-01", 0.5)] * 2, "id int, variable string, mois string, mean double")
    with pytest.raises(Exception, match="two rows have one key"):
        features.wide(df, "id", ["mean"], ["NDVI"], ["2024-01"]).collect()
    assert features.wide(df.limit(1), "id", ["mean"], ["NDVI"], ["2024-01"]).first()["NDVI_mean_2024-01"] == 0.5


def test_violations(spark):
    df = spark.createDataFrame([(1, "train"), (1, None), (2, "x")], "id int, split string")
    assert dict(rows(quality.violations(df, ["id"], ["split"], {"split": ["train", "test"]}), "contrainte")) == {"cle": 1, "domaine:split": 1, "not_null:split": 1}


def test_stream_upserts_in_order(spark, tmp_path):
    from fieldseries.streaming import ingest

    schema = "k int, v string"
    first = spark.createDataFrame([(1, "a"), (2, "a")], schema)
    first.coalesce(1).write.parquet(str(tmp_path / "in"))
    q = ingest.start(spark, str(tmp_path / "in"), first.schema, str(tmp_path / "out"), ["k"], str(tmp_path / "cp"))
    q.awaitTermination()
    spark.createDataFrame([(2, "b")], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    q = ingest.start(spark, str(tmp_path / "in"), first.schema, str(tmp_path / "out"), ["k"], str(tmp_path / "cp"))
    q.awaitTermination()
    assert rows(ingest.current(spark, str(tmp_path / "out")), "k") == [(1, "a"), (2, "b")]
    # a fresh checkpoint goes on from the table, and a half-written version is none
    (tmp_path / "out/v000000002-000000000000-0").mkdir()
    spark.createDataFrame([(3, "c"), (3, "b")], schema).coalesce(1).write.parquet(str(tmp_path / "in2"))
    for _ in range(2):
        ingest.start(spark, str(tmp_path / "in2"), first.schema, str(tmp_path / "out"), ["k"], str(tmp_path / "cp2"), order=["v"]).awaitTermination()
    assert rows(ingest.current(spark, str(tmp_path / "out")), "k") == [(1, "a"), (2, "b"), (3, "c")]
    assert len(ingest.versions(spark, str(tmp_path / "out"))) == 3


def test_sources(spark, tmp_path):
    from fieldseries.sources import tables

    (tmp_path / "c.json").write_text('{"value": [{"Id": "1", "Name": "S2A.SAFE", "ContentDate": {"Start": "2024-01-01T00:00:00Z"}, "Attributes": [{"Name": "cloudCover", "Value": "3.5"}]}]}')
    one = tables.catalogue(spark, str(tmp_path / "c.json")).first()
    assert (one["scene_id"], one["cloud_cover_catalogue"], one["orbit_relative"]) == ("S2A", 3.5, None)
    (tmp_path / "g.json").write_text('{"features": [{"properties": {"a": "b"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [0, 1], [0, 0]]]}}]}')
    poly = tables.polygons(spark, str(tmp_path / "g.json"))
    assert poly.select(geo.area(F.col("ring"))).first()[0] == 0.5
    assert tables.feature_properties(spark, str(tmp_path / "g.json")).first()["properties"] == {"a": "b"}
    assert tables.fingerprints(spark, str(tmp_path / "c.json")).count() == 1
    tables.write_reference(spark, str(tmp_path / "g.json"), str(tmp_path / "csv"), ["a"])
    assert spark.read.csv(str(tmp_path / "csv"), header=True).first()["a"] == "b"
    import struct

    wkb = struct.pack("<BIII8d", 1, 3, 1, 4, 0, 0, 1, 0, 0, 1, 0, 0)
    got = tables.wkb_rings(spark.createDataFrame([(wkb,), (None,)], "g binary"), "g")
    assert [r[0] for r in got.select(ringsets.area(F.col("rings"))).collect()] == [0.5, None]


def test_the_daily_grid_spans_all_dates(spark, tmp_path):
    from fieldseries.plans import registry

    events = spark.range(45).selectExpr("1L AS user_id", "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, int(id)) AS ts", "'t' AS event_type", "100.0D AS value", "'{\"k\": 1}' AS props")
    events.write.parquet(f"{tmp_path}/events.parquet")
    assert [len(r["z"]) for r in registry.queries()["whittaker"](spark, str(tmp_path)).collect()] == [45]
    for name in ("sf0.001", "sf0.01"):
        assert {len(r["z"]) for r in registry.queries()["whittaker"](spark, f"/root/testdata/{name}").where("z IS NOT NULL").collect()} == {30}


def test_the_registered_forest_is_the_operators_own(spark, monkeypatch):
    from fieldseries.operators import model
    from fieldseries.plans import registry

    seen, train = [], model.train
    monkeypatch.setattr(model, "train", lambda *args, **named: seen.append(train(*args, **named)) or seen[-1])
    got = registry.queries()["rf_predict"](spark, "/root/testdata/sf0.001")
    forest = seen[0].stages[1]
    assert (forest.getNumTrees, forest.getOrDefault("maxDepth")) == (300, 30) and got.count() == 500


def test_the_entry_points_run_one_after_another(spark, tmp_path):
    import json

    from fieldseries import cli

    r, d = np.random.default_rng(0), str(tmp_path)
    corner = lambda i: (700_000 + 200 * (i % 8), 6_600_000 + 12_000 * (i // 20) + 200 * (i % 20 // 8))
    square = lambda x, y: [(float(a), float(b)) for a, b in ((x, y), (x + 90, y), (x + 90, y + 90), (x, y + 90), (x, y))]
    parcels = [(f"p{i:02d}", square(*corner(i)), str(1 + i % 2), "X") for i in range(40)] + [("far", square(800_000, 6_600_000), "1", "X")]
    parcels += [("p00", square(corner(0)[0] + 90, corner(0)[1]), "1", "X"), ("p03", square(corner(3)[0], corner(3)[1] + 100), "2", "X")]  # parts: one adjoins, one lies apart
    spark.createDataFrame(parcels, "id_parcel string, ring array<struct<x:double,y:double>>, code_group string, code_cultu string").write.parquet(f"{d}/parcels")
    (tmp_path / "aoi.geojson").write_text(json.dumps({"features": [{"properties": {}, "geometry": {"type": "Polygon", "coordinates": [[[2.9, 46.4], [3.1, 46.4], [3.1, 46.7], [2.9, 46.7], [2.9, 46.4]]]}}]}))
    names = [f"S2A_MSIL2A_2024{m:02d}{day:02d}T1_N0510_R051_T30UYV_X{m}.SAFE" for m in range(3, 7) for day in (3, 18)]
    scene = lambda n: {"Id": n[-9:], "Name": n, "ContentDate": {"Start": f"{n[11:15]}-{n[15:17]}-{n[17:19]}T00:00:00Z"}, "Footprint": "geography'SRID=4326;POLYGON ((3.0 46.4, 3.1 46.4, 3.1 46.7, 3.0 46.7, 3.0 46.4))'", "Attributes": [{"Name": "relativeOrbitNumber", "Value": "51"}]}
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages/a.json").write_text(json.dumps({"value": [scene(n) for n in names]}))
    cli.main(["ingest", d], spark)
    kept = spark.read.parquet(f"{d}/parcels_aoi")
    assert kept.count() == 42 and spark.read.parquet(f"{d}/catalogue").count() == 8
    from fieldseries.operators import raster

    whole = {r["id_parcel"]: r for r in spark.read.parquet(f"{d}/parcels_whole").collect()}
    assert len(whole) == 40 and {i: (len(r["rings"]), r["n_parts"]) for i, r in whole.items() if r["n_parts"] > 1} == {"p00": (1, 2), "p03": (2, 2)}
    cells = raster.rasterize(kept, raster.Grid.of(kept, "rings"), "id_parcel", "rings").collect()
    obs = [(n.removesuffix(".SAFE"), "30UYV", date(2024, int(n[15:17]), int(n[17:19])), c["row"], c["col"], 4 if r.random() > 0.1 else 9, *[float(1000 + 500 * b + 300 * int(c["id_parcel"][1:]) % 2 + r.integers(90) + 200 * int(n[15:17])) for b in range(7)]) for n in names for c in cells]
    spark.createDataFrame(obs, "scene_id string, tile_id string, date date, row int, col int, scl int, b02 double, b04 double, b05 double, b06 double, b07 double, b08 double, b11 double").write.parquet(f"{d}/pixel_obs")
    cli.main(["process", d], spark)
    assert spark.read.parquet(f"{d}/monthly").count() == 40 * 4 * 11
    cli.ml(spark, d, trees=5, depth=4)
    assert spark.read.parquet(f"{d}/classification").count() == 40 and spark.read.parquet(f"{d}/report_model").count() == 3
    assert 0 < spark.read.parquet(f"{d}/report_unseen").first()["n"] <= 40
    cli.main(["phenology", d], spark)
    assert spark.read.parquet(f"{d}/phenology").count() == 40 == spark.read.parquet(f"{d}/divergence").count()
    seam = {r["id_parcel"]: r for r in spark.read.parquet(f"{d}/divergence").collect()}
    assert seam["p00"]["zone_raccord_orbital"] and seam["p00"]["dist_raccord"] < 200 and all(r["dist_raccord"] is not None for r in seam.values())


def test_search_and_unseen_rows(spark):
    from fieldseries.operators import model

    data = [(i, [float(i % 2), float(i % 5)], "ab"[i % 2]) for i in range(60)]
    df = spark.createDataFrame(data, "id int, x array<double>, classe string")
    found = model.search(df, "x", "classe", "id", {"trees": (3, 5), "depth": (2,), "least": (1,)}, draws=2, parts=2).collect()
    assert len(found) == 2 and found[0]["f1_macro"] == 1.0
    assert model.unseen_score(df, "x", "classe", "id", parts=2, trees=3, depth=2, least=1).first()["accuracy"] == 1.0
    fitted = model.train(df, "x", "classe", trees=3, depth=2, least=1)
    ranked = model.importances(fitted, ["a", "b"], df, top=1).collect()
    assert [(r["feature"], r["rang"]) for r in ranked] == [("a", 1)]


def test_statistics_of_several_variables_equal_those_of_one(spark):
    data = [(1, 1.0, None), (1, 2.0, None), (1, None, None), (1, 4.0, 5.0), (1, 8.0, 7.0), (2, None, 3.0)]
    df = C.nan_to_null(spark.createDataFrame(data, "id int, a double, b double"))
    got = {(r["id"], r["variable"]): tuple(r)[2:] for r in zonal.zonal_stats_of(df, ["id"], ["a", "b"]).collect()}
    want = {(r["id"], r["variable"]): tuple(r)[2:] for r in zonal.zonal_stats(df.unpivot(["id"], ["a", "b"], "variable", "value"), ["id", "variable"]).collect()}
    assert set(got) == set(want) == {(1, "a"), (1, "b"), (2, "b")}
    assert all(got[k] == pytest.approx(want[k]) for k in got)


def test_statistics_by_batches_equal_plain_ones(spark, monkeypatch):
    r = np.random.default_rng(3)
    data = [(None if k == 0 else int(k), "ab"[int(m)], None if r.random() < 0.2 else float(v), float(v) * 2) for k, m, v in zip(r.integers(0, 9, 700), r.integers(0, 2, 700), r.normal(0, 9, 700), strict=True)]
    data += [(99, "a", float(i), None) for i in range(300)] + [(98, "a", None, None)]
    df = spark.createDataFrame(data, "k int, m string, v double, w double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")  # groups lie across batches
    try:
        got = {(x["k"], x["m"], x["variable"]): tuple(x)[3:] for x in zonal.zonal_stats_of(df, ["k", "m"], ["v", "w"]).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    groups = {}
    for k, m, v, w in data:
        for name, x in (("v", v), ("w", w)):
            if x is not None:
                groups.setdefault((k, m, name), []).append(x)
    assert set(got) == set(groups)
    for key, x in groups.items():
        assert got[key] == pytest.approx((np.mean(x), np.std(x), np.percentile(x, 10), np.percentile(x, 90)))
    assert zonal.zonal_stats_of(df.limit(0), ["k"], ["v"]).count() == 0
