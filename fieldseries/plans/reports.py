"""Registered queries of the joins, gates and reports over the derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldseries.functions import columns as C
from fieldseries.operators import catalog, imputation, quality, reports, sinks
from fieldseries.operators import features as feat
from fieldseries.plans.registry import DAILY, DATED, FEATURES, PARCELS, SCENES, SHARES, query, rounded
from fieldseries.sources import analogues as A
from fieldseries.sources.tables import table

CLASSIFICATION = "classification AS (SELECT c_custkey AS id_parcel, c_mktsegment AS classe_declaree, c_custkey % 97 / 97 AS proba_max, CASE WHEN c_custkey % 5 = 0 THEN 'test' ELSE 'train' END AS split, 'rf_' || c_custkey % 2 AS model_version FROM customer)"
DIVERGENCE = "divergence AS (SELECT c_custkey AS id_parcel, CASE WHEN c_custkey % 11 = 0 THEN 'autres' ELSE c_mktsegment END AS classe_declaree, c_custkey % 4 = 1 AS divergent FROM customer WHERE c_custkey % 7 <> 3)"
PHENOLOGY = "phenology AS (SELECT c_custkey AS id_parcel, CASE WHEN c_custkey % 13 <> 0 THEN c_mktsegment END AS classe_declaree, c_custkey * 37 % 211 + 30 AS los_jours, c_custkey % 5 <> 0 AS fiable FROM customer WHERE c_custkey % 6 <> 2)"
TILES = {"view": "nord", "click": "nord", "purchase": "sud"}


@query(f"WITH {DIVERGENCE}, {PHENOLOGY} SELECT divergent, count(los_jours) AS n, round(avg(los_jours), 6) AS mean, round(stddev_samp(los_jours), 6) AS std, median(los_jours) AS mediane FROM divergence JOIN phenology USING (id_parcel) WHERE fiable GROUP BY divergent")
def synthesis(spark: SparkSession, d: str) -> DataFrame:
    return rounded(reports.synthesis(A.divergence(spark, d), A.phenology(spark, d), "id_parcel"))


@query(f"WITH {DIVERGENCE}, {PARCELS} SELECT id_parcel, divergent, cx, cy FROM divergence JOIN parcels USING (id_parcel)")
def located_divergence(spark: SparkSession, d: str) -> DataFrame:
    return reports.located(A.divergence(spark, d).select("id_parcel", "divergent"), A.parcels(spark, d), "id_parcel")


@query(f"WITH {FEATURES}, {CLASSIFICATION} SELECT f.id_parcel, f.feature, round(value, 6) AS value, classe_declaree AS classe, split FROM features f LEFT JOIN classification c USING (id_parcel)")
def features_joined(spark: SparkSession, d: str) -> DataFrame:
    """Class and split replace columns of their names; done twice, the result is the same."""
    known = A.classification(spark, d).withColumnRenamed("classe_declaree", "classe")
    made = A.features(spark, d)
    for column in ("classe", "split", "classe", "split"):
        made = reports.put(made, known, "id_parcel", column)
    return rounded(made.select("id_parcel", "feature", "value", "classe", "split"))


@query(f"WITH {DATED} SELECT id_parcel, count(*) AS n FROM dated WHERE n_pixels >= 5 AND id_parcel IN (SELECT c_custkey FROM customer WHERE c_nationkey < 12) GROUP BY 1")
def filtered_profiles(spark: SparkSession, d: str) -> DataFrame:
    reference = A.parcels(spark, d).where("code_group < 12")
    return reports.within(reports.enough_pixels(A.dated(spark, d), 5), reference, "id_parcel").groupBy("id_parcel").agg(F.count("*").alias("n"))


@query(f"WITH {CLASSIFICATION}, {DIVERGENCE}, {PHENOLOGY} SELECT count(*) AS n, count(*) FILTER (c.classe_declaree IS DISTINCT FROM d.classe_declaree) AS n_divergence, count(*) FILTER (c.classe_declaree IS DISTINCT FROM p.classe_declaree) AS n_phenologie FROM classification c LEFT JOIN divergence d USING (id_parcel) LEFT JOIN phenology p USING (id_parcel)")
def agreement(spark: SparkSession, d: str) -> DataFrame:
    return reports.agreement(A.classification(spark, d), A.divergence(spark, d), A.phenology(spark, d), "id_parcel")


@query(f"WITH {CLASSIFICATION} SELECT model_version, split, count(*) AS n, round(avg(proba_max), 3) AS proba_moy FROM classification GROUP BY ALL")
def predictions_check(spark: SparkSession, d: str) -> DataFrame:
    return reports.predictions_check(A.classification(spark, d))


@query(f"WITH {DIVERGENCE}, {PHENOLOGY} SELECT (SELECT count(*) FROM divergence) AS n_divergence, (SELECT count(*) FROM divergence WHERE divergent) AS n_divergentes, count(*) AS n_phenologie, count(*) FILTER (fiable) AS n_fiables FROM phenology")
def load_check(spark: SparkSession, d: str) -> DataFrame:
    return reports.load_check(A.divergence(spark, d), A.phenology(spark, d))


@query("SELECT round(sum(c_acctbal), 2) AS surface_totale FROM customer")
def surface_total(spark: SparkSession, d: str) -> DataFrame:
    return reports.surface_total(A.parcels(spark, d), "surf_parc")


@query("SELECT count(*) AS n, round(sum(c_custkey % 50 / 1000), 6) AS surface_km2, round(count(*) / sum(c_custkey % 50 / 1000), 1) AS densite FROM customer")
def density(spark: SparkSession, d: str) -> DataFrame:
    return reports.density(A.parcels(spark, d).withColumn("km2", F.col("id_parcel") % 50 / 1000), "km2")


@query("SELECT count(*) AS n_raw, count(*) FILTER (c_nationkey < 20) AS n_derived, CAST(0 AS BIGINT) AS n_orphelines, count(*) FILTER (c_nationkey < 20 AND c_custkey % 50 = 7) AS n_invalides, true AS crs_ok, count(*) FILTER (c_nationkey < 20) BETWEEN 1 AND count(*) - 1 AS volume_ok, true AS orphelines_ok, count(*) FILTER (c_nationkey < 20 AND c_custkey % 50 = 7) = 0 AS geometrie_ok, count(*) FILTER (c_nationkey < 20) BETWEEN 1 AND count(*) - 1 AND count(*) FILTER (c_nationkey < 20 AND c_custkey % 50 = 7) = 0 AS ok FROM customer")
def ingestion_gate(spark: SparkSession, d: str) -> DataFrame:
    raw = A.parcels(spark, d).withColumn("srid", F.lit(2154))
    return reports.ingestion_gate(raw, raw.where("code_group < 20"), "id_parcel", "srid", F.col("id_parcel") % 50 != 7)


@query("WITH a AS (SELECT o_custkey AS k, count(*) AS n, count(*) FILTER (o_orderstatus = 'P') AS nn, count(*) FILTER (o_totalprice < 5000) AS nz FROM orders GROUP BY 1) SELECT coalesce(bool_and(n IS NOT NULL AND nn <> n AND nz = 0), false) AS nettoyage_permis FROM customer LEFT JOIN a ON k = c_custkey")
def cleanup_allowed(spark: SparkSession, d: str) -> DataFrame:
    actual = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "P").alias("n_nodata"), F.count_if(F.col("o_totalprice") < 5000).alias("n_zeros"))
    return quality.cleanup_allowed(quality.expected_artifacts(table(spark, d, "customer").select("c_custkey"), actual, ["c_custkey"]))


@query(f"WITH {SCENES}, kept AS (SELECT * FROM scenes QUALIFY row_number() OVER (PARTITION BY tile_id, date ORDER BY scene_id DESC) = 1), n AS (SELECT date, bool_or(pair = 'nord') AND bool_or(pair = 'sud') AS complet FROM kept GROUP BY date), w AS (SELECT count(*) AS covered, count(*) FILTER (complet) AS whole FROM n WHERE date BETWEEN DATE '2023-12-15' AND DATE '2024-02-12') SELECT (SELECT count(*) FROM scenes) AS scenes_brutes, (SELECT count(*) FROM kept) AS scenes_dedup, (SELECT count(*) FROM scenes) - (SELECT count(*) FROM kept) AS doublons_supprimes, CAST(60 AS BIGINT) AS jours_fenetre, covered AS jours_couverts, round_even(10 * (100 * covered / 60), 0) / 10 AS pct_couverts, whole AS jours_full_aoi, round_even(10 * (100 * whole / 60), 0) / 10 AS pct_full_aoi FROM w")
def availability_report(spark: SparkSession, d: str) -> DataFrame:
    scenes = A.scenes(spark, d)
    return reports.availability_report(scenes, catalog.dedup_latest(scenes, ["tile_id", "date"]), "2023-12-15", "2024-02-12")


@query(f"WITH {SCENES}, {DAILY} SELECT d::DATE AS date, coalesce(n_scenes, 0) AS n_scenes, coalesce(complet, false) AS complet FROM generate_series(DATE '2023-12-15', DATE '2024-02-12', INTERVAL 1 DAY) t(d) LEFT JOIN daily ON date = d::DATE")
def every_day(spark: SparkSession, d: str) -> DataFrame:
    return catalog.every_day(catalog.daily(A.scenes(spark, d)), "2023-12-15", "2024-02-12")


@query(f"WITH {SCENES}, n AS (SELECT DISTINCT date FROM scenes WHERE pair = 'nord' AND scene_id LIKE '%7'), s AS (SELECT DISTINCT date FROM scenes WHERE pair = 'sud' AND scene_id LIKE '%13') SELECT coalesce(n.date, s.date) AS date, n.date IS NOT NULL AS nord, s.date IS NOT NULL AS sud FROM n FULL JOIN s ON n.date = s.date")
def strips(spark: SparkSession, d: str) -> DataFrame:
    scenes = A.scenes(spark, d)
    return catalog.strips(scenes.where("pair = 'nord' AND scene_id LIKE '%7'"), scenes.where("pair = 'sud' AND scene_id LIKE '%13'"))


@query(f"WITH {SCENES} SELECT tile_id, pair, orbit_relative, count(*) AS n FROM scenes GROUP BY ALL")
def scenes_by_orbit(spark: SparkSession, d: str) -> DataFrame:
    return catalog.scenes_by_orbit(A.scenes(spark, d))


@query(f"WITH {SCENES} SELECT tile_id, date, count(*) AS n FROM scenes GROUP BY ALL HAVING count(*) > 1")
def repeated_days(spark: SparkSession, d: str) -> DataFrame:
    return catalog.repeated_days(A.scenes(spark, d))


@query(f"WITH {SCENES} SELECT scene_id, tile_id, date, CASE tile_id WHEN 'view' THEN 'nord' WHEN 'click' THEN 'nord' WHEN 'purchase' THEN 'sud' END AS pair FROM scenes WHERE tile_id IN ('view', 'purchase', 'signup') AND date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'")
def selected_scenes(spark: SparkSession, d: str) -> DataFrame:
    return catalog.selected(A.scenes(spark, d), ["view", "purchase", "signup"], "2024-01-05", "2024-01-20", TILES).select("scene_id", "tile_id", "date", "pair")


@query(f"WITH {SCENES} SELECT tile_id, date, scene_id, CAST(1 AS INTEGER) AS rang FROM scenes QUALIFY row_number() OVER (PARTITION BY tile_id, date ORDER BY scene_id) = 1")
def keep_first(spark: SparkSession, d: str) -> DataFrame:
    return catalog.keep_first(A.scenes(spark, d), ["tile_id", "date"], ["scene_id"]).select("tile_id", "date", "scene_id", "rang")


@query(f"WITH {SHARES}, a AS (SELECT mois, CASE WHEN pct = 0 THEN 'exclure' WHEN pct < 30.0 THEN 'imputer' ELSE 'conserver' END AS action FROM shares) SELECT mois, count(*) FILTER (action = 'conserver') AS conserver, count(*) FILTER (action = 'imputer') AS imputer, count(*) FILTER (action = 'exclure') AS exclure FROM a GROUP BY mois")
def action_table(spark: SparkSession, d: str) -> DataFrame:
    return feat.action_table(A.monthly_shares(spark, d).select("mois", imputation.qc_action(F.col("pct"), 30.0).alias("action")))


@query(f"WITH {FEATURES} SELECT count(*) AS n, count(*) FILTER (value IS NULL) AS n_nan, round_even(100 * (100 * avg(CASE WHEN value IS NULL THEN 1 ELSE 0 END)), 0) / 100 AS pct_nan FROM features")
def nan_total(spark: SparkSession, d: str) -> DataFrame:
    return feat.missing_total(A.features(spark, d))


@query("WITH o AS (SELECT o_custkey AS id, CAST(o_orderdate AS DATE) AS date, o_totalprice / 1000 AS v FROM orders), t AS (SELECT id, max(v) AS top, min(v) AS low, avg(v) FILTER (strftime(date, '%Y-%m') = '1996-05') AS may, avg(v) FILTER (strftime(date, '%Y-%m') = '1996-08') AS aug FROM o GROUP BY id) SELECT o.id, round(any_value(top - low), 6) AS amplitude, min(date) FILTER (v = top) AS date_max, round(any_value((aug - may) / 92), 6) AS pente FROM o JOIN t USING (id) GROUP BY o.id")
def season_table(spark: SparkSession, d: str) -> DataFrame:
    obs = table(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.to_date("o_orderdate").alias("date"), (F.col("o_totalprice") / 1000).alias("v"))
    return rounded(feat.season_table(obs, "id", "date", "v", "1996-05-01", "1996-08-01"))


@query("WITH a AS (SELECT DISTINCT o_custkey AS id FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000), b AS (SELECT DISTINCT o_custkey AS id FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 300000) SELECT count(*) FILTER (a.id IS NOT NULL AND b.id IS NOT NULL) AS n_communs, count(*) FILTER (b.id IS NULL) AS n_gauche, count(*) FILTER (a.id IS NULL) AS n_droite FROM a FULL JOIN b ON a.id = b.id")
def shared_ids(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("id"), "o_orderstatus")
    return reports.shared_ids(rows.where("o_orderstatus = 'F'"), rows.where("o_orderstatus = 'O'"), "id")


@query("SELECT event_type, round(100 * avg(CASE WHEN user_id % 4 = 0 THEN 1 ELSE 0 END), 6) AS pct_zero, 100 * avg(CASE WHEN user_id % 4 = 0 THEN 1 ELSE 0 END) < 25 AS valide FROM events GROUP BY 1")
def zero_share(spark: SparkSession, d: str) -> DataFrame:
    px = table(spark, d, "events").select("event_type", (F.col("user_id") % 4).alias("band"))
    return rounded(quality.zero_share(px, ["event_type"], "band", 25.0))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS v, 'rf_' || strftime(DATE '2024-01-01' + CAST(c_custkey % 300 AS INTEGER), '%Y%m%d') AS model_version, c_nationkey AS code_group FROM customer")
def scalar_helpers(spark: SparkSession, d: str) -> DataFrame:
    """Nodata to null, a version's name, a strict cast."""
    k = F.col("c_custkey")
    held = F.when(k % 3 == 0, F.lit(-9999.0)).otherwise(F.col("c_acctbal"))
    day = F.date_add(F.lit("2024-01-01").cast("date"), (k % 300).cast("int"))
    return table(spark, d, "customer").select("c_custkey", C.without_nodata(held).alias("v"), C.version_name("rf", day).alias("model_version"), C.group_code(F.col("c_nationkey").cast("string")).alias("code_group"))


@query("WITH t AS (SELECT n_nationkey, n_nationkey * 0.25 + 0.125 AS x FROM nation) SELECT n_nationkey, round_even(x * 100, 0) / 100 AS y FROM t")
def half_even(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select("n_nationkey", C.half_even(F.col("n_nationkey") * 0.25 + 0.125, 2).alias("y"))


@query(f"WITH {SHARES} SELECT * FROM shares WHERE mois NOT IN (SELECT strftime(o_orderdate, '%Y-%m') FROM orders WHERE o_orderdate < DATE '1997-01-01')")
def absent_months(spark: SparkSession, d: str) -> DataFrame:
    loaded = table(spark, d, "orders").where("o_orderdate < DATE '1997-01-01'").select(C.month(F.col("o_orderdate")).alias("mois"))
    return sinks.absent(A.monthly_shares(spark, d), loaded, "mois")


@query(f"WITH {SCENES} SELECT strftime(date, '%Y-%m') AS mois, bool_and(CAST(scene_id AS BIGINT) % 400 <> 0) AS complet FROM scenes GROUP BY 1")
def complete_months(spark: SparkSession, d: str) -> DataFrame:
    """Months all of whose scenes are there; every four-hundredth is not."""
    scenes = A.scenes(spark, d).withColumn("mois", C.month(F.col("date")))
    return quality.complete_months(scenes, scenes.where(F.col("scene_id").cast("long") % 400 != 0))


@query(f"WITH {CLASSIFICATION}, {DIVERGENCE} SELECT (SELECT count(*) FROM classification) AS n_parcelles, (SELECT count(*) FROM divergence) AS n_divergence, (SELECT count(*) FILTER (divergent) FROM divergence) AS n_divergentes, true AS sans_phenologie")
def closing_report(spark: SparkSession, d: str) -> DataFrame:
    """Reports of one row each in one, as JSON and read back; the one that is not there is null."""
    parts = {"parcelles": A.classification(spark, d).agg(F.count("*").alias("n")), "divergence": A.divergence(spark, d).agg(F.count("*").alias("n"), F.count_if("divergent").alias("n_div")), "phenologie": None}
    text = reports.as_json(reports.closing_report(parts))
    read = text.select(F.from_json("value", "parcelles struct<n:bigint>, divergence struct<n:bigint,n_div:bigint>, phenologie string").alias("j"))
    return read.select(F.col("j.parcelles.n").alias("n_parcelles"), F.col("j.divergence.n").alias("n_divergence"), F.col("j.divergence.n_div").alias("n_divergentes"), F.col("j.phenologie").isNull().alias("sans_phenologie"))
