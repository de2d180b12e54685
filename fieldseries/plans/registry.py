"""The registered queries and their SQL for DuckDB. Floating results are rounded to 6 digits on both sides: engines add up in different orders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldseries.functions import columns as C
from fieldseries.operators import api, catalog, composites, divergence, geo, imputation, model, phenology, quality, schemas, sinks, smoothing, split, zonal
from fieldseries.operators import features as feat
from fieldseries.sources import analogues as A
from fieldseries.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

# The roles of sources.analogues in SQL.
PIXELS = "pixels AS (SELECT o_custkey AS id_parcel, strftime(l_shipdate, '%Y-%m') AS mois, unnest(['quantity', 'extendedprice', 'discount', 'tax']) AS variable, unnest([l_quantity, l_extendedprice, l_discount, l_tax]) AS value FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
COUNTS = "counts AS (SELECT o_custkey AS id_parcel, strftime(l_shipdate, '%Y-%m') AS mois, l_linenumber AS pixel, count(*) FILTER (l_returnflag = 'N') AS n_valid FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)"
SCENES = "scenes AS (SELECT CAST(event_id AS VARCHAR) AS scene_id, event_type AS tile_id, CAST(ts AS DATE) AS date, CASE WHEN event_type IN ('view', 'click') THEN 'nord' ELSE 'sud' END AS pair, [51, 94, 137][user_id % 3 + 1] AS orbit_relative, CASE WHEN event_id % 17 <> 0 THEN least(value / 100, 1.0) END AS f_valid_aoi FROM events)"
DATED = "dated AS (SELECT user_id AS id_parcel, CAST(ts AS DATE) AS date, event_type AS tile_id, value / 500 AS ndvi, CAST(props->>'$.k' AS INTEGER) + 1 AS n_pixels FROM events)"
FEATURES = "raw AS (SELECT vec_id AS id_parcel, label AS classe, CAST(unnest(range(0, len(embedding))) AS INTEGER) AS feature, unnest(embedding) AS v FROM embeddings), features AS (SELECT id_parcel, classe, feature, CASE WHEN (id_parcel * 7 + feature) % 29 <> 0 THEN CAST(v AS DOUBLE) END AS value FROM raw)"
SHARES = "shares AS (SELECT l_suppkey AS id_parcel, strftime(l_shipdate, '%Y-%m') AS mois, 100 * avg(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS pct, CASE WHEN count(*) FILTER (l_returnflag = 'R') > 1 THEN avg(l_quantity) FILTER (l_returnflag = 'R') END AS quantity FROM lineitem GROUP BY ALL)"
PARCELS = "parcels AS (SELECT c_custkey AS id_parcel, c_mktsegment AS classe, c_nationkey AS code_group, c_acctbal AS surf_parc, CAST(c_custkey * 7919 % 60000 AS DOUBLE) AS cx, CAST(c_custkey * 104729 % 50000 AS DOUBLE) AS cy, CAST(c_custkey % 40 + 10 AS DOUBLE) AS w, CAST(c_nationkey + 5 AS DOUBLE) AS h FROM customer)"
DAILY = "daily AS (SELECT date, count(*) AS n_scenes, bool_or(pair = 'nord') AND bool_or(pair = 'sud') AS complet FROM scenes GROUP BY date)"
SCORED = FEATURES + ", stats AS (SELECT feature, avg(value) AS mu, stddev_pop(value) AS sd FROM features GROUP BY feature), scored AS (SELECT id_parcel, classe, f.feature, value, (value - mu) / CASE WHEN sd = 0 THEN 1.0 ELSE sd END AS z FROM features f JOIN stats USING (feature))"
PROFILE = SCORED + ", profile AS (SELECT classe, feature, median(z) AS mediane FROM scored GROUP BY ALL)"
DIST = PROFILE + ", dist AS (SELECT id_parcel, classe, sqrt(avg((z - mediane) ** 2)) AS dist_classe, 100 * avg(CASE WHEN z IS NOT NULL THEN 1 ELSE 0 END) AS pct_features_valides FROM scored JOIN profile USING (classe, feature) GROUP BY ALL)"
LIMITS = DIST + ", limits AS (SELECT classe, quantile_cont(dist_classe, 0.25) AS q25, quantile_cont(dist_classe, 0.5) AS q50, quantile_cont(dist_classe, 0.75) AS q75, count(*) AS n, q50 + 2.0 * (q75 - q25) AS seuil_div FROM dist GROUP BY classe)"
ACTIONS = SHARES + """, act AS (SELECT id_parcel, mois, CASE WHEN pct = 0 THEN 'exclure' WHEN pct < 30.0 THEN 'imputer' ELSE 'conserver' END AS action FROM shares),
  months AS (SELECT mois, row_number() OVER (ORDER BY mois) - 1 AS pos FROM (SELECT DISTINCT mois FROM shares)), ids AS (SELECT DISTINCT id_parcel FROM shares),
  grid AS (SELECT id_parcel, mois, pos, action, CASE WHEN action IS NULL OR action <> 'exclure' THEN pos END AS usable FROM ids CROSS JOIN months LEFT JOIN act USING (id_parcel, mois)),
  sides AS (SELECT *, pos - last_value(usable IGNORE NULLS) OVER (PARTITION BY id_parcel ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gauche, first_value(usable IGNORE NULLS) OVER (PARTITION BY id_parcel ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) - pos AS droite FROM grid),
  tiers AS (SELECT id_parcel, mois, pos, gauche, droite, least(gauche, droite) AS dist_min, CASE WHEN action = 'imputer' AND (least(gauche, droite) IS NULL OR least(gauche, droite) > 1) THEN 'exclure' ELSE action END AS action FROM sides)"""
BINS = DATED + ", b AS (SELECT min(date) AS lo, max(date) AS hi FROM dated), bins AS (SELECT id_parcel, CAST(least(ceil((date - lo) / 5.0), floor((hi - lo) / 5.0)) AS INTEGER) AS idx, sum(ndvi * n_pixels) / sum(n_pixels) AS v, CAST(sum(n_pixels) AS DOUBLE) AS w FROM dated, b GROUP BY ALL)"
MONTHS = [f"{y}-{m:02d}" for y in (1998, 1999) for m in range(1, 9)]
CALENDAR = [f"{y}-{m:02d}" for y in range(1995, 2002) for m in range(1, 13)]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c, kind in df.dtypes if kind == "double"})


@query(f"WITH {PIXELS} SELECT id_parcel, mois, variable, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 0.9), 6) AS p90 FROM pixels GROUP BY ALL")
def zonal_stats(spark: SparkSession, d: str) -> DataFrame:
    return rounded(zonal.zonal_stats_of(A.pixels_wide(spark, d), ["id_parcel", "mois"], list(A.VARIABLES)))


@query(f"WITH {COUNTS} SELECT id_parcel, mois, round(avg(n_valid), 6) AS n_dates_valides_moy, round(100 * avg(CASE WHEN n_valid > 0 THEN 1 ELSE 0 END), 6) AS pct_pixels_couverts FROM counts GROUP BY ALL")
def completeness(spark: SparkSession, d: str) -> DataFrame:
    return rounded(zonal.completeness(A.pixel_counts(spark, d), ["id_parcel", "mois"]))


@query(f"WITH {DATED} SELECT id_parcel, date, round(avg(ndvi), 10) AS mean, round(stddev_pop(ndvi), 10) AS std, CAST(count(*) AS INTEGER) AS n_pixels FROM dated GROUP BY ALL")
def ndvi_by_date(spark: SparkSession, d: str) -> DataFrame:
    return rounded(zonal.stats_by_date(A.dated(spark, d), ["id_parcel", "date"], "ndvi"), 10)


@query(f"WITH {DATED}, x AS (SELECT id_parcel, date, median(ndvi) AS v FROM dated GROUP BY ALL) SELECT id_parcel, strftime(date, '%Y-%m') AS mois, round(median(v), 6) AS composite FROM x GROUP BY ALL")
def two_stage_median(spark: SparkSession, d: str) -> DataFrame:
    return rounded(composites.two_stage_median(A.dated(spark, d), ["id_parcel"], value="ndvi"))


@query("WITH px AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS mois, o_custkey FROM orders), t AS (SELECT count(*) AS total FROM customer) SELECT mois, round_even(10 * (100 * (max(total) - count(*)) / max(total)), 0) / 10 AS pct_pixels_0_date FROM px, t WHERE o_custkey IN (SELECT c_custkey FROM customer) GROUP BY mois")
def coverage_month(spark: SparkSession, d: str) -> DataFrame:
    seen = table(spark, d, "orders").select(F.col("o_custkey").alias("px"), F.to_date("o_orderdate").alias("date"))
    return composites.coverage(seen, table(spark, d, "customer").select(F.col("c_custkey").alias("px")), ["px"])


@query("SELECT event_type, round((count(*) FILTER (user_id % 13 > 0) - count(*) FILTER (user_id % 13 > 0 AND user_id % 13 IN (1, 3, 7, 8, 9, 10, 11))) / count(*) FILTER (user_id % 13 > 0), 6) AS f_valid_aoi FROM events GROUP BY event_type")
def valid_fraction(spark: SparkSession, d: str) -> DataFrame:
    px = table(spark, d, "events").withColumn("scl", F.col("user_id") % 13)
    return rounded(composites.valid_fraction(px, ["event_type"], "scl > 0", f"scl IN {C.INVALID_CLASSES}"))


@query(f"WITH {SCENES}, {DAILY} SELECT * FROM daily")
def full_coverage_days(spark: SparkSession, d: str) -> DataFrame:
    return catalog.daily(A.scenes(spark, d))


@query(f"WITH {SCENES}, {DAILY}, m AS (SELECT unnest(generate_series(date_trunc('month', min(date)), date_trunc('month', max(date)), INTERVAL 1 MONTH))::DATE AS m FROM daily), s AS (SELECT date_trunc('month', date)::DATE AS m, sum(n_scenes) AS a, count(*) AS b, count(*) FILTER (complet) AS c FROM daily GROUP BY ALL) SELECT strftime(m, '%Y-%m') AS mois, coalesce(a, 0)::BIGINT AS n_scenes, coalesce(b, 0) AS n_jours, coalesce(c, 0) AS n_jours_complets, CAST(day(last_day(m)) AS INTEGER) AS jours_mois, round_even(10 * (100 * coalesce(b, 0) / day(last_day(m))), 0) / 10 AS pct_jours, round_even(10 * (100 * coalesce(c, 0) / day(last_day(m))), 0) / 10 AS pct_complets FROM m LEFT JOIN s USING (m)")
def monthly_availability(spark: SparkSession, d: str) -> DataFrame:
    return catalog.monthly_availability(A.scenes(spark, d))


@query(f"WITH {SCENES} SELECT 60 AS n_jours, count(DISTINCT date) AS n_couverts, round_even(10 * (100 * count(DISTINCT date) / 60), 0) / 10 AS pct FROM scenes WHERE date BETWEEN DATE '2023-12-15' AND DATE '2024-02-12'")
def window_totals(spark: SparkSession, d: str) -> DataFrame:
    return catalog.window_totals(A.scenes(spark, d), "2023-12-15", "2024-02-12")


@query(f"WITH {SCENES} SELECT tile_id, array_to_string(list_sort(list_distinct(list(orbit_relative))), ',') AS orbites FROM scenes GROUP BY tile_id")
def orbits_per_tile(spark: SparkSession, d: str) -> DataFrame:
    return catalog.orbits_per_tile(A.scenes(spark, d))


@query("SELECT o_custkey, count(*) AS n, round_even(10 * (100 * count(*) / (SELECT count(*) FROM orders)), 0) / 10 AS pct FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 20")
def top20_pct(spark: SparkSession, d: str) -> DataFrame:
    return feat.top_shares(table(spark, d, "orders"), "o_custkey")


@query("SELECT count(o_totalprice) AS n, round_even(1000 * avg(o_totalprice), 0) / 1000 AS mean, round_even(1000 * stddev_samp(o_totalprice), 0) / 1000 AS std, round_even(1000 * min(o_totalprice), 0) / 1000 AS min, round_even(1000 * max(o_totalprice), 0) / 1000 AS max, round_even(1000 * quantile_cont(o_totalprice, 0.25), 0) / 1000 AS q25, round_even(1000 * quantile_cont(o_totalprice, 0.5), 0) / 1000 AS q50, round_even(1000 * quantile_cont(o_totalprice, 0.75), 0) / 1000 AS q75 FROM orders")
def describe(spark: SparkSession, d: str) -> DataFrame:
    return feat.describe(table(spark, d, "orders"), "o_totalprice")


@query("SELECT count(*) AS n, count(DISTINCT l_orderkey) AS n_ids, min(l_quantity) AS min, max(l_quantity) AS max, round(avg(l_quantity), 6) AS mean FROM lineitem")
def table_counts(spark: SparkSession, d: str) -> DataFrame:
    return rounded(quality.table_counts(table(spark, d, "lineitem"), "l_orderkey", "l_quantity"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1 ORDER BY 1, 2 LIMIT 5")
def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return quality.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(f"WITH {SCORED} SELECT id_parcel, classe, feature, round(value, 6) AS value, round(z, 6) AS z FROM scored")
def zscore(spark: SparkSession, d: str) -> DataFrame:
    return rounded(divergence.zscore(A.features(spark, d)).select("id_parcel", "classe", "feature", "value", "z"))


@query(f"WITH {PROFILE} SELECT classe, feature, round(mediane, 6) AS mediane FROM profile")
def class_median_profile(spark: SparkSession, d: str) -> DataFrame:
    return rounded(divergence.class_profile(divergence.zscore(A.features(spark, d))))


def _distances(spark: SparkSession, d: str) -> DataFrame:
    return divergence.rms_distance(divergence.zscore(A.features(spark, d)), "id_parcel")


@query(f"WITH {DIST} SELECT id_parcel, classe, round(dist_classe, 6) AS dist_classe, round(pct_features_valides, 6) AS pct_features_valides FROM dist")
def rms_distance(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_distances(spark, d))


@query(f"WITH {LIMITS} SELECT classe, round(q25, 6) AS q25, round(q50, 6) AS q50, round(q75, 6) AS q75, n, round(seuil_div, 6) AS seuil_div FROM limits")
def divergence_thresholds(spark: SparkSession, d: str) -> DataFrame:
    return rounded(divergence.thresholds(_distances(spark, d)))


@query(f"WITH {LIMITS} SELECT id_parcel, classe, round(dist_classe, 6) AS dist_classe, round(seuil_div, 6) AS seuil_div, coalesce(dist_classe > seuil_div, false) AS divergent FROM dist JOIN limits USING (classe)")
def divergent_flags(spark: SparkSession, d: str) -> DataFrame:
    return rounded(divergence.flags(_distances(spark, d)).select("id_parcel", "classe", "dist_classe", "seuil_div", "divergent"))


@query(f"WITH {LIMITS} SELECT classe, count(*) FILTER (dist_classe > seuil_div) AS n_div, round(count(*) FILTER (dist_classe > seuil_div) / count(*), 6) AS taux FROM dist JOIN limits USING (classe) GROUP BY classe")
def divergence_rates(spark: SparkSession, d: str) -> DataFrame:
    return rounded(divergence.rates(divergence.flags(_distances(spark, d))))


@query(f"WITH {BINS} SELECT id_parcel, idx, round(v, 6) AS v, w FROM bins")
def weighted_bins(spark: SparkSession, d: str) -> DataFrame:
    return rounded(smoothing.weighted_bins(A.dated(spark, d), "id_parcel"))


@query(f"WITH {PARCELS}, b AS (SELECT classe, CASE WHEN CAST(floor(cx / 10000) AS INTEGER) % 5 = 0 THEN 'test' ELSE 'train' END AS split FROM parcels) SELECT classe, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'test') AS test, count(*) AS total, round_even(10 * (100 * count(*) FILTER (split = 'test') / count(*)), 0) / 10 AS pct_test FROM b GROUP BY classe")
def class_split_crosstab(spark: SparkSession, d: str) -> DataFrame:
    rows = A.parcels(spark, d).withColumn("split", F.when(F.floor(F.col("cx") / 10000).cast("int") % 5 == 0, "test").otherwise("train"))
    return split.split_table(rows)


@query(f"WITH {FEATURES} SELECT CAST(feature % 12 AS VARCHAR) AS mois, count(*) FILTER (value IS NULL) AS n_nan, round_even(100 * (100 * avg(CASE WHEN value IS NULL THEN 1 ELSE 0 END)), 0) / 100 AS pct_nan FROM features GROUP BY 1")
def nan_by_month(spark: SparkSession, d: str) -> DataFrame:
    named = A.features(spark, d).withColumn("feature", F.concat(F.lit("ndvi_mean_"), (F.col("feature") % 12).cast("string")))
    return feat.missing_by_month(named)


@query(f"WITH {DATED} SELECT id_parcel, round(max(ndvi) - min(ndvi), 6) AS amplitude, min(date) FILTER (ndvi = m) AS date_max FROM (SELECT *, max(ndvi) OVER (PARTITION BY id_parcel) AS m FROM dated) GROUP BY id_parcel")
def amplitude_argmax(spark: SparkSession, d: str) -> DataFrame:
    return rounded(feat.season_shape(A.dated(spark, d), "id_parcel", "date", "ndvi"))


@query("SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL")
def confusion_matrix(spark: SparkSession, d: str) -> DataFrame:
    return model.confusion(table(spark, d, "orders"), "o_orderpriority", "o_orderstatus")


REPORT = """m AS (SELECT label % 8 AS t, vec_id % 10 AS g, count(*) AS n FROM embeddings GROUP BY ALL), a AS (SELECT t AS classe, sum(n) AS support, sum(CASE WHEN t = g THEN n ELSE 0 END) AS hits FROM m GROUP BY t), b AS (SELECT g AS classe, sum(n) AS said FROM m GROUP BY g),
  c AS (SELECT CAST(classe AS VARCHAR) AS classe, coalesce(hits / nullif(said, 0), 0.0) AS p, coalesce(hits / nullif(support, 0), 0.0) AS r, CAST(coalesce(support, 0) AS BIGINT) AS support, coalesce(hits, 0) AS hits FROM a FULL JOIN b USING (classe)),
  d AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1 FROM c)"""


def _report(spark: SparkSession, d: str) -> DataFrame:
    pairs = table(spark, d, "embeddings").select((F.col("label") % 8).cast("long").alias("t"), (F.col("vec_id") % 10).alias("g"))
    return model.report(model.confusion(pairs, "t", "g"), "t", "g")


@query(f"WITH {REPORT} SELECT classe, round(p, 6) AS precision, round(r, 6) AS rappel, round(f1, 6) AS f1, support FROM d")
def class_report(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_report(spark, d).drop("hits"))


@query(f"WITH {REPORT} SELECT 'macro' AS moyenne, round(avg(p), 6) AS precision, round(avg(r), 6) AS rappel, round(avg(f1), 6) AS f1, CAST(sum(support) AS BIGINT) AS support FROM d UNION ALL SELECT 'ponderee', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM d UNION ALL SELECT 'exactitude', round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM d")
def report_averages(spark: SparkSession, d: str) -> DataFrame:
    return rounded(model.averages(_report(spark, d)))


@query(f"WITH {SCENES} SELECT * FROM scenes QUALIFY row_number() OVER (PARTITION BY tile_id, date ORDER BY scene_id DESC) = 1")
def dedup_latest(spark: SparkSession, d: str) -> DataFrame:
    return catalog.dedup_latest(A.scenes(spark, d), ["tile_id", "date"])


@query(f"WITH {SCENES} SELECT strftime(date, '%Y-%m') AS mois, strftime(date, '%Y%m%d') AS date8, tile_id, count(*) AS n FROM scenes WHERE f_valid_aoi >= 0.01 GROUP BY ALL")
def retained_scenes(spark: SparkSession, d: str) -> DataFrame:
    return catalog.retained(A.scenes(spark, d)).groupBy("mois", "date8", "tile_id").agg(F.count("*").alias("n"))


@query(f"WITH {SCENES} SELECT orbit_relative, arg_max(scene_id, (date, scene_id)) AS scene_id, arg_max(f_valid_aoi, (date, scene_id)) FILTER (f_valid_aoi IS NOT NULL) AS f_valid_aoi FROM scenes GROUP BY 1")
def first_nonnull(spark: SparkSession, d: str) -> DataFrame:
    rows = A.scenes(spark, d).withColumn("o", F.struct("date", "scene_id")).select("orbit_relative", "o", "scene_id", "f_valid_aoi")
    return catalog.first_nonnull(rows, ["orbit_relative"], ["o"]).drop("o")


@query(f"WITH {ACTIONS} SELECT id_parcel, mois, gauche, droite, dist_min, action FROM tiers")
def anchor_distance(spark: SparkSession, d: str) -> DataFrame:
    made = imputation.anchors(_actions(spark, d), "id_parcel", _months(spark, d)).select("id_parcel", "mois", "gauche", "droite", "dist_min", "action")
    return made.withColumns({c: F.col(c).cast("long") for c in ("gauche", "droite", "dist_min")})


def _actions(spark: SparkSession, d: str) -> DataFrame:
    return A.monthly_shares(spark, d).select("id_parcel", "mois", imputation.qc_action(F.col("pct"), 30.0).alias("action"))


@query("WITH " + ACTIONS + """, v AS (SELECT id_parcel, mois, pos, t.action, quantity FROM tiers t LEFT JOIN shares USING (id_parcel, mois)),
  n AS (SELECT *, last_value(CASE WHEN quantity IS NOT NULL THEN pos END IGNORE NULLS) OVER lo AS bp, last_value(quantity IGNORE NULLS) OVER lo AS bv, first_value(CASE WHEN quantity IS NOT NULL THEN pos END IGNORE NULLS) OVER hi AS ap, first_value(quantity IGNORE NULLS) OVER hi AS av FROM v
    WINDOW lo AS (PARTITION BY id_parcel ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), hi AS (PARTITION BY id_parcel ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
  SELECT id_parcel, 'quantity' AS variable, mois, action, round(CASE WHEN action = 'imputer' THEN coalesce(quantity, bv + (av - bv) * (pos - bp) / nullif(ap - bp, 0), bv, av) ELSE quantity END, 6) AS value FROM n""")
def impute_linear(spark: SparkSession, d: str) -> DataFrame:
    cells = A.monthly_shares(spark, d).select("id_parcel", "mois", imputation.qc_action(F.col("pct"), 30.0).alias("action"), "quantity")
    return rounded(imputation.impute(cells, "id_parcel", ["quantity"], _months(spark, d)))


def _months(spark: SparkSession, d: str) -> list[str]:
    """The table's months, from one column."""
    return sorted(r[0] for r in table(spark, d, "lineitem").select(C.month(F.col("l_shipdate"))).distinct().collect())


@query(f"WITH {SHARES} SELECT mois, CASE WHEN pct = 0 THEN 'exclure' WHEN pct < 0.5 THEN 'imputer' ELSE 'conserver' END AS action, count(*) AS n FROM shares GROUP BY ALL")
def qc_action(spark: SparkSession, d: str) -> DataFrame:
    return A.monthly_shares(spark, d).groupBy("mois", imputation.qc_action(F.col("pct")).alias("action")).agg(F.count("*").alias("n"))


@query()
def whittaker(spark: SparkSession, d: str) -> DataFrame:
    obs = A.dated(spark, d)
    days = obs.agg(F.datediff(F.max("date"), F.min("date")) + 1).first()[0]  # from the first date to the last
    return smoothing.whittaker(smoothing.dense_series(smoothing.weighted_bins(obs, "id_parcel", step=1), obs, "id_parcel", max(3, days or 0)), "id_parcel")  # second differences need three points


SEASON = BINS.replace("5.0", "1.0") + """, who AS (SELECT DISTINCT id_parcel, ['prairie', 'colza', 'autres'][id_parcel % 3 + 1] AS classe FROM dated),
  pts AS (SELECT id_parcel, idx AS i, v FROM bins JOIN who USING (id_parcel) WHERE classe <> 'colza' OR idx BETWEEN 5 AND 380), top AS (SELECT id_parcel, max(v) AS top, min(i) AS f, max(i) AS l FROM pts GROUP BY 1),
  peak AS (SELECT id_parcel, any_value(top) AS top, any_value(f) AS f, any_value(l) AS l, min(i) FILTER (v = top) AS p FROM pts JOIN top USING (id_parcel) GROUP BY 1),
  low AS (SELECT id_parcel, min(v) FILTER (i <= p) AS lo_l, min(v) FILTER (i >= p) AS lo_r FROM pts JOIN peak USING (id_parcel) GROUP BY 1),
  thr AS (SELECT *, CASE WHEN top > lo_l THEN lo_l + 0.2 * (top - lo_l) ELSE top END AS tl, CASE WHEN top > lo_r THEN lo_r + 0.2 * (top - lo_r) ELSE top END AS tr, top > lo_l OR top > lo_r AS has FROM peak JOIN low USING (id_parcel)),
  se AS (SELECT id_parcel, coalesce(max(i) FILTER (i <= p AND v <= tl), any_value(f)) AS s, coalesce(min(i) FILTER (i >= p AND v <= tr), any_value(l)) AS e FROM pts JOIN thr USING (id_parcel) GROUP BY 1),
  seasons AS (SELECT w.id_parcel, classe, CASE WHEN has THEN DATE '2024-01-01' + s END AS sos_date, CASE WHEN has THEN DATE '2024-01-01' + p END AS pos_date, CASE WHEN has THEN DATE '2024-01-01' + e END AS eos_date, CASE WHEN has THEN e - s END AS los_jours,
    coalesce(has AND s <= f + 1, false) AS sos_en_bord, coalesce(has AND e >= l - 1, false) AS eos_en_bord, coalesce(has AND (p <= f + 1 OR p >= l - 1), false) AS pos_en_bord FROM who w LEFT JOIN thr USING (id_parcel) LEFT JOIN se USING (id_parcel))"""


def _season_bins(spark: SparkSession, d: str) -> DataFrame:
    obs = A.dated(spark, d)
    days = obs.agg(F.datediff(F.max("date"), F.min("date")) + 1).first()[0]
    bins = smoothing.dense_series(smoothing.weighted_bins(obs, "id_parcel", step=1), obs, "id_parcel", max(1, days or 0))
    known = F.zip_with("y", "w", lambda y, w: F.when(w > 0, y))
    classes = F.get(F.array(*[F.lit(c) for c in ("prairie", "colza", "autres")]), (F.col("id_parcel") % 3).cast("int"))
    return phenology.seasons(bins.select("id_parcel", classes.alias("classe"), known.alias("z")), "2024-01-01", step=1)


@query(f"WITH {SEASON} SELECT *, NOT (sos_en_bord OR eos_en_bord OR pos_en_bord) AS fiable FROM seasons")
def season_bins(spark: SparkSession, d: str) -> DataFrame:
    """Seasons of the bins as they are, without smoothing."""
    return _season_bins(spark, d)


@query(f"WITH {SEASON} SELECT classe, " + ", ".join(f"median({c}_date - DATE '1970-01-01') AS {c}_mediane" for c in ("sos", "pos", "eos")) + ", median(los_jours) AS los_mediane, " + ", ".join(f"round(avg(CASE WHEN {c}_en_bord THEN 1 ELSE 0 END), 6) AS taux_{c}_en_bord" for c in ("sos", "pos", "eos")) + ", round(avg(CASE WHEN sos_en_bord OR eos_en_bord OR pos_en_bord THEN 0 ELSE 1 END), 6) AS taux_fiable FROM seasons GROUP BY classe")
def season_bins_summary(spark: SparkSession, d: str) -> DataFrame:
    return rounded(phenology.class_summary(_season_bins(spark, d)))


@query()
def season_extract(spark: SparkSession, d: str) -> DataFrame:
    classes = F.get(F.array(*[F.lit(c) for c in ("prairie", "colza", "autres")]), (F.col("id_parcel") % 3).cast("int"))
    return phenology.seasons(whittaker(spark, d).withColumn("classe", classes), "2024-01-01", step=1)


@query()
def season_summary(spark: SparkSession, d: str) -> DataFrame:
    return rounded(phenology.class_summary(season_extract(spark, d)))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def label_difference(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey").subtract(table(spark, d, "orders").where("o_orderstatus = 'P'").select("o_custkey"))


@query("SELECT l.* FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')")
def orphans(spark: SparkSession, d: str) -> DataFrame:
    return quality.orphans(table(spark, d, "lineitem"), table(spark, d, "orders").where("o_orderstatus = 'F'").withColumnRenamed("o_orderkey", "l_orderkey"), ["l_orderkey"])


@query("SELECT count(*) AS n FROM part WHERE p_partkey NOT IN (SELECT DISTINCT l_partkey FROM lineitem)")
def not_in(spark: SparkSession, d: str) -> DataFrame:
    used = table(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    return quality.orphans(table(spark, d, "part"), used, ["p_partkey"]).agg(F.count("*").alias("n"))


@query(f"WITH {PIXELS}, s AS (SELECT id_parcel, variable, mois, avg(value) AS mean, min(value) AS low FROM pixels GROUP BY ALL) SELECT id_parcel, " + ", ".join(f"round(max({s}) FILTER (variable = '{v}' AND mois = '{m}'), 6) AS \"{v}_{s}_{m}\"" for v in A.VARIABLES for s in ("mean", "low") for m in CALENDAR) + f" FROM s WHERE mois IN {tuple(CALENDAR)} GROUP BY id_parcel")
def pivot_wide(spark: SparkSession, d: str) -> DataFrame:
    px = A.pixels_wide(spark, d).where(F.col("mois").isin(CALENDAR)).repartition("id_parcel")  # serves both aggregates
    stats = px.groupBy("id_parcel", "mois").agg(*[a for v in A.VARIABLES for a in (F.avg(v).alias(f"mean_{v}"), F.min(v).alias(f"low_{v}"))])
    cells = stats.select("id_parcel", "mois", F.inline(F.array(*[F.struct(F.lit(v).alias("variable"), F.round(f"mean_{v}", 6).alias("mean"), F.round(f"low_{v}", 6).alias("low")) for v in A.VARIABLES])))
    return feat.wide(cells, "id_parcel", ["mean", "low"], list(A.VARIABLES), CALENDAR)


@query("SELECT p_partkey, unnest(['p_size', 'p_retailprice']) AS feature, unnest([CAST(p_size AS DOUBLE), p_retailprice]) AS value FROM part")
def unpivot_long(spark: SparkSession, d: str) -> DataFrame:
    return feat.long(table(spark, d, "part").withColumn("p_size", F.col("p_size").cast("double")), "p_partkey", ["p_size", "p_retailprice"])


@query(f"WITH {PIXELS}, s AS (SELECT id_parcel, variable, mois, avg(value) AS mean FROM pixels GROUP BY ALL), m AS (SELECT unnest({MONTHS}) AS mois), g AS (SELECT c_custkey AS id_parcel, mois, variable FROM customer, m, (SELECT unnest(['quantity', 'extendedprice', 'discount', 'tax']) AS variable)) SELECT id_parcel, " + ", ".join(f"array_to_string(list(coalesce(CAST(CAST(round(mean * 100) AS BIGINT) AS VARCHAR), '-') ORDER BY mois) FILTER (variable = '{v}'), ',') AS {v}" for v in A.VARIABLES) + " FROM g LEFT JOIN s USING (id_parcel, variable, mois) GROUP BY id_parcel")
def aligned_profile(spark: SparkSession, d: str) -> DataFrame:
    px = A.pixels_wide(spark, d, "place").where(F.col("mois").isin(MONTHS)).repartition("id_parcel")  # serves both aggregates
    means = zonal.ordered_means(px, ["id_parcel", "mois"], list(A.VARIABLES), "place")
    made = api.aligned_profile(means.unpivot(["id_parcel", "mois"], list(A.VARIABLES), "variable", "mean"), A.parcels(spark, d), "id_parcel", MONTHS, A.VARIABLES)
    text = lambda c: F.array_join(F.transform(c, lambda x: F.coalesce(F.round(x * 100).cast("long").cast("string"), F.lit("-"))), ",").alias(c)
    return made.select("id_parcel", *map(text, A.VARIABLES))


@query("WITH b AS (SELECT p_partkey, p_size * 200.0 AS nir, p_retailprice AS red, (p_partkey % 900) * 1.0 AS blue FROM part), r AS (SELECT p_partkey, nir / 10000 AS n, red / 10000 AS r, blue / 10000 AS b FROM b) SELECT p_partkey, round(greatest(-1.0, least(1.0, (n - r) / (n + r + 1e-10))), 6) AS ndvi, round(greatest(-2.0, least(2.0, 2.5 * (n - r) / CASE WHEN abs(n + 6 * r - 7.5 * b + 1) < 0.001 THEN 0.001 ELSE n + 6 * r - 7.5 * b + 1 END)), 6) AS evi FROM r")
def spectral_indices(spark: SparkSession, d: str) -> DataFrame:
    nir, red, blue = F.col("p_size") * F.lit(200.0), F.col("p_retailprice"), (F.col("p_partkey") % 900).cast("double")
    return rounded(table(spark, d, "part").select("p_partkey", C.normalized_difference(nir, red).alias("ndvi"), C.evi(nir, red, blue).alias("evi")))


@query("SELECT c_custkey, CASE WHEN c_mktsegment = 'FURNITURE' THEN 'betterave' WHEN c_nationkey IN (1, 3) THEN 'cereales_hiver' WHEN c_nationkey = 2 THEN 'mais' WHEN c_nationkey = 5 THEN 'colza' WHEN c_nationkey = 9 THEN 'lin' WHEN c_nationkey IN (18, 19) THEN 'prairie' WHEN c_nationkey = 25 THEN 'legumes_fleurs' ELSE 'autres' END AS classe FROM customer")
def class_map(spark: SparkSession, d: str) -> DataFrame:
    return A.parcels(spark, d).select(F.col("id_parcel").alias("c_custkey"), C.crop_class(F.col("code_group").cast("string"), F.col("code_cultu")).alias("classe"))


@query("SELECT c_custkey, c_mktsegment, n_name, r_name, n_orders FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def parcel_card(spark: SparkSession, d: str) -> DataFrame:
    base = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    places = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    named = base.join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "n_name", "r_name")
    counts = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"))
    return api.parcel_card(base.drop("c_nationkey"), named, counts, base.select("c_custkey"), "c_custkey")


@query("SELECT count(*) AS n, count(*) FILTER (o_orderstatus IS DISTINCT FROM s) AS n_differents FROM orders LEFT JOIN (SELECT l_orderkey, max(l_linestatus) AS s FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey")
def consistency(spark: SparkSession, d: str) -> DataFrame:
    left = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("x"))
    right = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.max("l_linestatus").alias("x"))
    return quality.consistency(left, right, "id", "x")


@query(f"WITH {PARCELS} SELECT id_parcel, CAST(CAST(floor((cx - (SELECT min(cx) FROM parcels)) / 10000) AS INTEGER) AS VARCHAR) || '_' || CAST(CAST(floor((cy - (SELECT min(cy) FROM parcels)) / 10000) AS INTEGER) AS VARCHAR) AS block_id FROM parcels")
def block_id(spark: SparkSession, d: str) -> DataFrame:
    return split.block_ids(A.parcels(spark, d)).select("id_parcel", "block_id")


@query()
def block_split(spark: SparkSession, d: str) -> DataFrame:
    return split.block_split(split.block_ids(A.parcels(spark, d)), "id_parcel").select("id_parcel", "block_id", "split")


@query(f"WITH {PARCELS} SELECT id_parcel, round(w * h, 6) AS aire, 2 * (w + h) AS perimetre, round(4 * (w + h) * (w + h) / (4 * pi() * w * h), 6) AS compacite, round(cx + w / 2, 4) AS x, round(cy + h / 2, 4) AS y, round(sqrt(greatest(0, 30000 - cx - w / 2) ** 2 + (cy + h / 2 - 25000) ** 2), 4) AS dist FROM parcels")
def polygon_area(spark: SparkSession, d: str) -> DataFrame:
    ring = F.col("ring")
    ray = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(25000.0).alias("y")) for x in (30000.0, 90000.0)])
    made = A.parcels(spark, d).withColumn("aire", geo.area(ring)).withColumn("perimetre", geo.perimeter(ring)).withColumn("c", geo.centroid(ring))
    dist = geo.distance_to_line(ray, F.col("c.x"), F.col("c.y"))
    return made.select("id_parcel", F.round("aire", 6).alias("aire"), F.round("perimetre", 6).alias("perimetre"), F.round(C.compactness(F.col("perimetre"), F.col("aire")), 6).alias("compacite"), F.round("c.x", 4).alias("x"), F.round("c.y", 4).alias("y"), F.round(dist, 4).alias("dist"))


def _halves(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return rows.where("o_orderkey % 3 < 2"), rows.where("o_orderkey % 3 > 0").withColumn("o_orderstatus", F.lit("new"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN o_orderstatus ELSE 'new' END AS o_orderstatus FROM orders")
def insert_if_absent(spark: SparkSession, d: str) -> DataFrame:
    return sinks.insert_if_absent(*_halves(spark, d), ["o_orderkey"])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN 'new' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def upsert(spark: SparkSession, d: str) -> DataFrame:
    return sinks.upsert(*_halves(spark, d), ["o_orderkey"])


@query("SELECT 'not_null:o_custkey' AS contrainte, count(*) FILTER (o_custkey IS NULL) AS n FROM orders UNION ALL SELECT 'domaine:o_orderstatus', count(*) FILTER (o_orderstatus NOT IN ('O', 'F')) FROM orders UNION ALL SELECT 'cle', count(*) - count(DISTINCT o_orderkey) FROM orders")
def violations(spark: SparkSession, d: str) -> DataFrame:
    return quality.violations(table(spark, d, "orders"), ["o_orderkey"], ["o_custkey"], {"o_orderstatus": ["O", "F"]})


#: Orders as a declared table: a priority of its list, a note where there is none, no order without a customer.
ORDERS = schemas.Table("orders", {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "note": "string"}, ("o_custkey", "o_totalprice"), ("o_orderkey",), {"o_orderstatus": ("O", "F")}, {"note": "'none'"})


@query("WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 <> 0 THEN o_custkey END AS o_custkey, o_orderstatus, o_totalprice FROM orders) SELECT 'not_null:o_custkey' AS contrainte, count(*) FILTER (o_custkey IS NULL) AS n FROM t UNION ALL SELECT 'not_null:o_totalprice', count(*) FILTER (o_totalprice IS NULL) FROM t UNION ALL SELECT 'not_null:o_orderkey', count(*) FILTER (o_orderkey IS NULL) FROM t UNION ALL SELECT 'domaine:o_orderstatus', count(*) FILTER (o_orderstatus NOT IN ('O', 'F')) FROM t UNION ALL SELECT 'cle', (SELECT count(*) FROM t) - count(*) FROM (SELECT DISTINCT o_custkey, o_totalprice FROM t)")
def schema_faults(spark: SparkSession, d: str) -> DataFrame:
    """How many orders the declared table would refuse; every fiftieth has lost its customer."""
    lost = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 50 != 0, F.col("o_custkey")).alias("o_custkey"), "o_orderstatus", "o_totalprice")
    return schemas.faults(lost, ORDERS)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END, 'none') AS note FROM orders WHERE o_orderstatus <> 'P'")
def schema_enforced(spark: SparkSession, d: str) -> DataFrame:
    """Orders that pass the declared table, with its default where the note is missing."""
    some = table(spark, d, "orders").where("o_orderstatus <> 'P'").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("note"))
    return schemas.enforced(some, ORDERS)


@query("WITH a AS (SELECT o_custkey AS k, count(*) AS n, count(*) FILTER (o_orderstatus = 'P') AS nn, count(*) FILTER (o_totalprice < 5000) AS nz FROM orders GROUP BY 1) SELECT c_custkey, CASE WHEN n IS NULL THEN 'MANQUANT' WHEN nn = n THEN 'VIDE' WHEN nz > 0 THEN 'ZEROS_RESIDUELS' ELSE 'OK' END AS statut FROM customer LEFT JOIN a ON k = c_custkey")
def expected_artifacts(spark: SparkSession, d: str) -> DataFrame:
    actual = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "P").alias("n_nodata"), F.count_if(F.col("o_totalprice") < 5000).alias("n_zeros"))
    return quality.expected_artifacts(table(spark, d, "customer").select("c_custkey"), actual, ["c_custkey"])


@query("SELECT count(*) FILTER (o IS NULL) AS n_absent, round(100 * avg(CASE WHEN o IS NULL THEN 1 ELSE 0 END), 6) AS pct_absent, round(sum(CASE WHEN o IS NULL THEN c_acctbal ELSE 0 END), 6) AS area_absent FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS o FROM orders) ON o = c_custkey")
def without_pixels(spark: SparkSession, d: str) -> DataFrame:
    stats = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return rounded(zonal.without_pixels(table(spark, d, "customer"), stats, "c_custkey", "c_acctbal"))


@query()
def rf_predict(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").withColumn("label", F.col("label").cast("string"))
    fitted = model.train(rows, "embedding", "label")
    return model.predict(fitted, rows, "embedding", "vec_id", "label", "rf_base")


def _all() -> None:
    from fieldseries.plans import reports, spatial  # noqa: F401 - they register their queries here


def queries() -> dict[str, Query]:
    _all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _all()
    return dict(_SQL)
