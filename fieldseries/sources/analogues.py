"""The test tables in the roles of the engine's own tables: pixels, scenes, dated indices, features, parcels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldseries.functions.columns import month
from fieldseries.operators import geo
from fieldseries.sources.tables import table

VARIABLES = ("quantity", "extendedprice", "discount", "tax")


def _orders(spark: SparkSession, d: str, place: str | None = None) -> DataFrame:
    return table(spark, d, "lineitem", place).join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))


def pixels(spark: SparkSession, d: str) -> DataFrame:
    """id_parcel, mois, variable, value: a pixel is a line of an order."""
    return pixels_wide(spark, d).unpivot(["id_parcel", "mois"], list(VARIABLES), "variable", "value")


def pixels_wide(spark: SparkSession, d: str, place: str | None = None) -> DataFrame:
    """id_parcel, mois and one column for each variable; where place is given, a column of that name has the pixel's place in its table."""
    return _orders(spark, d, place).select(F.col("o_custkey").alias("id_parcel"), month(F.col("l_shipdate")).alias("mois"), *[F.col(f"l_{v}").alias(v) for v in VARIABLES], *[place] * bool(place))


def pixel_counts(spark: SparkSession, d: str) -> DataFrame:
    """id_parcel, mois, pixel, n_valid."""
    lines = _orders(spark, d).select(F.col("o_custkey").alias("id_parcel"), month(F.col("l_shipdate")).alias("mois"), F.col("l_linenumber").alias("pixel"), "l_returnflag")
    return lines.groupBy("id_parcel", "mois", "pixel").agg(F.count_if(F.col("l_returnflag") == "N").alias("n_valid"))


def scenes(spark: SparkSession, d: str) -> DataFrame:
    """scene_id, tile_id, date, pair, orbit_relative, f_valid_aoi (some missing)."""
    pair = F.when(F.col("event_type").isin("view", "click"), "nord").otherwise("sud")
    return table(spark, d, "events").select(
        F.col("event_id").cast("string").alias("scene_id"), F.col("event_type").alias("tile_id"), F.to_date("ts").alias("date"), pair.alias("pair"),
        F.get(F.array(F.lit(51), F.lit(94), F.lit(137)), (F.col("user_id") % 3).cast("int")).alias("orbit_relative"), F.when(F.col("event_id") % 17 != 0, F.least(F.col("value") / 100, F.lit(1.0))).alias("f_valid_aoi"),
    )


def dated(spark: SparkSession, d: str) -> DataFrame:
    """id_parcel, date, tile_id, ndvi, n_pixels."""
    return table(spark, d, "events").select(F.col("user_id").alias("id_parcel"), F.to_date("ts").alias("date"), F.col("event_type").alias("tile_id"), (F.col("value") / 500).alias("ndvi"), (F.get_json_object("props", "$.k").cast("int") + 1).alias("n_pixels"))


def features(spark: SparkSession, d: str) -> DataFrame:
    """id_parcel, classe, feature, value (some missing)."""
    rows = table(spark, d, "embeddings").select(F.col("vec_id").alias("id_parcel"), F.col("label").alias("classe"), F.posexplode("embedding").alias("feature", "v"))
    return rows.select("id_parcel", "classe", "feature", F.when((F.col("id_parcel") * 7 + F.col("feature")) % 29 != 0, F.col("v").cast("double")).alias("value"))


def monthly_shares(spark: SparkSession, d: str) -> DataFrame:
    """id_parcel, mois, pct, quantity: suppliers' months, pct the share of returned lines and quantity the mean of two of them or more."""
    back = F.col("l_returnflag") == "R"
    return table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("id_parcel"), month(F.col("l_shipdate")).alias("mois")).agg((100 * F.avg(back.cast("int"))).alias("pct"), F.when(F.count_if(back) > 1, F.avg(F.when(back, F.col("l_quantity")))).alias("quantity"))


def parcels(spark: SparkSession, d: str, spread: bool = False) -> DataFrame:
    """id_parcel, classe, code_group, surf_parc, cx, cy and ring: a rectangle of that centre, wide as the key says. With spread the rows come in as many
    tasks as a shuffle has, for work that is dear by the row: a few small files hold very many."""
    c = table(spark, d, "customer")
    c = c.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "c_custkey") if spread else c
    x, y = (F.col("c_custkey") * 7919 % 60000).cast("double"), (F.col("c_custkey") * 104729 % 50000).cast("double")
    w, h = (F.col("c_custkey") % 40 + 10).cast("double"), (F.col("c_nationkey") + 5).cast("double")
    p = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    ring = F.array(p(x, y), p(x + w, y), p(x + w, y + h), p(x, y + h), p(x, y))
    return c.select(F.col("c_custkey").alias("id_parcel"), F.col("c_mktsegment").alias("classe"), F.col("c_nationkey").alias("code_group"), F.when(F.col("c_mktsegment") == "FURNITURE", "BTN").otherwise("X").alias("code_cultu"), F.col("c_acctbal").alias("surf_parc"), x.alias("cx"), y.alias("cy"), ring.alias("ring"))


def classification(spark: SparkSession, d: str) -> DataFrame:
    """id_parcel, classe_predite, classe_declaree, proba_max, split, model_version."""
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(k.alias("id_parcel"), F.element_at(F.array(F.lit("colza"), F.lit("mais"), F.lit("lin")), (k % 3 + 1).cast("int")).alias("classe_predite"), F.col("c_mktsegment").alias("classe_declaree"), ((k % 97) / 97).alias("proba_max"), F.when(k % 5 == 0, "test").otherwise("train").alias("split"), F.concat(F.lit("rf_"), (k % 2).cast("string")).alias("model_version"))


def divergence(spark: SparkSession, d: str) -> DataFrame:
    """id_parcel, classe_declaree (another one for some), divergent (missing parcels)."""
    k = F.col("c_custkey")
    return table(spark, d, "customer").where(k % 7 != 3).select(k.alias("id_parcel"), F.when(k % 11 == 0, "autres").otherwise(F.col("c_mktsegment")).alias("classe_declaree"), (k % 4 == 1).alias("divergent"))


def phenology(spark: SparkSession, d: str) -> DataFrame:
    """id_parcel, classe_declaree (some missing), los_jours, fiable."""
    k = F.col("c_custkey")
    return table(spark, d, "customer").where(k % 6 != 2).select(k.alias("id_parcel"), F.when(k % 13 != 0, F.col("c_mktsegment")).alias("classe_declaree"), (k * 37 % 211 + 30).cast("int").alias("los_jours"), (k % 5 != 0).alias("fiable"))


def fields(spark: SparkSession, d: str, spread: bool = False) -> DataFrame:
    """Parcels in metres of Lambert-93, with envelope columns."""
    moved = parcels(spark, d, spread).withColumn("ring", F.transform("ring", lambda p: F.struct((p["x"] + 600_000).alias("x"), (p["y"] + 6_880_000).alias("y")))).withColumns({"cx": F.col("cx") + 600_000, "cy": F.col("cy") + 6_880_000})
    return geo.with_envelope(moved)
