"""Joins and reports over the derived tables: synthesis, gates, counts, and the JSON they are written as."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldseries.functions.columns import half_even


def put(df: DataFrame, other: DataFrame, on: str, column: str, how: str = "left") -> DataFrame:
    """Df with another table's column, which replaces one of that name; running it twice changes nothing."""
    return df.drop(column).join(other.select(on, column), on, how)


def within(df: DataFrame, reference: DataFrame, id: str) -> DataFrame:
    """Rows whose id is in the reference set."""
    return df.join(reference.select(id), id, "left_semi")


def enough_pixels(df: DataFrame, least: int = 1) -> DataFrame:
    """P12."""
    return df.where(F.col("n_pixels") >= least)


def located(divergence: DataFrame, centroids: DataFrame, id: str) -> DataFrame:
    """Divergence with the centroid of each parcel that has one."""
    return divergence.join(centroids.select(id, "cx", "cy"), id)


def synthesis(divergence: DataFrame, phenology: DataFrame, id: str) -> DataFrame:
    """Length of season of reliable parcels by divergence: count, mean, sample std, median."""
    both = divergence.select(id, "divergent").join(phenology.where("fiable").select(id, "los_jours"), id)
    return both.groupBy("divergent").agg(F.count("los_jours").alias("n"), F.avg("los_jours").alias("mean"), F.stddev_samp("los_jours").alias("std"), F.median("los_jours").alias("mediane"))


def agreement(classification: DataFrame, divergence: DataFrame, phenology: DataFrame, id: str, column: str = "classe_declaree") -> DataFrame:
    """Parcels whose declared class differs between the three tables (null differs from a value)."""
    a = classification.select(id, F.col(column).alias("a"))
    three = a.join(divergence.select(id, F.col(column).alias("b")), id, "left").join(phenology.select(id, F.col(column).alias("c")), id, "left")
    return three.agg(F.count("*").alias("n"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("n_divergence"), F.count_if(~F.col("a").eqNullSafe(F.col("c"))).alias("n_phenologie"))


def predictions_check(classification: DataFrame) -> DataFrame:
    """Rows and mean probability per version and split."""
    return classification.groupBy("model_version", "split").agg(F.count("*").alias("n"), F.round(F.avg("proba_max"), 3).alias("proba_moy"))


def load_check(divergence: DataFrame, phenology: DataFrame, expected: int | None = None) -> DataFrame:
    """Rows of both tables and of their flags, in one row; a count other than the expected raises."""
    a = divergence.agg(F.count("*").alias("n_divergence"), F.count_if("divergent").alias("n_divergentes"))
    made = a.join(phenology.agg(F.count("*").alias("n_phenologie"), F.count_if("fiable").alias("n_fiables")))  # one row each
    if expected is None:
        return made
    right = (F.col("n_divergence") == expected) & (F.col("n_phenologie") == expected)
    return made.where(F.assert_true(right, F.lit(f"{expected} rows are expected in both tables")).isNull())


def surface_total(parcels: DataFrame, area: str) -> DataFrame:
    """The rounded sum of surfaces."""
    return parcels.agg(F.round(F.sum(area), 2).alias("surface_totale"))


def density(parcels: DataFrame, area_km2: str) -> DataFrame:
    """Parcels, area, parcels per square kilometre."""
    return parcels.agg(F.count("*").alias("n"), F.round(F.sum(area_km2), 6).alias("surface_km2"), F.round(F.try_divide(F.count("*"), F.sum(area_km2)), 1).alias("densite"))


def extent(df: DataFrame, x: str, y: str) -> DataFrame:
    """The box around points."""
    return df.agg(F.min(x).alias("xmin"), F.min(y).alias("ymin"), F.max(x).alias("xmax"), F.max(y).alias("ymax"))


def ingestion_gate(raw: DataFrame, derived: DataFrame, id: str, srid: str, valid: Column) -> DataFrame:
    """The checks of an ingestion, each a flag, and ok: whether the derived tables may be used and the intermediate files go.

    Nothing is deleted here. valid: whether a derived row's geometry is.
    """
    r = raw.agg(F.count("*").alias("n_raw"), F.count_if(~F.col(srid).eqNullSafe(F.lit(2154))).alias("crs_raw"))
    d = derived.agg(F.count("*").alias("n_derived"), F.count_if(~F.col(srid).eqNullSafe(F.lit(2154))).alias("crs_derived"), F.count_if(~F.coalesce(valid, F.lit(False))).alias("n_invalides"))
    o = derived.join(raw.select(id), id, "left_anti").agg(F.count("*").alias("n_orphelines"))
    flags = {"crs_ok": "crs_raw = 0 AND crs_derived = 0", "volume_ok": "n_derived > 0 AND n_derived < n_raw", "orphelines_ok": "n_orphelines = 0", "geometrie_ok": "n_invalides = 0"}
    one = r.join(d).join(o)  # one row each
    return one.select("n_raw", "n_derived", "n_orphelines", "n_invalides", *[F.expr(e).alias(c) for c, e in flags.items()], F.expr(" AND ".join(f"({e})" for e in flags.values())).alias("ok"))


def require(gate: DataFrame) -> DataFrame:
    """The gate's row; raises where a check fails."""
    return gate.where(F.assert_true("ok", F.concat(F.lit("checks failed: "), F.to_json(F.struct(*gate.columns)))).isNull())


def availability_report(scenes: DataFrame, kept: DataFrame, first: str, last: str) -> DataFrame:
    """One row: scenes before and after deduplication, days of the window, covered and full days with their shares."""
    pairs = kept.groupBy("date").agg((F.bool_or(F.col("pair") == "nord") & F.bool_or(F.col("pair") == "sud")).alias("full"))
    days = kept.sparkSession.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date"))
    seen = days.join(pairs, "date", "left").agg(F.count("*").alias("jours_fenetre"), F.count("full").alias("jours_couverts"), F.count_if(F.coalesce("full", F.lit(False))).alias("jours_full_aoi"))
    n = scenes.agg(F.count("*").alias("scenes_brutes")).join(kept.agg(F.count("*").alias("scenes_dedup"))).join(seen)  # one row each
    share = lambda c: half_even(100 * F.col(c) / F.col("jours_fenetre"), 1)
    return n.select("scenes_brutes", "scenes_dedup", (F.col("scenes_brutes") - F.col("scenes_dedup")).alias("doublons_supprimes"), "jours_fenetre", "jours_couverts", share("jours_couverts").alias("pct_couverts"), "jours_full_aoi", share("jours_full_aoi").alias("pct_full_aoi"))


def as_json(report: DataFrame) -> DataFrame:
    """Each row of a (small) report as one JSON text."""
    return report.select(F.to_json(F.struct(*report.columns), {"ignoreNullFields": "false"}).alias("value"))


def write_report(report: DataFrame, path: str) -> None:
    """A report of one row as a JSON file."""
    as_json(report).coalesce(1).write.mode("overwrite").text(path)


def closing_report(parts: dict[str, DataFrame | None]) -> DataFrame:
    """Several reports of one row each as fields of one row; a report that is not there is null."""
    made: DataFrame | None = None
    for name, part in parts.items():
        if part is None:
            continue
        one = part.limit(1).select(F.struct(*part.columns).alias(name))
        made = one if made is None else made.join(one)
    if made is None:
        raise ValueError("no report is given")
    return made.select(*[F.col(n) if p is not None else F.lit(None).cast("string").alias(n) for n, p in parts.items()])


def shared_ids(left: DataFrame, right: DataFrame, id: str) -> DataFrame:
    """How many distinct ids both tables have, and each alone."""
    sides = left.select(id).distinct().withColumn("l", F.lit(True)).join(right.select(id).distinct().withColumn("r", F.lit(True)), id, "full")
    return sides.agg(F.count_if(F.col("l") & F.col("r")).alias("n_communs"), F.count_if(F.col("r").isNull()).alias("n_gauche"), F.count_if(F.col("l").isNull()).alias("n_droite"))
