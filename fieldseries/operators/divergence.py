"""Divergence of a parcel from the median profile of its declared class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldseries.functions.session import kept
from fieldseries.operators import catalog, geo, ranks


def zscore(features: DataFrame, feature: str = "feature", value: str = "value") -> DataFrame:
    """(x - mean) / population std per feature over all rows; a std of 0 counts as 1. Features are few, so the
    planner broadcasts their statistics where their size allows."""
    stats = features.groupBy(feature).agg(F.avg(value).alias("mu"), F.stddev_pop(value).alias("sd"))
    scale = F.when(F.col("sd") == 0, F.lit(1.0)).otherwise(F.col("sd"))
    return features.join(stats, feature).withColumn("z", (F.col(value) - F.col("mu")) / scale).drop("mu", "sd")


def class_profile(scored: DataFrame, classe: str = "classe", feature: str = "feature") -> DataFrame:
    """Median z per class and feature, by rank: a class's column is never in one task's memory. null where a class has no value of a feature."""
    found = ranks.percentiles(scored, [classe, feature], "z", [0.5])
    return found.select(classe, feature, F.get("p", F.lit(0)).alias("mediane"))


def rms_distance(scored: DataFrame, id: str, classe: str = "classe", feature: str = "feature") -> DataFrame:
    """Root mean square of z against the class profile over features that both have, and the share of features present."""
    joined = scored.join(class_profile(scored, classe, feature), [classe, feature])
    return joined.groupBy(id, classe).agg(F.sqrt(F.avg(F.pow(F.col("z") - F.col("mediane"), F.lit(2)))).alias("dist_classe"), (100 * F.avg(F.col("z").isNotNull().cast("int"))).alias("pct_features_valides"))


def thresholds(distances: DataFrame, classe: str = "classe", k: float = 2.0) -> DataFrame:
    """Quartiles of the distance and median + k * interquartile range per class."""
    made = ranks.percentiles(distances, [classe], "dist_classe", [0.25, 0.5, 0.75]).select(classe, F.col("p").alias("q"), F.col("n_rows").alias("n"))
    parts = [F.get("q", F.lit(i)).alias(f"q{p}") for i, p in enumerate((25, 50, 75))]
    return made.select(classe, *parts, "n").withColumn("seuil_div", F.col("q50") + k * (F.col("q75") - F.col("q25")))


def flags(distances: DataFrame, classe: str = "classe", k: float = 2.0) -> DataFrame:
    """Divergent where the distance exceeds the class's threshold; a missing distance is not divergent."""
    distances = kept(distances, "distances")  # a row a parcel, read twice, after joins over all features
    limits = thresholds(distances, classe, k).select(classe, "seuil_div")
    return distances.join(limits, classe).withColumn("divergent", F.coalesce(F.col("dist_classe") > F.col("seuil_div"), F.lit(False)))


def rates(flagged: DataFrame, classe: str = "classe") -> DataFrame:
    """Divergent rows per class and their rate over all rows, missing distances included."""
    return flagged.groupBy(classe).agg(F.count_if("divergent").alias("n_div"), (F.count_if("divergent") / F.count("*")).alias("taux"))


# The tile and the two orbits whose seam is looked at, and how near to it counts, in metres.
SEAM_TILE, SEAM_ORBITS, SEAM_METRES = "30UYV", (51, 94), 2000.0


def seam_scenes(scenes: DataFrame, tile: str = SEAM_TILE, orbits: tuple[int, int] = SEAM_ORBITS) -> DataFrame:
    """Of each of the two orbits over a tile the first non-null value of every column by falling valid fraction."""
    found = scenes.where((F.col("tile_id") == tile) & F.col("orbit_relative").isin(*orbits))
    rank = F.struct(F.coalesce("f_valid_aoi", F.lit(-1.0)).alias("f"), "scene_id")
    return catalog.first_nonnull(found.withColumn("__o", rank), ["orbit_relative"], ["__o"]).drop("__o")


def seam_flag(parcels: DataFrame, footprints: DataFrame, id: str, boundary: str = "boundary", limit: float = SEAM_METRES) -> DataFrame:
    """parcels(id, cx, cy, ...) with the distance to the nearest of the orbits' boundaries (rings in metres; two rows) and whether it is
    below the limit. Without footprints the distance is null and the flag false, and the run goes on."""
    lines = footprints.agg(F.collect_list(boundary).alias("__lines"))  # one row of two rings
    away = F.array_min(F.transform("__lines", lambda line: geo.distance_to_line(line, F.col("cx"), F.col("cy"))))
    out = parcels.drop("dist_raccord", "zone_raccord_orbital").crossJoin(F.broadcast(lines)).withColumn("dist_raccord", away).drop("__lines")
    return out.withColumn("zone_raccord_orbital", F.coalesce(F.col("dist_raccord") < limit, F.lit(False)))
