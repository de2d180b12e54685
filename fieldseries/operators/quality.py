"""Checks of tables against each other, and table constraints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphans(derived: DataFrame, raw: DataFrame, keys: list[str]) -> DataFrame:
    """Rows without a match."""
    return derived.join(raw.select(*keys).distinct(), keys, "left_anti")


def duplicate_keys(df: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """The first few keys that occur more than once, in key order."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").orderBy(*keys).limit(n)


def table_counts(df: DataFrame, id: str, value: str) -> DataFrame:
    """Rows, distinct ids, least, greatest and mean value."""
    return df.agg(F.count("*").alias("n"), F.count_distinct(id).alias("n_ids"), F.min(value).alias("min"), F.max(value).alias("max"), F.avg(value).alias("mean"))


def consistency(left: DataFrame, right: DataFrame, id: str, column: str) -> DataFrame:
    """Rows, and those whose column differs between the tables (null differs from a value)."""
    joined = left.select(id, F.col(column).alias("a")).join(right.select(id, F.col(column).alias("b")), id, "left")
    return joined.agg(F.count("*").alias("n"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("n_differents"))


def expected_artifacts(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """MANQUANT without an artifact, VIDE if all is nodata, ZEROS_RESIDUELS if zeros remain, else OK. actual: keys, n, n_nodata, n_zeros."""
    joined = expected.join(actual, keys, "left")
    status = F.when(F.col("n").isNull(), "MANQUANT").when(F.col("n_nodata") == F.col("n"), "VIDE").when(F.col("n_zeros") > 0, "ZEROS_RESIDUELS").otherwise("OK")
    return joined.select(*keys, status.alias("statut"))


def complete_months(scenes: DataFrame, present: DataFrame) -> DataFrame:
    """Whether all scenes of a month are present."""
    marked = scenes.join(present.select("scene_id").distinct().withColumn("p", F.lit(True)), "scene_id", "left")
    return marked.groupBy("mois").agg(F.bool_and(F.coalesce("p", F.lit(False))).alias("complet"))


def violations(df: DataFrame, key: list[str], required: list[str], allowed: dict[str, list[str]]) -> DataFrame:
    """(contrainte, n) of a table's key, NOT NULL and value constraints."""
    rows = [F.struct(F.lit(f"not_null:{c}").alias("contrainte"), F.count_if(F.col(c).isNull()).alias("n")) for c in required]
    rows += [F.struct(F.lit(f"domaine:{c}").alias("contrainte"), F.count_if(~F.col(c).isin(v)).alias("n")) for c, v in allowed.items()]
    rows.append(F.struct(F.lit("cle").alias("contrainte"), (F.count("*") - F.count_distinct(F.struct(*key))).alias("n")))
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def zero_share(pixels: DataFrame, keys: list[str], value: str, most: float = 99.0) -> DataFrame:
    """Share of zero pixels in percent, and whether the band counts as read."""
    made = pixels.groupBy(*keys).agg((100 * F.avg((F.col(value) == 0).cast("int"))).alias("pct_zero"))
    return made.withColumn("valide", F.col("pct_zero") < most)


def cleanup_allowed(checked: DataFrame) -> DataFrame:
    """Whether all expected artifacts are there, which is when source files may go; they are not deleted here."""
    return checked.agg(F.coalesce(F.bool_and(F.col("statut") == "OK"), F.lit(False)).alias("nettoyage_permis"))
