"""Sinks on Parquet tables: insert if absent, upsert, and work still to do. A new version is written beside the old one, then named current."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def insert_if_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows stay; new rows of other keys are added."""
    return old.unionByName(new.join(old.select(*keys), keys, "left_anti").select(*old.columns))


def upsert(old: DataFrame, new: DataFrame, keys: list[str], stamp: str | None = None) -> DataFrame:
    """New rows replace old ones of their keys, and take the time of writing in the column `stamp`. A key that occurs twice in new raises, as it has no one row."""
    if stamp:
        new = new.withColumn(stamp, F.current_timestamp())
    once = new.withColumn("__n", F.count("*").over(Window.partitionBy(*keys))).where(F.assert_true(F.col("__n") == 1, F.lit("two new rows have one key")).isNull()).drop("__n")
    return once.select(*old.columns).unionByName(old.join(new.select(*keys), keys, "left_anti").select(*old.columns))


def last_of(rows: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row a key: the greatest by the order columns, then by all others, so that a repeated run chooses the same."""
    rest = [c for c in rows.columns if c not in keys]
    if not rest:
        return rows.distinct()
    rank = [c for c in order or [] if c in rest] + [c for c in rest if c not in (order or [])]
    return rows.groupBy(*keys).agg(F.max(F.struct(*rank)).alias("__r")).select(*keys, "__r.*").select(*rows.columns)


def absent(rows: DataFrame, loaded: DataFrame, unit: str) -> DataFrame:
    """Rows of the units (months) of which the target has none; a unit that is there is skipped as a whole, corrections included."""
    return rows.join(loaded.select(unit).distinct(), unit, "left_anti")


def replace_table(df: DataFrame, name: str, expected: int | None = None) -> int:
    """A catalog table made anew from df, and its row count, which is checked if one is expected."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)
    n = df.sparkSession.table(name).count()
    if expected is not None and n != expected:
        raise ValueError(f"{name} has {n} rows, {expected} are expected")
    return n


def pending(wanted: DataFrame, manifest: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Artifacts without a manifest row of this version at least as new as their sources (column src_max_ts)."""
    fresh = manifest.where(F.col("version") == version).select(*keys, F.col("src_max_ts").alias("__ts"))
    joined = wanted.join(fresh, keys, "left")
    return joined.where(F.col("__ts").isNull() | (F.col("__ts") < F.col("src_max_ts"))).drop("__ts")


def write_version(df: DataFrame, path: str, version: int) -> str:
    """Write as a new version, so a table that is being read is never overwritten; readers see it once the job has committed."""
    where = f"{path}/v{version:06d}"
    df.write.mode("errorifexists").parquet(where)
    return where
