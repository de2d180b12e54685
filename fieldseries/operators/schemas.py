"""Declared tables: columns, key, required columns, allowed values and defaults, held by one function that writes them."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldseries.operators.quality import violations


@dataclass(frozen=True)
class Table:
    """A table's columns with their types, in order. A default stands where the column is missing or null; key columns are required."""

    name: str
    columns: dict[str, str]
    key: tuple[str, ...]
    required: tuple[str, ...] = ()
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)
    defaults: dict[str, str] = field(default_factory=dict)  # as SQL

    @property
    def never_null(self) -> list[str]:
        return list(dict.fromkeys([*self.key, *self.required]))


STAMPED = {"version_pipeline": "string", "date_calcul": "timestamp"}
NOW = {"date_calcul": "current_timestamp()"}
SPLITS = ("train", "test")
# Names, types and constraints of the result tables.
TABLES = {
    t.name: t
    for t in (
        Table("monthly", {"id_parcel": "string", "mois": "string", "variable": "string", "mean": "float", "std": "float", "p10": "float", "p90": "float"}, ("id_parcel", "mois", "variable")),
        Table("completeness", {"id_parcel": "string", "mois": "string", "n_dates_valides_moy": "float", "pct_pixels_couverts": "float"}, ("id_parcel", "mois")),
        Table("ndvi_dates", {"id_parcel": "string", "date": "date", "mean": "float", "std": "float", "n_pixels": "int"}, ("id_parcel", "date")),
        Table("divergence", {"id_parcel": "string", "classe_declaree": "string", "dist_classe": "double", "seuil_div": "double", "divergent": "boolean", "dist_raccord": "double", "zone_raccord_orbital": "boolean", **STAMPED}, ("id_parcel",), ("classe_declaree", *STAMPED), {}, NOW),
        Table("phenology", {"id_parcel": "string", "classe_declaree": "string", "sos_date": "date", "pos_date": "date", "eos_date": "date", "los_jours": "int", "sos_en_bord": "boolean", "eos_en_bord": "boolean", "pos_en_bord": "boolean", "fiable": "boolean", "lambda_whittaker": "double", **STAMPED}, ("id_parcel",), ("classe_declaree", *STAMPED), {}, NOW),
        Table("classification", {"id_parcel": "string", "classe_predite": "string", "classe_declaree": "string", "proba_max": "double", "split": "string", "model_version": "string", "date_prediction": "timestamp"}, ("id_parcel",), ("classe_predite", "model_version", "date_prediction"), {"split": SPLITS}, {"date_prediction": "current_timestamp()"}),
    )
}


def conformed(df: DataFrame, table: Table) -> DataFrame:
    """The table's columns in their order and types: missing ones are null, defaults fill nulls. A column that the table does not have raises."""
    extra = [c for c in df.columns if c not in table.columns]
    if extra:
        raise ValueError(f"{table.name} has no column {', '.join(extra)}")

    def one(name: str, kind: str) -> Column:
        value = F.col(name) if name in df.columns else F.lit(None)
        return (F.coalesce(value, F.expr(table.defaults[name])) if name in table.defaults else value).cast(kind).alias(name)

    return df.select(*[one(n, k) for n, k in table.columns.items()])


def enforced(df: DataFrame, table: Table) -> DataFrame:
    """conformed() rows, each checked as it passes: the first null in a required column, value outside the allowed ones or repeated key raises. The rows of a key
    meet once, by a shuffle on the key."""
    rows = conformed(df, table).withColumn("__n", F.count("*").over(Window.partitionBy(*table.key)))
    checks = [(F.col(c).isNotNull(), f"{table.name}.{c} is null") for c in table.never_null]
    checks += [(F.coalesce(F.col(c).isin(*v), F.lit(True)), f"{table.name}.{c} has a value that is not allowed") for c, v in table.allowed.items()]
    checks.append((F.col("__n") == 1, f"{table.name} has a key twice: {', '.join(table.key)}"))
    ok = [F.assert_true(test, F.lit(said)).isNull() for test, said in checks]
    kept = rows
    for test in ok:
        kept = kept.where(test)
    return kept.drop("__n")


def faults(df: DataFrame, table: Table) -> DataFrame:
    """(contrainte, n): how many rows each of the table's constraints would refuse."""
    return violations(conformed(df, table), list(table.key), table.never_null, {c: list(v) for c, v in table.allowed.items()})


def write(df: DataFrame, folder: str, table: Table) -> DataFrame:
    """The enforced rows as Parquet in folder/name, in place of what was there. Rows are written beside it first: a row that fails leaves the old table."""
    spark = df.sparkSession
    draft = f"{folder}/.{table.name}-{uuid.uuid4().hex}"
    at = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    place = at(f"{folder}/{table.name}")
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        enforced(df, table).write.parquet(draft)
        fs.delete(place, True)
        if not fs.rename(at(draft), place):
            raise OSError(f"{table.name} could not be put in place")
    finally:
        fs.delete(at(draft), True)
    return spark.read.parquet(f"{folder}/{table.name}")


def create_if_absent(spark: SparkSession, folder: str, table: Table) -> DataFrame:
    """The table as it is, or an empty one of its columns."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{table.name}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        spark.createDataFrame([], ", ".join(f"{n} {k}" for n, k in table.columns.items())).write.parquet(f"{folder}/{table.name}")
    return spark.read.parquet(f"{folder}/{table.name}")
