"""Reading: Parquet tables, scene catalogues with attribute lists, GeoJSON rings, service responses, file fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldseries.functions.columns import attribute, nan_to_null, scene_tile
from fieldseries.functions.session import ship
from fieldseries.operators import ringsets
from fieldseries.operators.catalog import selected
from fieldseries.operators.geo import reproject

CATALOGUE_SCHEMA = "value array<struct<Id:string,Name:string,ContentDate:struct<Start:timestamp>,Footprint:string,Attributes:array<struct<Name:string,Value:string>>>>"
GEOJSON_SCHEMA = "features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:array<array<array<double>>>>>>"


def table(spark: SparkSession, folder: str, name: str, place: str | None = None) -> DataFrame:
    """A Parquet table with NaN read as NULL. place names a column for where a row lies in the table: struct(file, row of the file)."""
    read = spark.read.parquet(f"{folder}/{name}.parquet")
    if place:
        read = read.select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias(place))
    return nan_to_null(read)


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """S05, offline: pages of a catalogue service saved as JSON -> one row per scene, without the .SAFE ending."""
    items = spark.read.schema(CATALOGUE_SCHEMA).json(path, multiLine=True).select(F.explode("value").alias("p"))
    scene = F.regexp_replace("p.Name", r"\.SAFE$", "")
    return items.select(F.col("p.Id").alias("product_id"), scene.alias("scene_id"), F.col("p.ContentDate.Start").alias("datetime_utc"), attribute(F.col("p.Attributes"), "cloudCover").cast("double").alias("cloud_cover_catalogue"), attribute(F.col("p.Attributes"), "relativeOrbitNumber").cast("int").alias("orbit_relative"), F.col("p.Footprint").alias("footprint"))


def catalogue_pages(spark: SparkSession, path: str, tiles: list[str], first: str, last: str, pairs: dict[str, str]) -> DataFrame:
    """All saved pages of the tiles' queries, with tile, strip, date and a valid fraction yet to be measured, by time and tile."""
    found = catalogue(spark, path).withColumns({"tile_id": scene_tile(F.col("scene_id")), "date": F.to_date("datetime_utc"), "f_valid_aoi": F.lit(None).cast("double")})
    return selected(found, tiles, first, last, pairs)


def polygons(spark: SparkSession, path: str, metres: bool = False) -> DataFrame:
    """Outer rings of a GeoJSON collection, as arrays of struct(x, y); in metres of Lambert-93 if wanted."""
    f = spark.read.schema(GEOJSON_SCHEMA).json(path, multiLine=True).select(F.explode("features").alias("f"))
    ring = F.transform(F.get("f.geometry.coordinates", F.lit(0)), lambda c: F.struct(F.get(c, 0).alias("x"), F.get(c, 1).alias("y")))
    return f.select(F.col("f.properties").alias("properties"), (reproject(ring) if metres else ring).alias("ring"))


def shapes(spark: SparkSession, path: str, metres: bool = False) -> DataFrame:
    """The ring sets of a GeoJSON collection of polygons and multipolygons, holes included; in metres of Lambert-93 if wanted. Other geometries raise, a
    feature without one is null."""
    f = spark.read.schema("features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>").json(path, multiLine=True)
    f = f.select(F.explode("features").alias("f")).select("f.properties", F.col("f.geometry.type").alias("t"), F.col("f.geometry.coordinates").alias("c"))
    several = F.when(F.col("t") == "MultiPolygon", F.from_json("c", "array<array<array<array<double>>>>")).when(F.col("t") == "Polygon", F.array(F.from_json("c", "array<array<array<double>>>")))
    several = several.when(F.col("t").isNotNull(), F.raise_error(F.concat(F.lit("no polygon: "), "t")).cast("array<array<array<array<double>>>>"))
    point = lambda c: F.struct(F.get(c, 0).alias("x"), F.get(c, 1).alias("y"))
    place = (lambda c: reproject(F.transform(c, point))) if metres else (lambda c: F.transform(c, point))
    turned = lambda ring, i: F.when((ringsets.doubled(ring) < 0) == (i > 0), ring).otherwise(F.reverse(ring))
    polygon = lambda rings: F.transform(F.transform(rings, place), turned)
    return f.select("properties", F.flatten(F.transform(several, polygon)).alias("rings"))


def wkb_rings(df: DataFrame, wkb: str, rings: str = "rings") -> DataFrame:
    """The ring sets of a column of WKB polygons and multipolygons, as a geometry table's export to Parquet holds them. What cannot be read raises."""
    ship(df.sparkSession)
    return df.withColumn(rings, ringsets.from_wkb(F.col(wkb)))


def feature_properties(spark: SparkSession, path: str) -> DataFrame:
    """The properties of a feature service's response, one row a feature."""
    return spark.read.schema(GEOJSON_SCHEMA).json(path, multiLine=True).select(F.explode("features").alias("f")).select("f.properties")


def write_reference(spark: SparkSession, path: str, target: str, columns: list[str]) -> None:
    """Named properties of a feature service's response as CSV with a header."""
    feature_properties(spark, path).select(*[F.col("properties")[c].alias(c) for c in columns]).distinct().orderBy(*columns).write.mode("overwrite").csv(target, header=True)


def fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of files."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))
