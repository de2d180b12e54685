"""Entry points (Q06): ingest, process, ml and phenology, each from Parquet tables of a folder to Parquet tables of the same folder.

    python -m fieldseries.cli ingest FOLDER [--skip-rpg] [--skip-cdse]
    python -m fieldseries.cli process FOLDER [--skip-scl] [--skip-bands] [--skip-composites] [--skip-zonal]
    python -m fieldseries.cli ml FOLDER [--skip-search]
    python -m fieldseries.cli phenology FOLDER

Tables read: pages/*.json and aoi.geojson, parcels (id_parcel, code_group, code_cultu and wkb, rings or ring; a parcel of several parts has a row for each or a
multipolygon), pixel_obs (scene_id, tile_id, date, row, col, scl, bands).
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldseries.functions import columns as C
from fieldseries.operators import catalog, composites, divergence, geo, imputation, model, phenology, raster, reports, ringsets, schemas, smoothing, spatial, split, zonal
from fieldseries.operators import features as feat
from fieldseries.sources import tables

# Tiles with their strips, and the window of the reference year.
TILES = {"30UYV": "nord", "31UCQ": "nord", "30UYU": "sud", "31UCP": "sud"}
FIRST, LAST = "2023-09-01", "2024-12-31"
VERSION = "fieldseries-1"
INDICES = ("ndvi", "evi", "ndwi", "ndre")
BANDS = ("b02", "b04", "b05", "b06", "b07", "b08", "b11")


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return C.nan_to_null(spark.read.parquet(f"{folder}/{name}"))


def _write(df: DataFrame, folder: str, name: str) -> DataFrame:
    df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def _shaped(parcels: DataFrame) -> DataFrame:
    """Parcels with their geometry as ring sets."""
    if "wkb" in parcels.columns:
        return tables.wkb_rings(parcels, "wkb").drop("wkb")
    return parcels if "rings" in parcels.columns else parcels.withColumn("rings", ringsets.of_ring(F.col("ring"))).drop("ring")


def _whole(parts: DataFrame) -> DataFrame:
    """One row a parcel: the outline of its parts, and of unequal codes the smallest pair, so that repeated runs agree."""
    codes = parts.groupBy("id_parcel").agg(F.min(F.struct("code_group", "code_cultu")).alias("c")).select("id_parcel", "c.*")
    return ringsets.dissolve(parts, "id_parcel").join(codes, "id_parcel")


def ingest(spark: SparkSession, folder: str, skip_rpg: bool = False, skip_cdse: bool = False) -> None:
    """Parcels of the area with their checks, and the deduplicated catalogue with its report."""
    if not skip_rpg:
        raw = ringsets.with_envelope(_shaped(_read(spark, folder, "parcels")))
        areas = tables.shapes(spark, f"{folder}/aoi.geojson", metres=True).select(F.lit(0).alias("area"), "rings")
        aoi = ringsets.dissolve(areas, "area").select(F.col("rings").alias("aoi"))  # one geometry, so that no part comes twice
        spatial.write_clustered(spatial.in_areas(raw, aoi, "rings").drop("aoi"), f"{folder}/parcels_aoi")
        kept = _read(spark, folder, "parcels_aoi")
        _write(_whole(kept), folder, "parcels_whole")
        gate = reports.ingestion_gate(raw.withColumn("srid", F.lit(2154)), kept.withColumn("srid", F.lit(2154)), "id_parcel", "srid", ringsets.valid(F.col("rings")))
        reports.write_report(gate, f"{folder}/report_parcels")
        reports.require(gate).collect()  # one row
    if not skip_cdse:
        scenes = tables.catalogue_pages(spark, f"{folder}/pages", list(TILES), FIRST, LAST, TILES)
        kept = _write(catalog.dedup_latest(scenes, ["tile_id", "date"]), folder, "catalogue")
        _write(catalog.monthly_availability(kept), folder, "availability")
        reports.write_report(reports.availability_report(scenes, kept, FIRST, LAST), f"{folder}/report_scenes")


def process(spark: SparkSession, folder: str, skip_scl: bool = False, skip_bands: bool = False, skip_composites: bool = False, skip_zonal: bool = False) -> None:
    """Valid fractions, indices, monthly composites, statistics of parcels."""
    pixels = _read(spark, folder, "pixel_obs")
    if not skip_scl:
        shares = composites.valid_fraction(pixels, ["scene_id"], "scl > 0", f"scl IN {C.INVALID_CLASSES}")
        _write(reports.put(_read(spark, folder, "catalogue"), shares, "scene_id", "f_valid_aoi"), folder, "scenes")
    if not skip_bands:
        scenes = catalog.retained(_read(spark, folder, "scenes")).select("scene_id", "mois")
        valid = {b: C.valid_pixel(F.col("scl"), F.col(b).cast("double")) for b in BANDS}
        clear = pixels.join(scenes, "scene_id").withColumns(valid)
        pair = lambda a, b: C.normalized_difference(F.col(a), F.col(b))
        made = clear.withColumns({"ndvi": pair("b08", "b04"), "ndwi": pair("b08", "b11"), "ndre": pair("b08", "b05"), "evi": C.evi(F.col("b08"), F.col("b04"), F.col("b02"))})
        made.write.mode("overwrite").partitionBy("mois").parquet(f"{folder}/clear")
    if not skip_composites:
        clear = _read(spark, folder, "clear")
        long = clear.select("row", "col", "date", *INDICES, *BANDS).unpivot(["row", "col", "date"], [*INDICES, *BANDS], "variable", "value")
        raster.write_pixels(composites.two_stage_median(long, ["row", "col", "variable"]).where("composite IS NOT NULL"), f"{folder}/composites")
    if not skip_zonal:
        parcels = _read(spark, folder, "parcels_whole")
        grid = raster.Grid.of(parcels, "rings")
        labels = _write(raster.rasterize(parcels, grid, "id_parcel", "rings"), folder, "labels")  # the greatest id stands where parcels overlap
        on = lambda df: df.join(labels, ["row", "col"])
        schemas.write(zonal.zonal_stats(on(_read(spark, folder, "composites")), ["id_parcel", "mois", "variable"], "composite"), folder, schemas.TABLES["monthly"])
        clear = _read(spark, folder, "clear")
        seen = clear.where("ndvi IS NOT NULL").groupBy("row", "col", "mois").agg(F.count_distinct("date").alias("n"))
        every = labels.join(F.broadcast(clear.select("mois").distinct()))  # a calendar's months
        counts = every.join(seen, ["row", "col", "mois"], "left").withColumn("n_valid", F.coalesce("n", F.lit(0)))
        schemas.write(zonal.completeness(counts, ["id_parcel", "mois"]), folder, schemas.TABLES["completeness"])
        daily = clear.groupBy("row", "col", "date").agg(F.median("ndvi").alias("ndvi"))
        schemas.write(zonal.stats_by_date(on(daily), ["id_parcel", "date"], "ndvi"), folder, schemas.TABLES["ndvi_dates"])


def _features(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str], list[str]]:
    monthly = _read(spark, folder, "monthly")
    months = sorted(r["mois"] for r in monthly.select("mois").distinct().collect())  # a calendar's
    return monthly, sorted(r["variable"] for r in monthly.select("variable").distinct().collect()), months


def _classes(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "parcels_whole").select("id_parcel", C.crop_class(F.col("code_group").cast("string"), F.col("code_cultu")).alias("classe"), ringsets.centroid(F.col("rings")).alias("c")).select("id_parcel", "classe", F.col("c.x").alias("cx"), F.col("c.y").alias("cy"))


def ml(spark: SparkSession, folder: str, skip_search: bool = True, **forest: int) -> None:
    """Imputed features, block split, forest, report, predictions of all parcels."""
    monthly, variables, months = _features(spark, folder)
    actions = _read(spark, folder, "completeness").select("id_parcel", "mois", imputation.qc_action(F.col("pct_pixels_couverts")).alias("action"))
    cells = feat.wide_by_month(monthly, "id_parcel", ["mean", "std", "p10", "p90"], variables)
    names = [c for c in cells.columns if c not in ("id_parcel", "mois")]
    filled = imputation.impute(actions.join(cells, ["id_parcel", "mois"], "left"), "id_parcel", names, months)
    key = F.concat_ws("_", "variable", "mois")
    packed = filled.groupBy("id_parcel").agg(F.map_from_entries(F.collect_list(F.struct(key.alias("k"), "value"))).alias("m"))
    wanted = F.array(*[F.lit(f"{n}_{m}") for n in names for m in months])
    rows = packed.select("id_parcel", F.transform(wanted, lambda k: F.try_element_at("m", k)).alias("x"))
    blocked = split.block_split(split.block_ids(_classes(spark, folder)), "id_parcel").select("id_parcel", "classe", "split")
    table = _write(rows.join(blocked, "id_parcel"), folder, "features")
    train = table.where("split = 'train'")
    if not skip_search:
        _write(model.search(train, "x", "classe", "id_parcel"), folder, "search")
    fitted = model.train(train, "x", "classe", **forest)
    guessed = model.predict(fitted, table, "x", "id_parcel", "classe", "rf_base").join(table.select("id_parcel", "split"), "id_parcel")
    guessed = schemas.write(guessed, folder, schemas.TABLES["classification"])  # the time of writing is a default
    classes = model.report(model.confusion(guessed.where("split = 'test'"), "classe_declaree", "classe_predite"), "classe_declaree", "classe_predite")
    _write(classes, folder, "report_classes")
    _write(model.averages(classes), folder, "report_model")
    bagged = model.train_bags(train, "x", "classe", "id_parcel", **forest)
    _write(model.unseen_accuracy(model.unseen_votes(bagged, train, "x", "id_parcel", "classe")), folder, "report_unseen")
    _write(reports.predictions_check(guessed), folder, "report_predictions")


def season(spark: SparkSession, folder: str) -> None:
    """Divergence of the features as they are with the flag of the orbits' seam, seasons of smoothed series, and their synthesis.
    Without the seam's scenes or their footprints the distance is null and the flag false."""
    monthly, _, _ = _features(spark, folder)
    classes = _classes(spark, folder)
    stats = monthly.select("id_parcel", "mois", "variable", F.explode(F.create_map(*[x for s in ("mean", "std", "p10", "p90") for x in (F.lit(s), F.col(s).cast("double"))])).alias("stat", "value"))
    long = stats.select("id_parcel", F.concat_ws("_", "variable", "stat", "mois").alias("feature"), "value").join(classes.select("id_parcel", "classe"), "id_parcel")
    flagged = divergence.flags(divergence.rms_distance(divergence.zscore(long), "id_parcel")).join(classes.select("id_parcel", "cx", "cy"), "id_parcel")
    prints = divergence.seam_scenes(_read(spark, folder, "scenes")).where("footprint IS NOT NULL")
    lines = prints.select(geo.reproject(geo.wkt_ring(geo.footprint(F.col("footprint")))).alias("boundary"))
    flagged = divergence.seam_flag(flagged, lines, "id_parcel").withColumnRenamed("classe", "classe_declaree").withColumn("version_pipeline", F.lit(VERSION))
    flagged = schemas.write(flagged.drop("cx", "cy", "pct_features_valides"), folder, schemas.TABLES["divergence"])
    obs = reports.enough_pixels(_read(spark, folder, "ndvi_dates")).withColumnRenamed("mean", "ndvi")
    first, days = obs.agg(F.min("date"), F.datediff(F.max("date"), F.min("date"))).first()
    series = smoothing.whittaker(smoothing.dense_series(smoothing.weighted_bins(obs, "id_parcel"), obs, "id_parcel", max(3, days // 5 + 1)), "id_parcel")
    dated = phenology.seasons(series.select("id_parcel", "z").join(classes.select("id_parcel", "classe"), "id_parcel"), str(first)).withColumnRenamed("classe", "classe_declaree")
    dated = schemas.write(dated.withColumns({"lambda_whittaker": F.lit(smoothing.PENALTY), "version_pipeline": F.lit(VERSION)}), folder, schemas.TABLES["phenology"])
    _write(phenology.class_summary(dated, "classe_declaree"), folder, "report_phenology")
    _write(reports.synthesis(flagged, dated, "id_parcel"), folder, "report_synthesis")


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(description="Runs a part of the analysis over a folder of tables.")
    parts = parser.add_subparsers(dest="part", required=True)
    for part, flags in {"ingest": ("rpg", "cdse"), "process": ("scl", "bands", "composites", "zonal"), "ml": ("search",), "phenology": ()}.items():
        sub = parts.add_parser(part)
        sub.add_argument("folder")
        for flag in flags:
            sub.add_argument(f"--skip-{flag}", action="store_true")
    given = vars(parser.parse_args(args))
    run = {"ingest": ingest, "process": process, "ml": ml, "phenology": season}[given.pop("part")]
    run(spark or SparkSession.builder.appName("fieldseries").getOrCreate(), given.pop("folder"), **given)


if __name__ == "__main__":
    main()
