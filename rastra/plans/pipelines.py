"""Flows: from scenes to labelled chips, and from a composite to stored detections."""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rastra import sinks
from rastra.functions import geo
from rastra.functions.algebra import BANDS, at_least, composite_score, index_columns, mask_clouds, score_evidence
from rastra.operators import catalog, composite, convolution, dedupe, grid, inference, joins, regions, serving
from rastra.sources import manifests, rasters
from rastra.sources.manifests import Settings
from rastra.storage import settle


def ingest_and_preprocess(looks: DataFrame, sites: DataFrame, tile: int, overlap: int, height: int, width: int, affine: tuple, method: str = "median", mask: bool = True, min_valid: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Looks at a raster to its stretched composite and its chips with labels' flags and splits.

    ``sites`` have ``x, y, r`` in world units and their buffer's box. Clouds
    are left out of the composite unless ``mask`` is false.
    """
    clear = mask_clouds(looks, fill=None) if mask else looks
    stretched = composite.percentile_stretch(composite.temporal_composite(clear, method))
    chips = grid.chip_raster(stretched, tile, overlap, height, width, min_valid, affine)
    flagged = joins.flag_positive(chips.withColumn("chip", F.xxhash64("raster_id", "tile_id")), sites, "chip", float(tile * abs(affine[0])))
    shuffled = flagged.withColumn("shuffle", F.pmod(F.xxhash64(F.lit(42), "chip"), F.lit(1 << 20)))
    return stretched, dedupe.stratified_split(shuffled, key="chip").drop("shuffle")


def train_model(pixels: DataFrame, label: str = "label", steps: int = 25) -> inference.LinearModel:
    """Fit the linear model to stretched, labelled pixels."""
    return inference.fit_newton(pixels.withColumns(index_columns()), target=label, steps=steps)


def scan_and_detect(pixels: DataFrame, model: inference.Model, tile: int, overlap: int, height: int, width: int, threshold: float = 0.5, min_px: int = 50, affine: tuple = (10.0, 0.0, 0.0, 0.0, -10.0, 0.0), method: str = "dbscan", eps: float = 2000.0, iou: float = 0.3, ideal_km2: float = 2.0, outlines: bool = False) -> DataFrame:
    """Score composites, extract regions, rate them and drop repeats within a raster; best first.

    The rating comes before deduplication, so a cluster keeps its best rating;
    its parts stay in ``evidence``. Distances are in the raster's own units. The
    composite, the probabilities and the rated regions are written once each, as
    several steps read them. With ``outlines`` what is left has ``rings``, its outline in the
    raster's units, outer ring first; only these regions are traced.
    """
    pixels = settle(pixels.select("raster_id", "row", "col", *BANDS), "composite")
    prob = settle(inference.sliding_window(pixels, model, tile, overlap, height, width), "probabilities")
    labelled = regions.label_regions(prob.where(at_least("prob", threshold)), width, height * width)
    if outlines:
        labelled = settle(labelled, "labelled")
    found = regions.region_features(labelled, "prob", affine, min_px)
    area = F.col("area") / 1e6
    rated = found.withColumns(
        {
            "area_km2": area,
            "score": composite_score("mean_value", "compactness", area, ideal=ideal_km2),
            "evidence": score_evidence("mean_value", "compactness", area, ideal=ideal_km2),
            "id": F.col("component"),
            "x": F.col("centroid_x"),
            "y": F.col("centroid_y"),
        }
    )
    best = dedupe.deduplicate(settle(rated, "detections"), method, eps, iou, size=float(max(tile * abs(affine[0]), 1.0)), by="raster_id")
    return regions.add_outlines(settle(best, "kept_detections"), labelled, affine).orderBy(F.desc("score"), "id") if outlines else best


def composites_of_areas(aois: DataFrame, scenes: DataFrame, looks: DataFrame, start: str, end: str, max_cloud: float = 20.0, limit: int = 50, method: str = "median") -> DataFrame:
    """A composite of each area from its newest scenes' looks (``scene_id`` and pixels of the area's grid): ``aoi`` and its pixels.

    An area's ``raster_id`` is a hash of its name below 2^31, so that pixel numbers fit a long.
    """
    chosen = catalog.scenes_of_aois(aois, scenes, start, end, max_cloud, limit).select(F.col("name").alias("aoi"), "scene_id")
    seen = looks.drop("raster_id").join(chosen, ["aoi", "scene_id"] if "aoi" in looks.columns else "scene_id")
    made = composite.temporal_composite(mask_clouds(seen.withColumn("raster_id", area_number("aoi")), fill=None), method)
    return made.join(F.broadcast(chosen.select("aoi").distinct().withColumn("raster_id", area_number("aoi"))), "raster_id")  # a row an area of the configuration


def detect_in_files(spark: SparkSession, path: str, model: inference.Model, tile: int, overlap: int, **options) -> DataFrame:
    """Detect in composites that are raster files of one grid; size and affine are what their headers say. Grids that differ, and files that can't be read, are an error."""
    files = rasters.raster_files(spark, path)
    broken = files.where("error IS NOT NULL").select("path", "error").head(3)
    if broken:
        raise ValueError(f"unreadable files: {[tuple(r) for r in broken]}")
    base = F.struct("affine.a", "affine.b", (F.col("affine.c") - F.col("affine.b") * F.col("row_off")).alias("c"), "affine.d", "affine.e", (F.col("affine.f") - F.col("affine.e") * F.col("row_off")).alias("f"))
    grids = files.groupBy("raster_id").agg(F.max(F.col("row_off") + F.col("height")).alias("height"), F.max("width").alias("width"), F.collect_set(base).alias("grids"))
    found = grids.select("height", "width", F.explode("grids").alias("affine")).distinct().head(2)
    if len(found) != 1:
        raise ValueError("the files are of no grid or of more than one")
    pixels = manifests.blocks_to_pixels(rasters.read_rasters(spark, path))
    return scan_and_detect(pixels, model, tile, overlap, found[0]["height"], found[0]["width"], affine=tuple(found[0]["affine"]), **options)


def area_number(name: str) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(1 << 31))


def detect_areas(composites: DataFrame, model: inference.Model, path: str, model_version: str, tile: int, overlap: int, height: int, width: int, **options) -> DataFrame:
    """Detect in the composites of all areas at once, store each area's detections under its name, and return the totals: ``aoi, detections``."""
    spark = composites.sparkSession
    found = scan_and_detect(composites, model, tile, overlap, height, width, **options)
    names = settle(composites.select("aoi", "raster_id").distinct(), "areas")
    sinks.store_detections(found.join(names, "raster_id"), path, model_version, areas=names)
    stored = spark.read.parquet(path).where(F.col("model_version") == model_version)
    return names.select("aoi").join(stored.groupBy("aoi").agg(F.count("*").alias("n")), "aoi", "left").select("aoi", F.coalesce("n", F.lit(0)).alias("detections"))


def weak_labels(composite_: DataFrame, sites: DataFrame, affine: tuple) -> DataFrame:
    """The composite's pixels with ``label``, burnt from the sites' buffers."""
    a, _, c, _, e, f = affine
    placed = composite_.withColumns({"x": F.lit(c) + (F.col("col") + 0.5) * a, "y": F.lit(f) + (F.col("row") + 0.5) * e})
    return joins.burn_labels(placed, sites, ["raster_id", "row", "col"], 512.0 * abs(a))


def label_and_train(composite_: DataFrame, sites: DataFrame, affine: tuple, steps: int = 25) -> inference.LinearModel:
    """Weak labels from the sites' buffers, burnt into a stretched composite, and a linear model fitted to them."""
    return train_model(weak_labels(composite_, sites, affine), steps=steps)


def label_and_train_network(composite_: DataFrame, sites: DataFrame, affine: tuple, tile: int, height: int, width: int, **options) -> tuple[convolution.ConvolutionalModel, DataFrame]:
    """The same labels, and a convolutional model trained on the composite's tiles, which don't overlap; with its history."""
    tiled = grid.to_tiles(weak_labels(composite_, sites, affine).withColumns(index_columns()), tile, 0, height, width)
    return convolution.fit_convolutional(tiled, tile, **options)


def site_buffers(spark: SparkSession, path: str, zone: int | None) -> DataFrame:
    """Known sites in the raster's units with their buffers: metres of a UTM zone, or degrees where no zone is given."""
    sites = manifests.read_sites(spark, path)
    if zone is None:
        return joins.buffer_boxes(sites.withColumns({"x": F.col("lon"), "y": F.col("lat")}), F.col("buffer_km") / 111.0)
    east, north = geo.utm("lon", "lat", zone)
    return joins.buffer_boxes(sites.withColumns({"x": east, "y": north}), F.col("buffer_km") * 1000.0)


def main(argv: list[str] | None = None) -> None:
    """``spark-submit`` entry: ``ingest``, ``train``, ``detect`` or ``full`` over Parquet tables."""
    parser = argparse.ArgumentParser(prog="rastra")
    parser.add_argument("command", choices=["ingest", "train", "detect", "full"])
    parser.add_argument("--looks", help="table of looks: raster_id, row, col, scl and bands")
    parser.add_argument("--sites", help="JSON manifest of known sites")
    parser.add_argument("--composite", help="table of the composite, written by ingest and read by train and detect")
    parser.add_argument("--chips", help="manifest of chips, written by ingest")
    parser.add_argument("--detections", help="table of detections, written by detect")
    parser.add_argument("--model", default="baseline", help="name of a model or the folder of a saved one; train writes the folder")
    parser.add_argument("--model-server", help="address of a model server that scores instead; MODEL_SERVER in the environment does as well")
    parser.add_argument("--raster-files", help="folder of composites as raster files, read by detect instead of the table; their headers give size and affine")
    parser.add_argument("--network", action="store_true", help="train a convolutional model on tiles instead of a linear one on pixels")
    parser.add_argument("--epochs", type=int, default=40, help="at most, of the convolutional model")
    parser.add_argument("--history", help="table of the convolutional model's epochs")
    parser.add_argument("--size", nargs=2, type=int, default=[0, 0], metavar=("HEIGHT", "WIDTH"), help="of the composite's table")
    parser.add_argument("--affine", nargs=6, type=float, default=[10.0, 0.0, 0.0, 0.0, -10.0, 0.0])
    parser.add_argument("--utm-zone", type=int, help="zone of a raster in metres, into which sites are projected; without it the raster is in degrees")
    parser.add_argument("--tile", type=int, default=256)
    parser.add_argument("--threshold", type=float, default=0.5)
    parser.add_argument("--no-cloud-mask", action="store_true")
    parser.add_argument("--no-outlines", action="store_true", help="store boxes and measures of detections without their outlines")
    parser.add_argument("--model-version", default="linear-1")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("rastra").getOrCreate()
    affine, (height, width) = tuple(args.affine), args.size
    if args.command in ("ingest", "full"):
        sites = site_buffers(spark, args.sites, args.utm_zone)
        made, chips = ingest_and_preprocess(spark.read.parquet(args.looks), sites, args.tile, min(32, args.tile // 8), height, width, affine, mask=not args.no_cloud_mask)
        sinks.write_table(made, args.composite)
        sinks.write_manifest(chips, args.chips)
    if args.command == "train" or args.command == "full" and args.model not in inference.MODELS:
        made, sites = spark.read.parquet(args.composite), site_buffers(spark, args.sites, args.utm_zone)
        if args.network:
            model, history = label_and_train_network(made, sites, affine, args.tile, height, width, epochs=args.epochs)
            if args.history:
                sinks.write_table(history, args.history)
        else:
            model = label_and_train(made, sites, affine)
        model.save(spark, args.model)
    if args.command in ("detect", "full"):
        model = serving.choose_model(spark, args.model, replace(Settings.load(), model_server=args.model_server) if args.model_server else Settings.load())
        if args.raster_files:
            found = detect_in_files(spark, args.raster_files, model, args.tile, args.tile // 4, threshold=args.threshold, outlines=not args.no_outlines)
        else:
            found = scan_and_detect(spark.read.parquet(args.composite), model, args.tile, args.tile // 4, height, width, args.threshold, affine=affine, outlines=not args.no_outlines)
        sinks.store_detections(found, args.detections, args.model_version)


if __name__ == "__main__":
    main()
