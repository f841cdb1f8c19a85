"""Registered queries: each applies the library's operators to whole derived tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rastra import sinks
from rastra.functions import algebra, geo
from rastra.functions.algebra import BANDS
from rastra.operators import catalog, composite, convolution, dedupe, evaluate, grid, inference, joins, layout, polygons, pyramid, regions, warp
from rastra.plans import pipelines
from rastra.sources import fixtures, manifests, rasters
from rastra.sources.fixtures import EDGE
from rastra.storage import scratch, settle

#: Tiling of the 64 x 64 raster.
TILE, OVERLAP = 16, 4
#: Box, score floor and page of the catalogue queries, in hundredths of a degree.
BOX, MIN_SCORE = (-2000, 0, 3000, 4000), 0.5
EPS_C, IOU = 2, 0.3


def _r(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _points(d: DataFrame) -> DataFrame:
    return d.withColumns({"x": F.col("lon_c"), "y": F.col("lat_c")})


def spectral_indices(s: SparkSession, d: str) -> DataFrame:
    looks = fixtures.observations(s, d).selectExpr("row", "col", "t", *BANDS)
    rows = algebra.add_indices(looks).groupBy("row", "col").agg(*[F.sum(i).alias(i) for i in algebra.INDICES])
    return _r(rows, *algebra.INDICES)


def cloud_mask(s: SparkSession, d: str) -> DataFrame:
    masked = algebra.mask_clouds(fixtures.observations(s, d))
    return masked.groupBy("scl").agg(F.count("*").alias("n"), F.sum("blue").alias("blue"), F.sum("nir").alias("nir"))


def temporal_median(s: SparkSession, d: str) -> DataFrame:
    return composite.temporal_composite(fixtures.observations(s, d))


def temporal_mean(s: SparkSession, d: str) -> DataFrame:
    return _r(composite.temporal_composite(fixtures.observations(s, d), "mean"), *BANDS)


def masked_median(s: SparkSession, d: str) -> DataFrame:
    looks = algebra.mask_clouds(fixtures.observations(s, d), fill=None)
    return composite.temporal_composite(looks).select("row", "col", "red", "nir")


def percentile_stretch(s: SparkSession, d: str) -> DataFrame:
    return _r(composite.percentile_stretch(temporal_median(s, d)), *BANDS)


def tile_grid(s: SparkSession, d: str) -> DataFrame:
    rasters = fixtures.read(s, d, "supplier").selectExpr("s_suppkey AS raster_id", "200 + s_suppkey * 37 % 900 AS height", "200 + s_suppkey * 53 % 900 AS width")
    windows = grid.tile_windows(rasters, 256, 64).groupBy("raster_id").agg(F.count("*").alias("n"), F.max("row_off").alias("last_row"), F.max("col_off").alias("last_col"))
    return rasters.join(windows, "raster_id", "left").select(
        "raster_id", F.coalesce("n", F.lit(0)).alias("tiles"), algebra.tile_count(F.col("height"), F.col("width"), 256, 64).alias("formula"), "last_row", "last_col"
    )


def tile_batches(s: SparkSession, d: str) -> DataFrame:
    rasters = fixtures.read(s, d, "supplier").selectExpr("s_suppkey AS raster_id", "200 + s_suppkey * 37 % 900 AS height", "200 + s_suppkey * 53 % 900 AS width")
    return grid.batches(grid.tile_windows(rasters, 256, 64), 8).groupBy("raster_id", "batch").agg(F.count("*").alias("tiles"))


def chip_valid(s: SparkSession, d: str) -> DataFrame:
    pixels = temporal_median(s, d).withColumn("blue", F.when(F.expr("(row * 7 + col * 11) % 3 = 0 OR row > 40"), 0.0).otherwise(F.col("blue")))
    return grid.chip_raster(pixels, TILE, OVERLAP, EDGE, EDGE, 0.5, (10.0, 0.0, 500.0, 0.0, -10.0, 9000.0))


def overlap_average(s: SparkSession, d: str) -> DataFrame:
    pixels = temporal_median(s, d).select("raster_id", "row", "col", "nir")
    tiled = grid.to_tiles(pixels, TILE, OVERLAP, EDGE, EDGE).withColumn("prob", F.col("nir") * (1 + F.col("row_off") + 2 * F.col("col_off")) / 1000.0)
    return _r(grid.fill_uncovered(pixels, grid.overlap_average(tiled)), "prob")


def sigmoid_threshold(s: SparkSession, d: str) -> DataFrame:
    x = fixtures.read(s, d, "events").selectExpr("event_id", "(event_id * 37 % 2000 - 1000) / 250.0D AS logit")
    p = x.withColumn("prob", algebra.sigmoid("logit"))
    return _r(p.where(algebra.at_least("prob", 0.7)), "prob").select("event_id", "prob")


def site_buffer_semi(s: SparkSession, d: str) -> DataFrame:
    chips = fixtures.detections(s, d).select("id", "xmin", "ymin", "xmax", "ymax")
    sites = joins.buffer_boxes(_points(fixtures.known_sites(s, d)), F.col("buffer_km") * 20)
    return joins.flag_positive(chips, sites, "id", 200.0).select("id", "is_positive")


def rasterize_labels(s: SparkSession, d: str) -> DataFrame:
    pixels = temporal_median(s, d).select("row", "col").withColumns({"x": F.col("col") * 2 + 1, "y": F.col("row") * 2 + 1})
    sites = joins.buffer_boxes(fixtures.known_sites(s, d).selectExpr("site_id * 37 % 128 AS x", "site_id * 53 % 128 AS y", "buffer_km"), F.col("buffer_km"))
    return joins.burn_labels(pixels, sites, ["row", "col"], 10.0).select("row", "col", "label")


def recall_at_k(s: SparkSession, d: str) -> DataFrame:
    found = evaluate.recall_at_k(_points(fixtures.detections(s, d)), _points(fixtures.known_sites(s, d)), 2000, evaluate.reach(222.0, 100))
    return _r(found, "recall")


def fp_rate(s: SparkSession, d: str) -> DataFrame:
    return _r(evaluate.false_alarms(_points(fixtures.detections(s, d)), _points(fixtures.known_sites(s, d)), 1234000.0, 500), "per_1000_km2")


def calibration(s: SparkSession, d: str) -> DataFrame:
    found = evaluate.calibration(_points(fixtures.detections(s, d)), _points(fixtures.known_sites(s, d)), 500)
    return _r(found, "lo", "hi", "accuracy", "confidence")


def _logits(s: SparkSession, d: str) -> DataFrame:
    return fixtures.read(s, d, "events").selectExpr("event_id", "event_type", "(event_id * 37 % 2000 - 1000) / 250.0D AS logit", "CASE WHEN event_id * 13 % 7 < 3 THEN 1.0D ELSE 0.0D END AS target")


def segmentation_loss(s: SparkSession, d: str) -> DataFrame:
    return _r(evaluate.losses(_logits(s, d), group=["event_type"]), "focal", "dice", "combined")


def prf1(s: SparkSession, d: str) -> DataFrame:
    return _r(evaluate.precision_recall(_logits(s, d), group=["event_type"]), "precision", "recall", "f1")


def auroc(s: SparkSession, d: str) -> DataFrame:
    return _r(evaluate.auroc(_logits(s, d), F.col("logit")), "auroc")


def latency_percentiles(s: SparkSession, d: str) -> DataFrame:
    return _r(evaluate.latency_percentiles(fixtures.read(s, d, "events"), "value", ["event_type"]), "p50", "p95", "p99")


def composite_score(s: SparkSession, d: str) -> DataFrame:
    rows = fixtures.detections(s, d).selectExpr("id", "score", "area_c / 100.0D AS area", "2 * half_c / 10.0D AS w", "(half_c + 3) / 10.0D AS h")
    compact = algebra.compactness(F.col("w") * F.col("h"), 2 * (F.col("w") + F.col("h")))
    rows = rows.withColumn("compactness", compact).withColumn("area_score", algebra.area_score("area"))
    return _r(rows.withColumn("final", algebra.composite_score("score", "compactness", "area")), "compactness", "area_score", "final").select("id", "compactness", "area_score", "final")


def components_8x8(s: SparkSession, d: str) -> DataFrame:
    on = fixtures.chips(s, d).where(algebra.at_least("value", 0.1))
    found = regions.label_regions(on, 8, 64).groupBy("raster_id", "component").agg(F.count("*").alias("area_px"), F.avg("value").alias("mean_value"))
    return _r(found, "mean_value")


def region_features(s: SparkSession, d: str) -> DataFrame:
    on = fixtures.chips(s, d).where(algebra.at_least("value", 0.1))
    found = regions.region_features(regions.label_regions(on, 8, 64), "value", (10.0, 0.0, 100.0, 0.0, -20.0, 900.0), 3)
    return _r(found, "mean_value", "compactness", "centroid_x", "centroid_y")


def region_outlines(s: SparkSession, d: str) -> DataFrame:
    on = fixtures.chips(s, d).where(algebra.at_least("value", 0.1))
    rings = regions.trace_outlines(regions.label_regions(on, 8, 64))
    return rings.select("raster_id", "component", geo.polygon_feature("rings", component=F.col("component")).alias("feature"))


def outline_measures(s: SparkSession, d: str) -> DataFrame:
    """Rings, corners, area and length of each region's outline, from the traced rings."""
    on = fixtures.chips(s, d).where(algebra.at_least("value", 0.1))
    rings = regions.trace_outlines(regions.label_regions(on, 8, 64))
    total = lambda ring, of: F.aggregate(F.zip_with(F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1), of), F.lit(0.0), lambda a, b: a + b)
    added = lambda part: F.aggregate(F.transform("rings", part), F.lit(0.0), lambda a, b: a + b)
    area = added(lambda ring: total(ring, lambda p, q: (q["x"] * p["y"] - p["x"] * q["y"]) / 2.0))
    length = added(lambda ring: total(ring, lambda p, q: F.abs(p["x"] - q["x"]) + F.abs(p["y"] - q["y"])))
    corners = F.aggregate(F.transform("rings", lambda ring: F.size(ring) - 1), F.lit(0), lambda a, b: a + b)
    return rings.select("raster_id", "component", F.size("rings").alias("rings"), corners.alias("corners"), area.alias("area"), length.alias("length"))


def rasterize_outlines(s: SparkSession, d: str) -> DataFrame:
    """The pixels inside each region's traced outline."""
    on = fixtures.chips(s, d).where(algebra.at_least("value", 0.1))
    rings = regions.trace_outlines(regions.label_regions(on, 8, 64), (10.0, 0.0, 100.0, 0.0, -20.0, 900.0))
    return polygons.rasterize_polygons(rings, ["raster_id", "component"], (10.0, 0.0, 100.0, 0.0, -20.0, 900.0), 8, 8)


def rasterize_parcels(s: SparkSession, d: str) -> DataFrame:
    """Parcels of any shape burnt into the grid of a raster."""
    parcels = fixtures.parcels(s, d)
    return polygons.burn_polygons(temporal_median(s, d).select("row", "col"), parcels, (1.0, 0.0, 0.0, 0.0, -1.0, 64.0), EDGE, EDGE)


def parcels_of_points(s: SparkSession, d: str) -> DataFrame:
    """Orders placed on the map of parcels, and the parcels that hold each."""
    spots = fixtures.read(s, d, "orders").selectExpr("o_orderkey AS point_id", "(o_orderkey * 37 % 6400) / 100.0D + 0.005D AS x", "(o_custkey * 53 % 6400) / 100.0D + 0.005D AS y")
    return polygons.points_in_polygons(spots, fixtures.parcels(s, d), 4.0, 8.0)


def box_overlay(s: SparkSession, d: str) -> DataFrame:
    """IoU of detections' boxes, taken as polygons."""
    ring = lambda *at: F.array(*[F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")) for x, y in at])
    boxes = fixtures.detections(s, d).select("id", F.array(ring(("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax"))).alias("rings"))
    over = polygons.polygon_overlay(boxes, boxes, 128.0, 100.0, extra=F.col("l.id") < F.col("r.id"))
    return _r(over, "iou").select("a", "b", "common", "area_a", "area_b", "iou")


def _outlines_of_two_runs(s: SparkSession, d: str) -> DataFrame:
    """Outlines of the regions of two thresholds, each raster's in a square of its own on one map."""
    parts = []
    for run, threshold in enumerate((0.05, 0.1)):
        on = regions.label_regions(fixtures.chips(s, d).where(algebra.at_least("value", threshold)), 8, 64)
        rings = regions.trace_outlines(on)
        moved = F.transform("rings", lambda ring: F.transform(ring, lambda p: F.struct((p["x"] + F.col("raster_id") % 64 * 10).alias("x"), (p["y"] + F.floor(F.col("raster_id") / 64) * 10).alias("y"))))
        rated = on.groupBy("component").agg(F.round(F.avg("value"), 6).alias("score"), F.count("*").alias("area_px"))
        parts.append(rings.withColumn("rings", moved).join(rated, "component").select((F.col("component") * 2 + run).alias("id"), "rings", "score", "area_px"))
    return settle(parts[0].unionByName(parts[1]), "outlines")


def outline_overlay(s: SparkSession, d: str) -> DataFrame:
    """IoU of the outlines of two thresholds, by their polygons."""
    outlines = _outlines_of_two_runs(s, d)
    over = polygons.polygon_overlay(outlines.where("id % 2 = 0"), outlines.where("id % 2 = 1"), 1.0, 8.0)
    return _r(over, "iou").select("a", "b", "common", "area_a", "area_b", "iou")


def dedupe_polygons(s: SparkSession, d: str) -> DataFrame:
    """Regions of two thresholds without those whose polygon repeats a better one's."""
    return polygons.suppress_polygons(_outlines_of_two_runs(s, d), 0.5, 1.0, 8.0).select("id", "area_px", "score")


def parcel_distances(s: SparkSession, d: str) -> DataFrame:
    """Parcels at most three units apart."""
    parcels = fixtures.parcels(s, d)
    near = polygons.polygon_distances(parcels, parcels, 3.0, 4.0).where("a < b")
    return _r(near, "distance")


def dedupe_dbscan(s: SparkSession, d: str) -> DataFrame:
    clustered = dedupe.cluster(_points(fixtures.detections(s, d)).select("id", "x", "y", "score"), EPS_C)
    return dedupe.best_of_cluster(clustered).select("id", "score", "cluster")


def dedupe_nms(s: SparkSession, d: str) -> DataFrame:
    return dedupe.suppress(fixtures.detections(s, d).select("id", "score", "xmin", "ymin", "xmax", "ymax"), IOU, 110.0)


def dedupe_regions(s: SparkSession, d: str) -> DataFrame:
    """Regions of two thresholds over the same rasters; repeats are told by the pixels that they share."""
    parts = []
    for run, threshold in enumerate((0.05, 0.1)):
        on = regions.label_regions(fixtures.chips(s, d).where(algebra.at_least("value", threshold)), 8, 64)
        parts.append(on.select((F.col("component") * 2 + run).alias("id"), "raster_id", "row", "col", "value"))
    cells = parts[0].unionByName(parts[1])
    rated = cells.groupBy("id").agg(F.count("*").alias("area_px"), F.round(F.avg("value"), 6).alias("score"))
    return dedupe.suppress_regions(rated, cells, 0.5)


def stratified_split(s: SparkSession, d: str) -> DataFrame:
    chips = fixtures.detections(s, d).selectExpr("id", "id * 7919 % 1048573 AS shuffle", "id % 11 = 0 AS is_positive")
    return dedupe.stratified_split(chips).select("id", "is_positive", "split")


def split_sizes(s: SparkSession, d: str) -> DataFrame:
    return stratified_split(s, d).groupBy("split", "is_positive").count().withColumnRenamed("count", "n")


def scene_search(s: SparkSession, d: str) -> DataFrame:
    found = catalog.search_scenes(fixtures.scenes(s, d), (-60, -40, 60, 40), "2024-01-05", "2024-01-25", 20.0, 50, include_radar=True)
    return found.select("scene_id", "sensor", "cloud_cover")


def aoi_scene_join(s: SparkSession, d: str) -> DataFrame:
    return catalog.scenes_of_aois(fixtures.aois(s, d), fixtures.scenes(s, d), "2024-01-05", "2024-01-25", 60.0, 5)


def detections_page(s: SparkSession, d: str) -> DataFrame:
    return catalog.detections_page(fixtures.detections(s, d), BOX, MIN_SCORE, 25, 3).select("id", "score", "area_c", "model_version")


def detections_count(s: SparkSession, d: str) -> DataFrame:
    return catalog.detections_count(fixtures.detections(s, d), BOX, MIN_SCORE)


def detection_by_id(s: SparkSession, d: str) -> DataFrame:
    one = catalog.detection_by_id(fixtures.detections(s, d), 97)
    return one.select("id", "score", "model_version", "centroid_lon", "centroid_lat", *[F.col("bbox")[i].alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))])


def tile_features(s: SparkSession, d: str) -> DataFrame:
    rows = fixtures.detections(s, d).selectExpr("id", "score", "lon_c / 100.0D AS lon", "lat_c / 100.0D AS lat")
    return catalog.tile_features(rows, 3, 4, 3)


def tile_pyramid(s: SparkSession, d: str) -> DataFrame:
    """All tiles of zooms 0 to 5: features shown, detections behind them, sums of positions, best score."""
    rows = fixtures.detections(s, d).selectExpr("id", "score", "lon_c / 100.0D AS lon", "lat_c / 100.0D AS lat")
    cells = pyramid.tile_pyramid(rows, 0, 5)
    return cells.groupBy("z", "x", "y").agg(F.count("*").alias("features"), F.sum("n").alias("detections"), F.sum("px").alias("px"), F.sum("py").alias("py"), F.sum("id").alias("ids"), F.max("score").alias("best"))


def detections_layout(s: SparkSession, d: str) -> DataFrame:
    """Detections laid out along a Hilbert curve, and those that meet a box read from there."""
    path, laid = scratch(s, "layout"), layout.Layout((-18000, -9000, 18000, 9000), unit=25.0)
    laid.write(fixtures.detections(s, d), path)
    return laid.read(s, path, BOX).where(F.col("score") >= MIN_SCORE).select("id", "score", "area_c", "model_version")


def marker_style(s: SparkSession, d: str) -> DataFrame:
    rows = fixtures.detections(s, d).select("id", algebra.marker_radius("score").alias("radius"), algebra.colour_class("score").alias("colour"))
    return _r(rows, "radius")


def marker_colour(s: SparkSession, d: str) -> DataFrame:
    return fixtures.detections(s, d).select("id", algebra.marker_colour("score").alias("colour"))


def radar_scene_join(s: SparkSession, d: str) -> DataFrame:
    return catalog.scenes_of_aois(fixtures.aois(s, d), fixtures.scenes(s, d), "2024-01-05", "2024-01-25", 60.0, 5, include_radar=True)


def label_arrays(s: SparkSession, d: str) -> DataFrame:
    tiles = sinks.label_arrays(rasterize_labels(s, d).withColumn("raster_id", F.lit(0)), TILE, OVERLAP, EDGE, EDGE)
    listed = F.concat_ws("", F.transform("labels", lambda x: x.cast("int").cast("string")))
    return tiles.select("tile_id", listed.alias("labels"))


def scene_crop(s: SparkSession, d: str) -> DataFrame:
    """The blue band at full and the red band at half resolution, cut to a box and stacked; green has no grid, so it fails."""
    looks = temporal_median(s, d)
    fine = looks.selectExpr("raster_id AS scene_id", "'blue' AS band", "row", "col", "blue AS value")
    coarse = looks.where("row % 2 = 0 AND col % 2 = 0").selectExpr("raster_id AS scene_id", "'red' AS band", "row DIV 2 AS row", "col DIV 2 AS col", "red AS value")
    grids = s.createDataFrame([(0, "blue", 10.0, 500.0, 9000.0, 64, 64), (0, "red", 20.0, 500.0, 9000.0, 32, 32)], "scene_id long, band string, size double, left double, top double, height int, width int")
    stacked, _ = manifests.crop_scenes(fine.unionByName(coarse), grids, (404.0, 8600.0, 731.0, 8921.0), ("blue", "green", "red"))
    return stacked.select("row", "col", "blue", "green", "red")


def raster_files(s: SparkSession, d: str) -> DataFrame:
    """The composite written as a tiled file and a window of it read back by the blocks that it meets."""
    path = scratch(s, "rasters")
    rasters.write_pixels(temporal_median(s, d), path, edge=16, affine=(10.0, 0.0, 500.0, 0.0, -10.0, 9000.0), crs=32632, striprows=32)
    return manifests.read_window(rasters.read_rasters(s, path), 0, 10, 21, 30, 17, edge=16)


def chip_files(s: SparkSession, d: str) -> DataFrame:
    """Chips with enough valid pixels as files of their own, measured as they are read back, and the corner that each file says it has."""
    path, affine = scratch(s, "chips"), (10.0, 0.0, 500.0, 0.0, -10.0, 9000.0)
    pixels = temporal_median(s, d)
    named = sinks.write_chips(pixels, grid.chip_raster(pixels, TILE, OVERLAP, EDGE, EDGE, 0.5, affine), path, TILE, OVERLAP, EDGE, EDGE, affine)
    blocks = rasters.read_rasters(s, path, bands="2,3").select("raster_id", "affine.c", "affine.f", *[F.aggregate(F.get("bands", F.lit(i)), F.lit(0.0), lambda a, b: a + b).alias(n) for i, n in enumerate(("red", "nir"))])
    met = named.select("tile_id", "chip").join(blocks, F.col("chip") == F.col("raster_id"))
    return met.select("tile_id", F.col("c").alias("left"), F.col("f").alias("top"), "red", "nir")


def warped_raster(s: SparkSession, d: str) -> DataFrame:
    """The composite on a coarser, shifted grid that reaches beyond it, by bilinear weights."""
    here, there = warp.Grid((1.0, 0.0, 0.0, 0.0, 1.0, 0.0), EDGE, EDGE), warp.Grid((1.5, 0.0, -2.25, 0.0, 1.5, 1.25), 46, 46)
    return _r(warp.warp(temporal_median(s, d), here, there, ("red", "nir")).select("row", "col", "red", "nir"), "red", "nir")


def warped_blocks(s: SparkSession, d: str) -> DataFrame:
    """The same from blocks that are not unpacked."""
    here, there = warp.Grid((1.0, 0.0, 0.0, 0.0, 1.0, 0.0), EDGE, EDGE), warp.Grid((1.5, 0.0, -2.25, 0.0, 1.5, 1.25), 46, 46)
    blocks = manifests.pixels_to_blocks(temporal_median(s, d), 16, ("red", "nir"))
    return _r(warp.warp_blocks(blocks, here, there, ("red", "nir"), edge=16, out_edge=16).select("row", "col", "red", "nir"), "red", "nir")


def evidence_rgb(s: SparkSession, d: str) -> DataFrame:
    small = manifests.resample_nearest(temporal_median(s, d).select("raster_id", "row", "col", "red", "green", "blue"), EDGE, EDGE, 20, 20)
    return composite.thumbnail(small).select("row", "col", "r", "g", "b")


def geojson_features(s: SparkSession, d: str) -> DataFrame:
    rows = catalog.filter_detections(fixtures.detections(s, d), BOX, MIN_SCORE)
    return catalog.geojson(rows, "lon_c", "lat_c", "id", "score_m", "model_version")


def health(s: SparkSession, d: str) -> DataFrame:
    return catalog.health(fixtures.detections(s, d))


def aoi_union(s: SparkSession, d: str) -> DataFrame:
    """The chips of three areas' rasters as one table, with the area of each; every supplier is a raster of one of the areas."""
    sized = fixtures.read(s, d, "supplier").selectExpr("s_suppkey AS raster_id", "s_nationkey % 3 AS area", "200 + s_suppkey * 37 % 900 AS height", "200 + s_suppkey * 53 % 900 AS width")
    parts = [grid.tile_windows(sized.where(F.col("area") == k), 256, 32).withColumn("aoi", F.lit(n)) for k, n in enumerate("abc")]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return whole.select("aoi", "raster_id", grid.tile_id().alias("tile_id"), "row_off", "col_off")


def early_stopping(s: SparkSession, d: str) -> DataFrame:
    epochs = fixtures.read(s, d, "events").groupBy(F.dayofmonth("ts").alias("epoch")).agg(F.round(F.avg("value"), 6).alias("loss"))
    return evaluate.early_stopping(epochs, patience=4, lr_patience=2).select("epoch", "loss", "best", "stale", "stop", "lr_scale", "kept")


def strip_height(s: SparkSession, d: str) -> DataFrame:
    rows = fixtures.read(s, d, "supplier").selectExpr("s_suppkey AS id", "1000 + s_suppkey * 997 AS width")
    return rows.select("id", algebra.strip_height(F.col("width"), 256, 64, 16, 512.0).alias("height"))


def augment(s: SparkSession, d: str) -> DataFrame:
    id_ = F.col("raster_id")
    turned = grid.augment(fixtures.chips(s, d), 8, turns=id_ % 4, flip_h=id_ % 3 == 0, flip_v=id_ % 5 == 0)
    return turned.select("raster_id", "row", "col", F.round("value", 6).alias("value"))


def sliding_window_inference(s: SparkSession, d: str) -> DataFrame:
    return _r(inference.sliding_window(temporal_median(s, d), inference.BASELINE, TILE, OVERLAP, EDGE, EDGE), "prob")


def convolutional_training(s: SparkSession, d: str) -> DataFrame:
    """Epochs of a convolutional model trained on the tiles of the composite, where bare ground that is no lone pixel is the target."""
    pixels = algebra.add_indices(temporal_median(s, d))
    box = Window.partitionBy("raster_id", F.floor(F.col("row") / 4), F.floor(F.col("col") / 4))
    marked = pixels.withColumn("label", (F.avg("bsi").over(box) > 0).cast("double"))
    tiled = grid.to_tiles(marked.withColumns({b: F.col(b) / 10000.0 for b in BANDS}), TILE, 0, EDGE, EDGE)
    _, history = convolution.fit_convolutional(tiled, TILE, epochs=4, batches=2, held_out=4)
    return _r(history, "train_loss", "val_loss", "precision", "recall", "f1")


def scan_and_detect(s: SparkSession, d: str) -> DataFrame:
    found = pipelines.scan_and_detect(temporal_median(s, d), inference.BASELINE, TILE, OVERLAP, EDGE, EDGE, threshold=0.62, min_px=3, affine=(500.0, 0.0, 0.0, 0.0, -500.0, 0.0), eps=1500.0)
    columns = ["component", "area_px", "score", "compactness", "centroid_x", "centroid_y"]
    return _r(found.select(*columns), "score", "compactness", "centroid_x", "centroid_y")


def detected_outlines(s: SparkSession, d: str) -> DataFrame:
    """The outlines of the detections that are left, as GeoJSON."""
    found = pipelines.scan_and_detect(
        temporal_median(s, d), inference.BASELINE, TILE, OVERLAP, EDGE, EDGE, threshold=0.62, min_px=3, affine=(500.0, 0.0, 0.0, 0.0, -500.0, 0.0), eps=1500.0, outlines=True
    )
    return found.select("component", geo.polygon_feature("rings", component=F.col("component"), area_px=F.col("area_px")).alias("feature"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [
        spectral_indices, cloud_mask, temporal_median, temporal_mean, masked_median, percentile_stretch, tile_grid, tile_batches, chip_valid,
        overlap_average, sigmoid_threshold, site_buffer_semi, rasterize_labels, recall_at_k, fp_rate, calibration, segmentation_loss, prf1, auroc,
        latency_percentiles, composite_score, components_8x8, region_features, region_outlines, outline_measures, rasterize_outlines, rasterize_parcels, parcels_of_points, box_overlay, outline_overlay, parcel_distances, dedupe_polygons, dedupe_dbscan, dedupe_nms, dedupe_regions, stratified_split, split_sizes,
        scene_search, aoi_scene_join, detections_page, detections_count, detection_by_id, tile_features, tile_pyramid, detections_layout, marker_style, marker_colour, radar_scene_join, label_arrays, scene_crop, warped_raster, warped_blocks, raster_files, chip_files, evidence_rgb, geojson_features,
        health, aoi_union, early_stopping, strip_height, augment, sliding_window_inference, convolutional_training, scan_and_detect, detected_outlines,
    ]
    return {f.__name__: f for f in named}
