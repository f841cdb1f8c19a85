"""Queries over scene and detection catalogues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rastra.functions.geo import boxes_meet, point_feature, tile_lonlat_bounds, tile_position
from rastra.operators.joins import box_pairs

_BOX = ("xmin", "ymin", "xmax", "ymax")


def _box(box: tuple) -> tuple:
    return tuple(F.lit(v) for v in box)


def search_scenes(scenes: DataFrame, box: tuple, start: str, end: str, max_cloud: float = 20.0, limit: int = 50, include_radar: bool = False) -> DataFrame:
    """Optical scenes that meet a box in a time range with less than ``max_cloud`` cloud, newest first; radar ones as well if asked."""
    near = boxes_meet(_BOX, _box(box)) & F.col("ts").between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))
    optical = scenes.where((F.col("sensor") == "sentinel-2") & near & (F.col("cloud_cover") < max_cloud)).orderBy(F.desc("ts"), "scene_id").limit(limit)
    if not include_radar:
        return optical
    radar = scenes.where((F.col("sensor") == "sentinel-1") & near).withColumn("cloud_cover", F.lit(None).cast(scenes.schema["cloud_cover"].dataType))
    return optical.unionByName(radar.orderBy(F.desc("ts"), "scene_id").limit(limit), allowMissingColumns=True)


def pick_assets(assets: Column | str, wanted: list[str]) -> Column:
    """The wanted assets that a scene has."""
    return F.map_filter(assets, lambda k, _: k.isin(*wanted))


def scenes_of_aois(aois: DataFrame, scenes: DataFrame, start: str, end: str, max_cloud: float, limit: int, size: float = 20.0, include_radar: bool = False) -> DataFrame:
    """The newest ``limit`` scenes of each area: ``name, scene_id, nth``; with radar also as many of that sensor, and its name."""
    clear = F.col("cloud_cover") < max_cloud
    usable = scenes.where(F.col("ts").between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))
    usable = usable.where(clear | (F.col("sensor") == "sentinel-1")) if include_radar else usable.where(clear)
    pairs = box_pairs(aois, usable, size).select("l.name", "r.scene_id", "r.sensor", "r.ts")
    keys = ["name", "sensor"] if include_radar else ["name"]
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("ts"), "scene_id"))
    return pairs.withColumn("nth", nth).where(F.col("nth") <= limit).select(*keys, "scene_id", "nth")


def filter_detections(detections: DataFrame, box: tuple, min_score: float) -> DataFrame:
    if not 0 <= min_score <= 1:
        raise ValueError("min_score must lie in 0..1")
    return detections.where(boxes_meet(_BOX, _box(box)) & (F.col("score") >= min_score))


def detections_page(detections: DataFrame, box: tuple, min_score: float = 0.3, limit: int = 100, offset: int = 0) -> DataFrame:
    """A page of the detections that meet a box, best first; ids settle ties."""
    if not 1 <= limit <= 1000 or offset < 0:
        raise ValueError("limit must lie in 1..1000 and offset from 0")
    return filter_detections(detections, box, min_score).orderBy(F.desc("score"), "id").offset(offset).limit(limit)


def detections_count(detections: DataFrame, box: tuple, min_score: float = 0.3) -> DataFrame:
    return filter_detections(detections, box, min_score).agg(F.count("*").alias("total"))


def detection_by_id(detections: DataFrame, key: int) -> DataFrame:
    """One row with centroid and box, or none."""
    found = detections.where(F.col("id") == key).limit(1)
    centre = lambda a, b: (F.col(a) + F.col(b)) / 2.0
    return found.select("id", "score", "model_version", centre("xmin", "xmax").alias("centroid_lon"), centre("ymin", "ymax").alias("centroid_lat"), F.array(*_BOX).alias("bbox"))


def tile_features(detections: DataFrame, z: int, x: int, y: int, min_score: float = 0.1, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Detections of a map tile with their integer position in it; the tile's bounds are constants, so no join is made."""
    west, south, east, north = tile_lonlat_bounds(z, x, y)
    inside = detections.where(F.col(lon).between(west, east) & F.col(lat).between(south, north) & (F.col("score") >= min_score))
    px, py = tile_position(lon, lat, z, x, y)
    return inside.select("id", "score", px.alias("px"), py.alias("py"))


def geojson(detections: DataFrame, lon: str, lat: str, *properties: str) -> DataFrame:
    """One GeoJSON feature a row, for sinks that write lines."""
    return detections.select("id", point_feature(lon, lat, **{p: F.col(p) for p in properties}).alias("feature"))


def feature_collection(features: DataFrame, most: int = 1000, offset: int = 0) -> DataFrame:
    """A FeatureCollection as one value, of a page of at most ``most`` features from ``offset``; an empty page gives an empty collection.

    One value can't hold any number of features; all of them as a file are what
    ``sinks.write_geojson`` writes.
    """
    page = features.orderBy("id").offset(offset).limit(most).agg(F.array_sort(F.collect_list(F.struct("id", "feature"))).alias("page"))
    listed = F.array_join(F.transform("page", lambda p: p["feature"]), ",")
    return page.select(F.concat(F.lit('{"type":"FeatureCollection","features":['), listed, F.lit("]}")).alias("collection"))


def health(detections: DataFrame, model_ready: bool | None = None) -> DataFrame:
    """One row: status, whether the model server is ready (null if there is none), detections stored."""
    status = "degraded" if model_ready is False else "ok"
    return detections.agg(F.count("*").alias("detections")).select(F.lit(status).alias("status"), F.lit(model_ready).cast("boolean").alias("model_ready"), "detections")
