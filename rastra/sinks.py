"""Sinks: partitioned tables, GeoJSON lines, manifests, vector tiles, PNG."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastra.functions.algebra import BANDS
from rastra.functions.geo import tile_lonlat_bounds, tile_position
from rastra.operators.grid import tile_id, to_tiles
from rastra.sources import rasters
from rastra.sources.manifests import pixels_to_blocks
from rastra.storage import settle


def write_scenes(pixels: DataFrame, path: str) -> None:
    """Stacked scenes, partitioned so that a scene is a folder of its own."""
    pixels.repartition("aoi", "scene_id").write.mode("overwrite").partitionBy("aoi", "scene_id").parquet(path, compression="zstd")


def write_table(df: DataFrame, path: str, *partitions: str, mode: str = "overwrite") -> None:
    """A composite, chip, probability or metrics table."""
    df.write.mode(mode).partitionBy(*partitions).parquet(path, compression="zstd")


def missing_scenes(wanted: DataFrame, catalog: DataFrame, key: str = "scene_id") -> DataFrame:
    """Scenes that the catalogue doesn't hold yet."""
    return wanted.join(catalog.select(key), key, "left_anti")


def write_manifest(chips: DataFrame, path: str) -> None:
    """Chips as JSON lines, spread over as many files as the table has parts."""
    chips.write.mode("overwrite").json(path)


def write_chips(pixels: DataFrame, chips: DataFrame, path: str, tile: int, overlap: int, height: int, width: int, affine: tuple, crs: int | None = None, bands: tuple[str, ...] = BANDS, **options) -> DataFrame:
    """The pixels of each chip (``raster_id, row_off, col_off``) as a raster file of its own; returns ``chips`` with ``chip``, the number of its raster in the folder ``path``.

    A chip's place is in its affine. ``tile`` must be a multiple of 16. Chips of windows that have no pixels get no file, and missing pixels of others are NaN.
    """
    a, b, c, d, e, f = affine
    cells = height * width
    number = F.col("raster_id") * cells + F.col("row_off") * width + F.col("col_off")
    wanted = chips.select("raster_id", "row_off", "col_off").distinct()
    own = to_tiles(pixels.select("raster_id", "row", "col", *bands), tile, overlap, height, width).join(wanted, ["raster_id", "row_off", "col_off"], "left_semi")
    local = own.select(number.alias("raster_id"), (F.col("row") - F.col("row_off")).alias("row"), (F.col("col") - F.col("col_off")).alias("col"), *bands)
    y, x = F.floor(F.pmod("raster_id", F.lit(cells)) / F.lit(width)), F.pmod("raster_id", F.lit(width))
    moved = {"a": F.lit(float(a)), "b": F.lit(float(b)), "c": c + a * x + b * y, "d": F.lit(float(d)), "e": F.lit(float(e)), "f": f + d * x + e * y}
    placed = pixels_to_blocks(rasters.filled(local, tile, bands), tile, bands, affine, crs).withColumn("affine", F.struct(*[v.cast("double").alias(n) for n, v in moved.items()]))
    rasters.write_rasters(placed, path, edge=tile, strip_rows=tile, **options)
    return chips.withColumn("chip", number)


def label_arrays(labels: DataFrame, tile: int, overlap: int, height: int, width: int, label: str = "label") -> DataFrame:
    """One row a tile with its labels row by row in an array: ``raster_id, tile_id, row_off, col_off, labels``; a tile's size bounds its row."""
    cells = to_tiles(labels, tile, overlap, height, width).groupBy("raster_id", "row_off", "col_off").agg(F.array_sort(F.collect_list(F.struct("row", "col", label))).alias("cells"))
    return cells.select("raster_id", tile_id().alias("tile_id"), "row_off", "col_off", F.col(f"cells.{label}").alias("labels"))


def store_detections(detections: DataFrame, path: str, model_version: str, aoi: str | None = None, areas: DataFrame | None = None) -> None:
    """Write detections of one model by their column ``aoi``, or as one area's; a rerun replaces an area's instead of doubling them. A missing score is 0.

    ``areas`` (a column ``aoi``) are the areas of the run: those without any
    detection lose what an earlier run has stored for this model. Without it, they are
    the one area given, or those that have detections.
    """
    spark = detections.sparkSession
    area = F.col("aoi") if aoi is None and "aoi" in detections.columns else F.lit(aoi or "all")
    rows = detections.withColumns({"score": F.coalesce("score", F.lit(0.0)), "model_version": F.lit(model_version), "aoi": area})
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("aoi", "model_version").parquet(path)
    if areas is None and aoi is None and "aoi" in detections.columns:
        return
    named = spark.createDataFrame([(aoi or "all",)], "aoi string") if areas is None else areas.select(F.col("aoi").cast("string")).distinct()
    held = settle(rows.select("aoi").distinct(), "stored_areas")
    empty = named.join(held, named["aoi"].eqNullSafe(held["aoi"]), "left_anti")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for (name,) in empty.toLocalIterator():  # a name an area of the configuration
        escaped = "__HIVE_DEFAULT_PARTITION__" if name is None else spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(name)
        version = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(model_version)
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(folder, f"aoi={escaped}/model_version={version}"), True)


def write_geojson(features: DataFrame, path: str) -> None:
    features.select("feature").write.mode("overwrite").text(path)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, body: bytes | int) -> bytes:
    if isinstance(body, int):
        return _varint(number << 3) + _varint(body)
    return _varint(number << 3 | 2) + _varint(len(body)) + body


def clip_ring(ring: list[tuple[float, float]], low: float, high: float) -> list[tuple[float, float]]:
    """The part of a closed ring (its last point is not repeated) inside a square, edge by edge."""
    for axis, limit, keep in ((0, low, 1), (0, high, -1), (1, low, 1), (1, high, -1)):
        out = []
        for p, q in zip(ring[-1:] + ring[:-1], ring, strict=True):
            p_in, q_in = (p[axis] - limit) * keep >= 0, (q[axis] - limit) * keep >= 0
            if p_in != q_in:
                t = (limit - p[axis]) / (q[axis] - p[axis])
                out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
            if q_in:
                out.append(q)
        ring = out
    return ring


def _shape(rings: list | None, x: int, y: int, low: int, high: int) -> tuple[int, list[int]]:
    """Kind and commands of a point, or of a polygon that is clipped and put on whole positions; a polygon outside has none."""
    zigzag = lambda n: (n << 1) ^ (n >> 63)
    if rings is None:
        return 1, [9, zigzag(x), zigzag(y)]
    commands, at = [], (0, 0)
    for nth, ring in enumerate(rings):
        points = [(float(p["x"]), float(p["y"])) for p in ring]
        clipped = [(round(u), round(v)) for u, v in clip_ring(points[:-1] if points[0] == points[-1] else points, low, high)]
        clipped = [p for k, p in enumerate(clipped) if p != clipped[k - 1]]
        area = sum(u[0] * v[1] - v[0] * u[1] for u, v in zip(clipped, clipped[1:] + clipped[:1], strict=True))
        if not area:
            if nth == 0:
                return 3, []
            continue
        if (area > 0) != (nth == 0):  # the outer ring turns one way, holes the other
            clipped.reverse()
        for k, p in enumerate(clipped):
            commands += ([9] if k == 0 else [(len(clipped) - 1) << 3 | 2] if k == 1 else []) + [zigzag(p[0] - at[0]), zigzag(p[1] - at[1])]
            at = p
        commands.append(15)
    return 3, commands


def _value(v) -> bytes:
    if isinstance(v, str):
        return _field(1, v.encode())
    if isinstance(v, (bool, np.bool_)):
        return _field(7, int(v))
    if isinstance(v, (int, np.integer)):
        return _field(6, (int(v) << 1) ^ (int(v) >> 63))
    return _varint(3 << 3 | 1) + struct.pack("<d", float(v))


def encode_tile(rows: pd.DataFrame, layer: str = "detections", extent: int = 4096, buffer: int = 256, hidden: tuple[str, ...] = ()) -> bytes:
    """A vector tile with one layer, of points ``px, py`` or polygons ``rings`` in the tile's positions.

    Polygons are clipped to the tile and a margin of ``buffer``; those outside
    are left out. ``id`` is the features' number and all other columns but the
    ``hidden`` ones are properties, unless null.
    """
    names = [c for c in rows.columns if c not in ("id", "px", "py", "rings", *hidden)]
    values: dict[bytes, int] = {}
    features = b""
    for r in rows.to_dict("records"):
        rings = r.get("rings")
        kind, commands = _shape(rings, int(r.get("px", 0)), int(r.get("py", 0)), -buffer, extent + buffer)
        if not commands:
            continue
        tags = b"".join(_varint(k) + _varint(values.setdefault(_value(r[n]), len(values))) for k, n in enumerate(names) if r[n] is not None and r[n] == r[n])
        shape = b"".join(_varint(v) for v in commands)
        features += _field(2, _field(1, int(r["id"])) + _field(2, tags) + _field(3, kind) + _field(4, shape))
    keys = b"".join(_field(3, n.encode()) for n in names)
    return _field(3, _field(1, layer.encode()) + features + keys + b"".join(_field(4, v) for v in values) + _field(5, extent) + _field(15, 2))


def tile_polygons(detections: DataFrame, z: int, x: int, y: int, min_score: float = 0.1, extent: int = 4096) -> DataFrame:
    """Detections whose box meets a map tile, with their ``rings`` (of longitude and latitude) in the tile's positions, and all other columns but the box."""
    west, south, east, north = tile_lonlat_bounds(z, x, y)
    box = ("xmin", "ymin", "xmax", "ymax")
    near = detections.where((F.col("xmin") <= east) & (F.col("xmax") >= west) & (F.col("ymin") <= north) & (F.col("ymax") >= south) & (F.col("score") >= min_score))

    def place(p):
        px, py = tile_position(p["x"], p["y"], z, x, y, extent)
        return F.struct(px.alias("x"), py.alias("y"))

    return near.withColumn("rings", F.transform("rings", lambda ring: F.transform(ring, place))).drop(*box)


def vector_tiles(features: DataFrame, keys: list[str]) -> DataFrame:
    """One tile's bytes for each key; features of a tile should be limited before, as for any map."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({**{k: [pdf[k].iloc[0]] for k in keys}, "tile": [encode_tile(pdf.sort_values("id"), hidden=tuple(keys))]})

    fields = ", ".join(f"{k} {features.schema[k].dataType.simpleString()}" for k in keys)
    return features.groupBy(*keys).applyInPandas(one, f"{fields}, tile binary")


def encode_png(width: int, height: int, rgb: bytes) -> bytes:
    """An 8-bit RGB PNG."""
    part = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    lines = b"".join(b"\0" + rgb[3 * width * y : 3 * width * (y + 1)] for y in range(height))
    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(lines)) + part(b"IEND", b"")


def thumbnails_to_png(pixels: DataFrame, height: int, width: int) -> DataFrame:
    """PNG bytes of each raster's thumbnail (``raster_id, row, col, r, g, b``), whose size is bounded."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        body = bytearray(3 * width * height)
        for r in pdf.itertuples(index=False):
            at = 3 * (int(r.row) * width + int(r.col))
            body[at : at + 3] = bytes(min(255, max(0, int(v))) for v in (r.r, r.g, r.b))
        return pd.DataFrame({"raster_id": [pdf.raster_id.iloc[0]], "png": [encode_png(width, height, bytes(body))]})

    return pixels.groupBy("raster_id").applyInPandas(one, "raster_id long, png binary")
