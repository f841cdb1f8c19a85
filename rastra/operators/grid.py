"""Tile grids: windows, chips, overlap averaging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def offsets(n: Column | int, tile: int, step: int) -> Column:
    """``0, step, ..`` of the whole tiles along an edge of ``n`` pixels; empty if none fits."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.when(n >= tile, F.sequence(F.lit(0), (n - tile).cast("int"), F.lit(step))).otherwise(F.array().cast("array<int>"))


def tile_windows(rasters: DataFrame, tile: int, overlap: int) -> DataFrame:
    """Windows of each raster (``raster_id, height, width``) row by row; partial tiles at the far edges are left out."""
    step = tile - overlap
    rows = rasters.withColumn("row_off", F.explode(offsets(F.col("height"), tile, step)))
    return rows.withColumn("col_off", F.explode(offsets(F.col("width"), tile, step))).select("raster_id", "row_off", "col_off")


def covering(at: Column, n: Column | int, tile: int, step: int) -> Column:
    """Offsets of the tiles that hold position ``at``."""
    n = F.lit(n) if isinstance(n, int) else n
    first = F.greatest(F.lit(0), F.ceil((at - tile + 1) / F.lit(step)).cast("int"))
    last = F.least(F.floor(at / F.lit(step)).cast("int"), F.floor((n - tile) / F.lit(step)).cast("int"))
    return F.when(last >= first, F.transform(F.sequence(first, last), lambda k: k * step)).otherwise(F.array().cast("array<int>"))


def to_tiles(pixels: DataFrame, tile: int, overlap: int, height: Column | int, width: Column | int) -> DataFrame:
    """A row for each pixel and tile that holds it, with ``row_off, col_off``; no join is made."""
    step = tile - overlap
    rows = pixels.withColumn("row_off", F.explode(covering(F.col("row"), height, tile, step)))
    return rows.withColumn("col_off", F.explode(covering(F.col("col"), width, tile, step)))


def tile_id(col_off="col_off", row_off="row_off") -> Column:
    return F.format_string("tile_%d_%d", F.col(col_off), F.col(row_off))


def chip_raster(pixels: DataFrame, tile: int, overlap: int, height: int, width: int, min_valid: float = 0.5, affine: tuple = (1.0, 0.0, 0.0, 0.0, -1.0, 0.0)) -> DataFrame:
    """Chips whose share of nonzero first-band pixels reaches ``min_valid``: id, offsets, share and world box.

    A NaN counts as valid, a null doesn't.
    """
    a, _, c, _, e, f = affine
    found = to_tiles(pixels, tile, overlap, height, width).groupBy("raster_id", "row_off", "col_off").agg(
        (F.count_if(F.col("blue") != 0) / F.lit(float(tile * tile))).alias("valid")
    )
    x0, y0 = F.lit(c) + F.col("col_off") * a, F.lit(f) + F.col("row_off") * e
    x1, y1 = x0 + tile * a, y0 + tile * e
    return found.where(F.col("valid") >= min_valid).select(
        "raster_id", tile_id().alias("tile_id"), "row_off", "col_off", "valid",
        F.least(x0, x1).alias("xmin"), F.least(y0, y1).alias("ymin"), F.greatest(x0, x1).alias("xmax"), F.greatest(y0, y1).alias("ymax"),
    )


def overlap_average(tiled: DataFrame, value: str = "prob") -> DataFrame:
    """Mean over all tiles that hold a pixel."""
    return tiled.groupBy("raster_id", "row", "col").agg(F.avg(value).alias(value))


def fill_uncovered(pixels: DataFrame, averaged: DataFrame, value: str = "prob") -> DataFrame:
    """Pixels that no tile holds get 0."""
    keys = ["raster_id", "row", "col"]
    return pixels.select(*keys).join(averaged, keys, "left").withColumn(value, F.coalesce(value, F.lit(0.0)))


def augment(chips: DataFrame, edge: int, key: str = "raster_id", turns: Column | None = None, flip_h: Column | None = None, flip_v: Column | None = None) -> DataFrame:
    """Quarter turns and flips of square chips by remapping pixels; image and mask columns move together.

    What is done to a chip follows from a hash of its key, unless given.
    """
    h = F.pmod(F.xxhash64(F.lit(22), F.col(key)), F.lit(16))
    turns = (h % 4) if turns is None else turns
    flip_h = (F.floor(h / 4) % 2 == 1) if flip_h is None else flip_h
    flip_v = (h >= 8) if flip_v is None else flip_v
    last, r, c = F.lit(edge - 1), F.col("row"), F.col("col")
    # counter-clockwise: (r, c) goes to (last - c, r)
    tr = F.when(turns == 0, r).when(turns == 1, last - c).when(turns == 2, last - r).otherwise(c)
    tc = F.when(turns == 0, c).when(turns == 1, r).when(turns == 2, last - c).otherwise(last - r)
    fc = F.when(flip_h, last - tc).otherwise(tc)
    fr = F.when(flip_v, last - tr).otherwise(tr)
    return chips.withColumns({"row": fr.cast("int"), "col": fc.cast("int")})


def batches(windows: DataFrame, size: int) -> DataFrame:
    """Numbers each raster's windows in grid order and puts ``size`` of them in a batch; the last may be short."""
    from pyspark.sql.window import Window

    nth = F.row_number().over(Window.partitionBy("raster_id").orderBy("row_off", "col_off")) - 1
    return windows.withColumn("batch", F.floor(nth / F.lit(size)).cast("long"))
