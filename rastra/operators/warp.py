"""Rasters moved from one grid to another, between reference systems as well."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastra.functions import geo
from rastra.functions.algebra import BANDS


@dataclass(frozen=True)
class Grid:
    """An affine ``(a, b, c, d, e, f)`` from column and row to x and y, a size, and the EPSG number of its system.

    Known systems are longitude and latitude (4326), web mercator (3857) and
    the zones of UTM (32601 to 32660, 32701 to 32760); grids without a number
    are on one plane with each other.
    """

    affine: tuple[float, float, float, float, float, float]
    height: int
    width: int
    crs: int | None = None

    def __post_init__(self):
        a, b, _, d, e, _ = self.affine
        if a * e == b * d:
            raise ValueError("the affine has no inverse")
        if self.height < 1 or self.width < 1:
            raise ValueError("a grid has at least one pixel")

    def world(self, row: Column, col: Column) -> tuple[Column, Column]:
        """Centre of a pixel."""
        a, b, c, d, e, f = self.affine
        x, y = col + 0.5, row + 0.5
        return x * a + y * b + F.lit(float(c)), x * d + y * e + F.lit(float(f))

    def position(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Row and column at which a place lies, whole numbers at the centres of pixels."""
        a, b, c, d, e, f = self.affine
        det, dx, dy = a * e - b * d, x - F.lit(float(c)), y - F.lit(float(f))
        return (dy * a - dx * d) / F.lit(float(det)) - 0.5, (dx * e - dy * b) / F.lit(float(det)) - 0.5


def _zone(crs: int) -> tuple[int, bool] | None:
    return (crs % 100, crs // 100 == 327) if crs // 100 in (326, 327) and 1 <= crs % 100 <= 60 else None


def lonlat(x: Column, y: Column, crs: int) -> tuple[Column, Column]:
    if crs == 4326:
        return x, y
    if crs == 3857:
        return geo.mercator_lonlat(x, y)
    if _zone(crs):
        return geo.utm_lonlat(x, y, *_zone(crs))
    raise ValueError(f"unknown system: {crs}")


def from_lonlat(lon: Column, lat: Column, crs: int) -> tuple[Column, Column]:
    if crs == 4326:
        return lon, lat
    if crs == 3857:
        return geo.mercator_x(lon), geo.mercator_y(lat)
    if _zone(crs):
        return geo.utm(lon, lat, *_zone(crs))
    raise ValueError(f"unknown system: {crs}")


def _asks(cells: DataFrame, source: Grid, target: Grid, method: str) -> DataFrame:
    """Target pixels (``row, col`` and others) with ``at_row, at_col``, where they lie in the source, and ``asks``, the source pixels ``r, c`` that count there with their weights ``w``."""
    if method not in ("bilinear", "nearest"):
        raise ValueError(f"no such method: {method}")
    if (source.crs is None) != (target.crs is None):
        raise ValueError("both grids must name their system, or neither")
    x, y = target.world(F.col("row"), F.col("col"))
    if source.crs != target.crs:
        x, y = from_lonlat(*lonlat(x, y, target.crs), source.crs)
    at_row, at_col = source.position(x, y)
    placed = cells.withColumns({"at_row": at_row, "at_col": at_col})
    if method == "nearest":
        return placed.withColumn("asks", F.array(F.struct(F.floor(F.col("at_row") + 0.5).alias("r"), F.floor(F.col("at_col") + 0.5).alias("c"), F.lit(1.0).alias("w"))))
    low_r, low_c = F.floor("at_row"), F.floor("at_col")
    weight = lambda at, low, d: 1.0 - F.abs(F.col(at) - low - d)
    four = F.array(*[F.struct((low_r + i).alias("r"), (low_c + j).alias("c"), (weight("at_row", low_r, i) * weight("at_col", low_c, j)).alias("w")) for i in (0, 1) for j in (0, 1)])
    return placed.withColumn("asks", F.filter(four, lambda k: k["w"] > 0))


def warp(pixels: DataFrame, source: Grid, target: Grid, bands: tuple[str, ...] = BANDS, method: str = "bilinear") -> DataFrame:
    """Every pixel of the target grid for each raster, ``raster_id, row, col`` and the bands.

    The centre of each target pixel is taken back to the source grid, whose
    nearest pixel or four surrounding ones (by their bilinear weights) it asks
    for by row and column: one join on equal keys, whatever the two systems
    are. Null and undefined values don't count, and the weights of the others
    make up for them; a pixel with none is null. Pixels beyond the source's size are
    ignored; an empty table has no rasters and gives no rows. A source pixel that comes twice counts twice.
    """
    cells = pixels.select("raster_id").distinct().withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(target.height - 1))))
    # rows are dealt before their pixels are made, so that no task makes a whole raster
    cells = cells.repartition("raster_id", "row").withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(target.width - 1))))
    asked = _asks(cells, source, target, method).withColumn("one", F.explode("asks")).select("*", F.col("one.r").alias("src_row"), F.col("one.c").alias("src_col"), F.col("one.w").alias("w"))
    value = lambda b: F.nanvl(F.col(b).cast("double"), F.lit(None).cast("double"))
    inside = F.col("row").between(0, source.height - 1) & F.col("col").between(0, source.width - 1)
    held = pixels.where(inside).select(F.col("raster_id"), F.col("row").cast("long").alias("src_row"), F.col("col").cast("long").alias("src_col"), *[value(b).alias(b) for b in bands])
    met = asked.select("raster_id", "row", "col", "src_row", "src_col", "w").join(held, ["raster_id", "src_row", "src_col"], "left")
    sums = [F.try_divide(F.sum(F.col("w") * F.col(b)), F.sum(F.when(F.col(b).isNotNull(), F.col("w")))).alias(b) for b in bands]
    return met.groupBy("raster_id", "row", "col").agg(*sums)


def warp_blocks(blocks: DataFrame, source: Grid, target: Grid, bands: tuple[str, ...] = BANDS, method: str = "bilinear", edge: int = 256, out_edge: int = 128) -> DataFrame:
    """As ``warp``, from blocks of pixels (``raster_id, row_off, col_off, h, w, bands``) of ``edge`` x ``edge`` that are never unpacked.

    The target is dealt in squares of ``out_edge``; each lists by block the places that its
    pixels ask for, mostly in one block a pixel, and square and block meet in one join on the block, so
    a block is moved as an array and a task holds one block and one
    square's list. Pixels at which several blocks meet are added up after that.
    Blocks that don't lie on the grid of ``edge`` are an error. Values are those that blocks hold, 32 bits each.
    """
    last = lambda n: F.lit((n - 1) // out_edge)
    squares = blocks.select("raster_id").distinct().withColumn("t_row", F.explode(F.sequence(F.lit(0), last(target.height)))).withColumn("t_col", F.explode(F.sequence(F.lit(0), last(target.width))))
    span = lambda t, n: F.explode(F.sequence(F.col(t) * out_edge, F.least(F.lit(n - 1), F.col(t) * out_edge + out_edge - 1)))
    cells = squares.repartition("raster_id", "t_row", "t_col").withColumn("row", span("t_row", target.height)).withColumn("col", span("t_col", target.width))
    inside = F.filter("asks", lambda k: (k["r"] >= 0) & (k["r"] < source.height) & (k["c"] >= 0) & (k["c"] < source.width))
    met_blocks = F.array_distinct(F.transform(inside, lambda k: F.struct(F.floor(k["r"] / edge).cast("int").alias("r"), F.floor(k["c"] / edge).cast("int").alias("c"))))
    place = (F.col("row") - F.col("t_row") * out_edge) * out_edge + F.col("col") - F.col("t_col") * out_edge
    listed = _asks(cells, source, target, method).select("raster_id", "t_row", "t_col", place.cast("int").alias("place"), "at_row", "at_col", F.explode_outer(met_blocks).alias("block"))
    asked = listed.groupBy("raster_id", "t_row", "t_col", F.col("block.r").alias("s_row"), F.col("block.c").alias("s_col")).agg(
        F.collect_list("place").alias("places"), F.collect_list("at_row").alias("rows"), F.collect_list("at_col").alias("cols")
    )
    held = blocks.select("raster_id", F.floor(F.col("row_off") / edge).cast("int").alias("s_row"), F.floor(F.col("col_off") / edge).cast("int").alias("s_col"), "row_off", "col_off", F.col("h").alias("b_h"), F.col("w").alias("b_w"), "bands")
    met = asked.join(held, ["raster_id", "s_row", "s_col"], "left")
    sums, parts = [f"_s{k}" for k in range(len(bands))], [f"_w{k}" for k in range(len(bands))]

    def add(group: pd.DataFrame) -> pd.DataFrame:
        found = []
        for g in group.itertuples(index=False):
            at, n = np.asarray(g.places), out_edge * out_edge
            seen = np.unique(at)
            made = {"row": g.t_row * out_edge + seen // out_edge, "col": g.t_col * out_edge + seen % out_edge}
            if g.bands is None:
                made |= dict.fromkeys(sums + parts, 0.0)
            else:
                if g.row_off % edge or g.col_off % edge or g.b_h > edge or g.b_w > edge:
                    raise ValueError(f"the block at {(g.row_off, g.col_off)} is not on the grid of {edge}")
                at_row, at_col = np.asarray(g.rows), np.asarray(g.cols)
                low_r, low_c = (np.floor(v + 0.5 if method == "nearest" else v) for v in (at_row, at_col))
                made |= dict.fromkeys(sums + parts, np.zeros(len(seen)))
                for i, j in ((0, 0),) if method == "nearest" else ((0, 0), (0, 1), (1, 0), (1, 1)):
                    r, c = low_r + i, low_c + j
                    w = np.ones(len(at)) if method == "nearest" else (1.0 - np.abs(at_row - low_r - i)) * (1.0 - np.abs(at_col - low_c - j))
                    own = (w > 0) & (r >= 0) & (r < source.height) & (c >= 0) & (c < source.width)
                    own &= (r >= g.row_off) & (r < g.row_off + g.b_h) & (c >= g.col_off) & (c < g.col_off + g.b_w)
                    number = ((r[own] - g.row_off) * g.b_w + c[own] - g.col_off).astype(np.int64)
                    for k, (total, part) in enumerate(zip(sums, parts)):
                        value = np.asarray(g.bands[k], dtype=np.float64)[number]
                        known = ~np.isnan(value)
                        made[total] = made[total] + np.bincount(at[own][known], w[own][known] * value[known], n)[seen]
                        made[part] = made[part] + np.bincount(at[own][known], w[own][known], n)[seen]
            found.append(pd.DataFrame(made).assign(raster_id=g.raster_id))
        return pd.concat(found)[["raster_id", "row", "col", *sums, *parts]]

    kind = f"raster_id {blocks.schema['raster_id'].dataType.simpleString()}, row int, col int, " + ", ".join(f"{c} double" for c in sums + parts)
    added = met.groupBy("raster_id", "s_row", "s_col", "t_row", "t_col").applyInPandas(add, kind)
    return added.groupBy("raster_id", "row", "col").agg(*[F.try_divide(F.sum(s), F.sum(w)).alias(b) for b, s, w in zip(bands, sums, parts)])
