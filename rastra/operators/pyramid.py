"""Tile pyramids: detections dealt to the map tiles of several zooms at once."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastra.functions.algebra import col


def tile_pyramid(detections: DataFrame, low: int, high: int, min_score: float = 0.1, per_side: int = 64, extent: int = 4096, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Features of all map tiles of zooms ``low`` to ``high``: ``z, x, y, id, score, px, py, n``.

    A tile has ``per_side`` x ``per_side`` cells, and a cell shows one feature:
    its best detection (the smaller id of equals), where it lies, and how many
    detections the cell has in ``n``. So a tile has a bounded number of
    features whatever lies in it, the ``n`` of a zoom add up to all detections
    on the map, and nearer zooms show more of them apart. A cell of a zoom is
    four of the next one: the detections are counted once, in the cells of
    ``high``, and only those cells are dealt to the zooms above.

    A null score counts as 0, a score that is no number is never the best. Detections below ``min_score``, and those
    without a place on the mercator map (null, or beyond its edges), are in no tile. An empty table has no tiles.
    """
    if not 0 <= low <= high <= 24:
        raise ValueError("zooms must lie in 0..24, low before high")
    if per_side < 1 or extent % per_side or per_side & (per_side - 1):
        raise ValueError("per_side must be a power of two that divides extent")
    tiles = float(1 << high)
    fx = (col(lon) + 180.0) / 360.0 * tiles
    turn = F.ln(F.tan((col(lat) + 90.0) * (math.pi / 360.0))) / math.pi
    fy = (F.lit(1.0) - turn) / 2.0 * tiles
    score = F.coalesce("score", F.lit(0.0))
    placed = detections.where(score >= min_score).select("id", score.alias("score"), fx.alias("fx"), fy.alias("fy"))
    placed = placed.where((F.col("fx") >= 0) & (F.col("fx") < tiles) & (F.col("fy") >= 0) & (F.col("fy") < tiles))
    cell = lambda v: F.floor(F.col(v) * per_side).cast("long")
    rank = F.when(F.isnan("score"), F.lit(math.inf)).otherwise(-F.col("score"))
    shown = F.struct(rank.alias("rank"), "id", "score", "fx", "fy")
    base = placed.groupBy(cell("fx").alias("gx"), cell("fy").alias("gy")).agg(F.count("*").alias("n"), F.min(shown).alias("best"))
    dealt = base.select("gx", "gy", "n", "best", F.explode(F.sequence(F.lit(0), F.lit(high - low))).alias("up"))
    shift = lambda v: F.floor(F.col(v) / F.pow(F.lit(2.0), "up")).cast("long")
    merged = dealt.groupBy("up", shift("gx").alias("gx"), shift("gy").alias("gy")).agg(F.sum("n").alias("n"), F.min("best").alias("best"))
    inside = lambda v, tile: F.floor((F.col(f"best.{v}") / F.pow(F.lit(2.0), "up") - F.col(tile)) * extent).cast("int")
    tiled = merged.withColumns({"z": F.lit(high) - F.col("up"), "x": F.floor(F.col("gx") / per_side).cast("long"), "y": F.floor(F.col("gy") / per_side).cast("long")})
    return tiled.select("z", "x", "y", "best.id", "best.score", inside("fx", "x").alias("px"), inside("fy", "y").alias("py"), "n")
