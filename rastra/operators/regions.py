"""Connected regions of rasters: labels, measures, outlines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from rastra.functions.algebra import at_least, compactness
from rastra.operators.graph import SMALL, connected_components
from rastra.storage import discard, settle


def label_regions(pixels: DataFrame, width: Column | int, cells: Column | int) -> DataFrame:
    """Adds ``component`` to the on-pixels (``raster_id, row, col``): the smallest pixel number of its 4-connected region.

    A pixel's number is ``raster_id * cells + row * width + col``, so labels
    follow raster-scan order. Pixels in a row are joined to runs first, and runs
    of neighbouring rows that overlap are the edges of a graph, so the graph is
    as small as the regions' outlines and no raster is held in one task.
    """
    width, cells = (F.lit(x) if isinstance(x, int) else x for x in (width, cells))
    line = Window.partitionBy("raster_id", "row").orderBy("col")
    begins = (F.col("col") - F.lag("col").over(line) == 1).cast("int")
    runs = pixels.withColumn("_new", 1 - F.coalesce(begins, F.lit(0))).withColumn("_run", F.sum("_new").over(line))
    number = F.col("raster_id") * cells + F.col("row") * width
    runs = settle(runs.withColumn("_id", (number + F.min("col").over(Window.partitionBy("raster_id", "row", "_run"))).cast("long")), "region_runs")
    spans = runs.groupBy("raster_id", "row", "_id").agg(F.min("col").alias("a"), F.max("col").alias("b"))
    below = spans.select(F.col("raster_id").alias("r2"), (F.col("row") - 1).alias("row2"), F.col("_id").alias("dst"), F.col("a").alias("a2"), F.col("b").alias("b2"))
    edges = spans.join(below, (F.col("raster_id") == F.col("r2")) & (F.col("row") == F.col("row2")) & (F.col("a") <= F.col("b2")) & (F.col("b") >= F.col("a2")))
    found = connected_components(edges.select(F.col("_id").alias("src"), "dst"), small=SMALL).select(F.col("id").alias("_cid"), F.col("component").alias("_comp"))
    return runs.join(found, F.col("_id") == F.col("_cid"), "left").withColumn("component", F.coalesce("_comp", "_id")).drop("_new", "_run", "_id", "_cid", "_comp")


def outline_edges(labelled: DataFrame) -> DataFrame:
    """Adds how many of a pixel's sides lie on its region's outline: ``level`` (top, bottom) and ``upright`` (left, right).

    Neighbouring on-pixels always share a region, so neighbours in the same row
    or column are all that has to be looked at; sides at holes count.
    """
    across, down = Window.partitionBy("raster_id", "row").orderBy("col"), Window.partitionBy("raster_id", "col").orderBy("row")

    def near(w, c: str) -> Column:
        prev = F.coalesce((F.col(c) - F.lag(c).over(w) == 1).cast("int"), F.lit(0))
        return prev + F.coalesce((F.lead(c).over(w) - F.col(c) == 1).cast("int"), F.lit(0))

    return labelled.withColumns({"upright": 2 - near(across, "col"), "level": 2 - near(down, "row")})


def region_features(labelled: DataFrame, value: str, affine: tuple = (1.0, 0.0, 0.0, 0.0, -1.0, 0.0), min_px: int = 1) -> DataFrame:
    """Measures of each region of at least ``min_px`` pixels, in world units.

    ``area_px, mean_value, area, perimeter`` (holes included), ``compactness``,
    ``centroid_x, centroid_y`` and the box. None of them needs the outline to be
    traced.
    """
    a, _, c, _, e, f = affine
    rows = outline_edges(labelled).groupBy("raster_id", "component").agg(
        F.count("*").alias("area_px"),
        F.avg(value).alias("mean_value"),
        (F.sum("level") * abs(a) + F.sum("upright") * abs(e)).alias("perimeter"),
        (F.lit(c) + a * (F.avg("col") + 0.5)).alias("centroid_x"),
        (F.lit(f) + e * (F.avg("row") + 0.5)).alias("centroid_y"),
        F.least(F.lit(c) + a * F.min("col"), F.lit(c) + a * (F.max("col") + 1)).alias("xmin"),
        F.least(F.lit(f) + e * F.min("row"), F.lit(f) + e * (F.max("row") + 1)).alias("ymin"),
        F.greatest(F.lit(c) + a * F.min("col"), F.lit(c) + a * (F.max("col") + 1)).alias("xmax"),
        F.greatest(F.lit(f) + e * F.min("row"), F.lit(f) + e * (F.max("row") + 1)).alias("ymax"),
    )
    rows = rows.where(F.col("area_px") >= min_px).withColumn("area", F.col("area_px") * abs(a * e))
    return rows.withColumn("compactness", compactness("area", "perimeter"))


def add_outlines(found: DataFrame, labelled: DataFrame, affine: tuple = (1.0, 0.0, 0.0, 0.0, -1.0, 0.0)) -> DataFrame:
    """Adds ``rings`` to regions (``raster_id, component``), traced from those pixels of ``labelled`` that are theirs.

    Pixels of other regions are left out before anything is traced: neighbours
    share a region, so what is left has the same outlines. A region without pixels has null.
    """
    keys = ["raster_id", "component"]
    own = labelled.select(*keys, "row", "col").join(found.select(*keys).distinct(), keys, "left_semi")
    return found.drop("rings").join(trace_outlines(own, affine), keys, "left")


def extract_regions(pixels: DataFrame, value: str, threshold: float, width: int, cells: int, min_px: int = 50, affine: tuple = (1.0, 0.0, 0.0, 0.0, -1.0, 0.0)) -> DataFrame:
    """Regions of pixels at or above the threshold, measured; NaN is never above."""
    on = pixels.where(at_least(value, threshold))
    return region_features(label_regions(on, width, cells), value, affine, min_px)


#: Steps of the directions east, south, west and north, each a right turn from the one before it, with rows downwards.
_STEPS = ((0, 1), (1, 0), (0, -1), (-1, 0))


def outline_corners(labelled: DataFrame) -> DataFrame:
    """The corners of all outlines, each with the one that comes next: ``raster_id, component, id, row, col, next``.

    Outlines run clockwise, the region on the right hand. At each corner of a pixel the
    sides that end there go on to those that begin there; where two regions or two parts of one touch
    by their corners the right turn is taken, which keeps regions 4-connected. A side that
    goes straight on is no corner; along a line the ends of straight runs and
    their beginnings take turns, so a corner's next one is the next end. ``id``
    is a number of place and direction: row by row, then by column.
    """
    across, down = Window.partitionBy("raster_id", "row").orderBy("col"), Window.partitionBy("raster_id", "col").orderBy("row")
    gap = lambda w, k, fn: F.coalesce(F.abs(fn(k).over(w) - F.col(k)) != 1, F.lit(True))
    sides = [(gap(down, "row", F.lag), 0, 0, 0), (gap(across, "col", F.lead), 0, 1, 1), (gap(down, "row", F.lead), 1, 1, 2), (gap(across, "col", F.lag), 1, 0, 3)]
    listed = F.array(*[F.when(on, F.struct(F.lit(r).alias("r"), F.lit(c).alias("c"), F.lit(d).alias("d"))) for on, r, c, d in sides])
    met = labelled.select("raster_id", "component", "row", "col", F.filter(listed, lambda x: x.isNotNull()).alias("sides")).select("raster_id", "component", "row", "col", F.explode("sides").alias("s"))
    step = lambda k: F.element_at(F.array(*[F.lit(x[k]) for x in _STEPS]), F.col("s.d") + 1)
    begin = F.struct((F.col("row") + F.col("s.r")).alias("row"), (F.col("col") + F.col("s.c")).alias("col"), F.lit(True).alias("out"))
    end = F.struct((F.col("row") + F.col("s.r") + step(0)).alias("row"), (F.col("col") + F.col("s.c") + step(1)).alias("col"), F.lit(False).alias("out"))
    places = met.select("raster_id", "component", F.col("s.d").alias("d"), F.explode(F.array(begin, end)).alias("at"))
    at = places.groupBy("raster_id", F.col("at.row").alias("row"), F.col("at.col").alias("col")).agg(
        F.collect_set(F.when(F.col("at.out"), F.col("d"))).alias("outs"), F.collect_list(F.when(~F.col("at.out"), F.struct("d", "component"))).alias("ins")
    )
    turned = lambda by: (F.col("in.d") + by) % 4
    out = F.when(F.array_contains("outs", turned(1)), turned(1)).when(F.array_contains("outs", F.col("in.d")), F.col("in.d")).otherwise(turned(3))
    corners = at.withColumn("in", F.explode("ins")).withColumn("d", out).where("d <> in.d")
    number = F.shiftleft(F.col("row").cast("long"), 33) + F.col("col") * 4 + F.col("d")
    corners = corners.select("raster_id", F.col("in.component").alias("component"), number.alias("id"), "row", "col", F.col("in.d").alias("before"), "d")
    along = lambda d: F.when(d == 0, F.col("col")).when(d == 1, F.col("row")).when(d == 2, -F.col("col")).otherwise(-F.col("row"))
    event = lambda d, begins: F.struct(d.alias("d"), F.when(d % 2 == 0, F.col("row")).otherwise(F.col("col")).alias("line"), along(d).alias("pos"), F.lit(begins).alias("begins"))
    events = corners.withColumn("e", F.explode(F.array(event(F.col("before"), False), event(F.col("d"), True))))
    line = Window.partitionBy("raster_id", "e.d", "e.line").orderBy("e.pos", "e.begins")
    return events.withColumn("next", F.lead("id").over(line)).where("e.begins").select("raster_id", "component", "id", "row", "col", "next")


#: Most corners of a raster whose rings are ranked in one task, with others of that size.
_RANKED = 1 << 16


def _rank_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corners in order of raster and id, with ``ring`` and ``nth``; a raster that isn't complete yet waits for the next batch."""

    def ranked(rows: pa.RecordBatch, begins: np.ndarray) -> pa.RecordBatch:
        ids, nexts = (rows[c].to_numpy() for c in ("id", "next"))
        raster = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(ids))))
        order = np.lexsort((nexts, raster))
        if not (nexts[order] == ids).all():
            raise ValueError("corners must make closed rings")
        jump, least, off, span = np.empty(len(ids), np.int64), np.arange(len(ids)), np.zeros(len(ids), np.int64), 1
        jump[order] = np.arange(len(ids))
        while (less := least[jump] < least).any():
            off = np.where(less, off[jump] + span, off)
            least, jump, span = np.minimum(least, least[jump]), jump[jump], 2 * span
        size = np.bincount(least)[least]
        return rows.append_column("ring", pa.array(ids[least], pa.int64())).append_column("nth", pa.array((size - off) % size, pa.int64()))

    held = None
    for batch in batches:
        if batch.num_rows:
            held = pa.concat_batches([held, batch]) if held is not None else batch
            of = held["raster_id"]
            begins = np.append(0, 1 + np.flatnonzero(pc.not_equal(of[1:], of[:-1]).to_numpy(zero_copy_only=False)))
            if len(begins) > 1:
                yield ranked(held.slice(0, begins[-1]), begins[:-1])
                held = held.slice(begins[-1])
    if held is not None:
        yield ranked(held, np.zeros(1, int))


def rank_rings(corners: DataFrame, small: int = _RANKED) -> DataFrame:
    """``corners`` (``raster_id, id, next`` and others) with ``ring``, the smallest id of the ring, and ``nth``, the place in it from there, from 0.

    By pointer doubling: after each round a corner knows the smallest id among twice as many
    that follow it, and how far that is; when a round changes none of them all rings are closed. A ring
    of n corners takes about log2(n) rounds, each a join that no ring is a key of. Rasters of at most ``small``
    corners take their rounds within a task. ``corners`` should be settled, as they are read twice.
    """
    sizes = corners.groupBy("raster_id").agg(F.count("*").alias("_n"))
    large = settle(sizes.where(F.col("_n") > small).select("raster_id"), "ring_rasters")
    none = large.isEmpty()
    whole = (corners if none else corners.join(large, "raster_id", "left_anti")).where(F.col("raster_id").isNotNull())
    schema = StructType([*whole.schema.fields, StructField("ring", LongType()), StructField("nth", LongType())])
    found = whole.repartition("raster_id").sortWithinPartitions("raster_id", "id").mapInArrow(_rank_whole, schema)
    return found if none else found.unionByName(_rank_in_rounds(corners.join(large, "raster_id", "left_semi")))


def _rank_in_rounds(corners: DataFrame) -> DataFrame:
    state = settle(corners.select("raster_id", "id", F.col("next").alias("jump"), F.col("id").alias("least"), F.lit(0).cast("long").alias("off")), "ring_ranks")
    span = 1
    while True:
        far = state.select(F.col("raster_id").alias("_r"), F.col("id").alias("_i"), F.col("jump").alias("_jump"), F.col("least").alias("_least"), F.col("off").alias("_off"))
        met = state.join(far, (F.col("raster_id") == F.col("_r")) & (F.col("jump") == F.col("_i")))
        less = F.col("_least") < F.col("least")
        doubled = met.select("raster_id", "id", F.col("_jump").alias("jump"), F.least("least", "_least").alias("least"), F.when(less, F.col("_off") + span).otherwise(F.col("off")).alias("off"), less.alias("less"))
        before, state, span = state, settle(doubled, "ring_ranks"), 2 * span
        discard(before)
        if state.where("less").isEmpty():
            break
    sizes = state.groupBy("raster_id", F.col("least").alias("ring")).agg(F.max("off").alias("most"))
    ranked = state.join(sizes.withColumnRenamed("raster_id", "_r"), (F.col("raster_id") == F.col("_r")) & (F.col("least") == F.col("ring")))
    nth = F.when(F.col("off") == 0, F.lit(0)).otherwise(F.col("most") + 1 - F.col("off"))
    return corners.join(ranked.select("raster_id", "id", "ring", nth.cast("long").alias("nth")), ["raster_id", "id"])


def trace_outlines(labelled: DataFrame, affine: tuple = (1.0, 0.0, 0.0, 0.0, -1.0, 0.0)) -> DataFrame:
    """Rings of each region in world units: ``raster_id, component, rings``; the outer ring first, holes after it.

    Corners are linked and ranked without any region in one task; only the
    finished polygon is one value, so its corners have to fit a row. Larger ones are ordered rows of ``rank_rings``.
    """
    a, _, c, _, e, f = affine
    ranked = rank_rings(settle(outline_corners(labelled), "outline_corners"))
    point = F.struct((F.lit(float(c)) + F.col("col") * a).alias("x"), (F.lit(float(f)) + F.col("row") * e).alias("y"))
    rings = ranked.groupBy("raster_id", "component", "ring").agg(F.array_sort(F.collect_list(F.struct("nth", point.alias("p")))).alias("corners"))
    points = F.transform("corners", lambda x: x["p"])
    closed = rings.select("raster_id", "component", "ring", F.concat(points, F.slice(points, 1, 1)).alias("points"))
    whole = closed.groupBy("raster_id", "component").agg(F.array_sort(F.collect_list(F.struct("ring", "points"))).alias("rings"))
    return whole.select("raster_id", "component", F.transform("rings", lambda x: x["points"]).alias("rings"))
