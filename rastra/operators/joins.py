"""Spatial joins as equi-joins on grid cells, refined by the exact predicate."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastra.functions.geo import box_distance2, distance2


def _cell(x: Column, size: float) -> Column:
    return F.floor(x / F.lit(size)).cast("long")


def _cells(lo: Column, hi: Column, size: float) -> Column:
    return F.sequence(_cell(lo, size), _cell(hi, size))


def packed(df: DataFrame, name: str) -> Column:
    return F.struct(*[df[f"`{c}`"] for c in df.columns]).alias(name)


def point_pairs(left: DataFrame, right: DataFrame, reach: float, how: str = "inner", xy=("x", "y"), strict: bool = True) -> DataFrame:
    """Join points on planar distance below ``reach`` (or at most, if not ``strict``).

    ``how`` is inner, left_semi or left_anti. Columns of the two sides are the
    structs ``l`` and ``r`` of an inner join, or those of ``left``. The grid's
    cells are as wide as the reach; right points are dealt to their cell and its
    eight neighbours, so that a left point meets each right point once.
    """
    x, y = xy
    around = F.array(*[F.lit(d) for d in (-1, 0, 1)])
    ours = left.select(packed(left, "l")).withColumns({"cx": _cell(F.col(f"l.{x}"), reach), "cy": _cell(F.col(f"l.{y}"), reach)})
    theirs = right.select(packed(right, "r"))
    theirs = theirs.withColumn("dx", F.explode(around)).withColumn("dy", F.explode(around))
    theirs = theirs.select("r", (_cell(F.col(f"r.{x}"), reach) + F.col("dx")).alias("kx"), (_cell(F.col(f"r.{y}"), reach) + F.col("dy")).alias("ky"))
    d2, limit = distance2(f"l.{x}", f"l.{y}", f"r.{x}", f"r.{y}"), F.lit(float(reach) * float(reach))
    near = (F.col("cx") == F.col("kx")) & (F.col("cy") == F.col("ky")) & ((d2 < limit) if strict else (d2 <= limit))
    joined = ours.join(theirs, near, how)
    return joined.select("l", "r") if how == "inner" else joined.select(*[F.col(f"l.`{c}`").alias(c) for c in left.columns])


_BOX = ("xmin", "ymin", "xmax", "ymax")


#: A class of boxes is so many times as wide as the one below it; the finest is this many classes below ``size``.
_CLASS, _FINEST = 4, 12


def box_pairs(left: DataFrame, right: DataFrame, size: float, extra: Column | None = None) -> DataFrame:
    """Pairs of boxes that share a point, as structs ``l`` and ``r``.

    Boxes fall into classes of size, four times as wide each; a class has a grid
    whose cells are as wide as its largest boxes. A pair meets on the grid of
    the larger of the two, in the cell that holds the lower corner of its
    intersection. So a box of any size touches four cells a class at most, and the cells of a crowd
    of small boxes are small. Boxes are dealt to those coarser grids alone whose class the other side has. ``size`` is the width
    that counts as one, about that of a usual box. Both tables are read once before, for the classes that they have. Boxes with a null or undefined side meet nothing.
    """
    sides = ("xmin", "ymin", "xmax", "ymax")

    def classed(df: DataFrame, name: str) -> DataFrame:
        """Rows as a struct with their class and, beside it, the sides: to explode by fields of a struct trips the optimizer."""
        flat = df.select(packed(df, name), *[df[c].alias(f"{name}_{c}") for c in sides])
        whole = [F.col(f"{name}_{c}").isNotNull() & ~F.isnan(F.col(f"{name}_{c}").cast("double")) for c in sides]
        wide = F.greatest(F.col(f"{name}_xmax") - F.col(f"{name}_xmin"), F.col(f"{name}_ymax") - F.col(f"{name}_ymin")).cast("double")
        step = F.ceil(F.log(wide / F.lit(float(size))) / math.log(_CLASS))
        kept = flat.where(whole[0] & whole[1] & whole[2] & whole[3])
        return kept.withColumn(f"{name}c", F.when(wide > 0, F.greatest(step, F.lit(-_FINEST))).otherwise(F.lit(-_FINEST)).cast("int"))

    def classes(df: DataFrame, name: str) -> list[int]:
        """The few classes that there are: sizes span 4^12 and what a double holds above ``size``."""
        return sorted(r[0] for r in df.select(f"{name}c").distinct().collect())

    def dealt(df: DataFrame, name: str, other: list[int]) -> DataFrame:
        """A row for each class from the own one up that decides a pair, and each of its cells that the box touches."""
        own, theirs = F.col(f"{name}c"), F.array(*[F.lit(c) for c in other]).cast("array<int>")
        coarser = F.filter(theirs, lambda c: c > own)
        met = F.when(own >= min(other, default=0), F.concat(F.array(own), coarser)).otherwise(coarser)
        d = df.withColumn(f"{name}k", F.explode(met)).withColumn("_width", F.pow(F.lit(float(_CLASS)), F.col(f"{name}k")) * float(size))
        d = d.withColumn(f"{name}x", F.explode(_touched(f"{name}_xmin", f"{name}_xmax")))
        return d.withColumn(f"{name}y", F.explode(_touched(f"{name}_ymin", f"{name}_ymax"))).withColumnRenamed("_width", f"{name}_width")

    ours, theirs = classed(left, "l"), classed(right, "r")
    found = classes(ours, "l")
    a, b = dealt(ours, "l", found if left is right else classes(theirs, "r")), dealt(theirs, "r", found)
    meet = (
        (F.col("l_xmin") <= F.col("r_xmax")) & (F.col("l_xmax") >= F.col("r_xmin"))
        & (F.col("l_ymin") <= F.col("r_ymax")) & (F.col("l_ymax") >= F.col("r_ymin"))
    )
    once = (F.col("lx") == _of(F.greatest("l_xmin", "r_xmin"), F.col("l_width"))) & (F.col("ly") == _of(F.greatest("l_ymin", "r_ymin"), F.col("l_width")))
    larger = F.col("lk") == F.greatest("lc", "rc")
    cell = (F.col("lk") == F.col("rk")) & (F.col("lx") == F.col("rx")) & (F.col("ly") == F.col("ry")) & larger & meet
    return a.join(b, (cell & once) if extra is None else cell & extra & once).select("l", "r")


def _of(x: Column, width: Column) -> Column:
    return F.floor(x / width).cast("long")


def _touched(lo: str, hi: str) -> Column:
    return F.sequence(_of(F.col(lo), F.col("_width")), _of(F.col(hi), F.col("_width")))


def buffer_boxes(sites: DataFrame, radius: Column, x: str = "x", y: str = "y") -> DataFrame:
    """Sites with the box of their buffer and its radius ``r``."""
    s = sites.withColumn("r", radius)
    return s.withColumns({"xmin": F.col(x) - F.col("r"), "ymin": F.col(y) - F.col("r"), "xmax": F.col(x) + F.col("r"), "ymax": F.col(y) + F.col("r")})


def flag_positive(chips: DataFrame, sites: DataFrame, key: str, size: float, x: str = "x", y: str = "y") -> DataFrame:
    """Chips (boxes) with ``is_positive``: whether any site's buffer (``r`` and its box) reaches the chip."""
    apart = box_distance2(f"r.{x}", f"r.{y}", "l.xmin", "l.ymin", "l.xmax", "l.ymax")
    touched = box_pairs(chips, sites, size, apart <= F.col("r.r") * F.col("r.r")).select(F.col(f"l.{key}").alias("_hit")).distinct()
    return chips.join(touched, F.col(key) == F.col("_hit"), "left").withColumn("is_positive", F.col("_hit").isNotNull()).drop("_hit")


def burn_labels(pixels: DataFrame, sites: DataFrame, keys: list[str], size: float, polygon: bool = False) -> DataFrame:
    """Pixel centres (``x, y``) with ``label`` 1.0 inside any site's buffer and 0.0 outside.

    The buffer is a circle, or the polygon of 64 sides inscribed in it.
    """
    from rastra.functions.geo import in_buffer

    a = pixels.select(packed(pixels, "l")).withColumns({"lx": _cell(F.col("l.x"), size), "ly": _cell(F.col("l.y"), size)})
    b = sites.select(packed(sites, "r"))
    b = b.withColumn("rx", F.explode(_cells(F.col("r.xmin"), F.col("r.xmax"), size))).withColumn("ry", F.explode(_cells(F.col("r.ymin"), F.col("r.ymax"), size)))
    dx, dy = F.col("l.x") - F.col("r.x"), F.col("l.y") - F.col("r.y")
    inside = in_buffer(dx, dy, F.col("r.r")) if polygon else dx * dx + dy * dy <= F.col("r.r") * F.col("r.r")
    hit = a.join(b, (F.col("lx") == F.col("rx")) & (F.col("ly") == F.col("ry")) & inside, "left_semi")
    burnt = hit.select(*[F.col(f"l.{k}").alias(k) for k in keys]).distinct().withColumn("_hit", F.lit(1.0))
    return pixels.join(burnt, keys, "left").withColumn("label", F.coalesce("_hit", F.lit(0.0))).drop("_hit")
