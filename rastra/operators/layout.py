"""Tables of boxes laid out along a space-filling curve, so that a map box reads few row groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rastra.functions.geo import boxes_meet

_BOX = ("xmin", "ymin", "xmax", "ymax")
#: Classes of size; boxes of one are at most four times as wide as those of the one below, the last has no limit.
_CLASSES, _CLASS = 12, 4


def hilbert_key(x: Column, y: Column, order: int) -> Column:
    """Place of the cell ``(x, y)`` of a grid of 2^order cells a side along the Hilbert curve; no Python, and the expression doesn't grow with the order."""
    last = F.lit((1 << order) - 1).cast("long")

    def bit(v: Column, s: Column) -> Column:
        return F.pmod(F.call_function("shiftright", v, s), F.lit(2).cast("long"))

    def step(at: Column, s: Column) -> Column:
        rx, ry = bit(at["x"], s), bit(at["y"], s)
        flip = lambda v: F.when(rx == 1, last - v).otherwise(v)
        quarter = at["d"] * 4 + F.when(rx == 1, 3 - ry).otherwise(ry)
        return F.struct(F.when(ry == 0, flip(at["y"])).otherwise(at["x"]).alias("x"), F.when(ry == 0, flip(at["x"])).otherwise(at["y"]).alias("y"), quarter.alias("d"))

    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), F.lit(0).cast("long").alias("d"))
    return F.aggregate(F.sequence(F.lit(order - 1), F.lit(0), F.lit(-1)), start, step)["d"]


def hilbert_cell(x: int, y: int, order: int) -> int:
    """The same for one cell, on the driver."""
    last, d = (1 << order) - 1, 0
    for s in range(order - 1, -1, -1):
        rx, ry = x >> s & 1, y >> s & 1
        d = 4 * d + (3 - ry if rx else ry)
        if not ry:
            x, y = (last - y, last - x) if rx else (y, x)
    return d


def key_ranges(x0: int, y0: int, x1: int, y1: int, order: int, most: int) -> list[tuple[int, int]]:
    """Ranges of keys, at most ``most``, that hold all cells of a rectangle, both ends included; with few ranges they hold other cells as well."""
    whole: list[tuple[int, int]] = []
    open_ = [(0, 0)]

    def span(qx: int, qy: int, level: int) -> tuple[int, int]:
        cells = 2 * (order - level)
        first = hilbert_cell(qx, qy, level) << cells
        return first, first + (1 << cells) - 1

    def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        for a, b in sorted(ranges):
            if out and a <= out[-1][1] + 1:
                out[-1] = (out[-1][0], max(b, out[-1][1]))
            else:
                out.append((a, b))
        return out

    best = merged([span(0, 0, 0)])
    for level in range(order):
        side = 1 << (order - level - 1)
        nearer = []
        for qx, qy in ((2 * qx + dx, 2 * qy + dy) for qx, qy in open_ for dx in (0, 1) for dy in (0, 1)):
            left, top = qx * side, qy * side
            if left > x1 or top > y1 or left + side - 1 < x0 or top + side - 1 < y0:
                continue
            if x0 <= left and left + side - 1 <= x1 and y0 <= top and top + side - 1 <= y1:
                whole.append(span(qx, qy, level + 1))
            else:
                nearer.append((qx, qy))
        ranges = merged(whole + [span(qx, qy, level + 1) for qx, qy in nearer])
        if len(ranges) > most:
            break
        open_, best = nearer, ranges
        if not open_:
            break
    return best


class Layout:
    """Boxes on a map of the bounds ``(xmin, ymin, xmax, ymax)``, in order of their class of size and of their centre along the Hilbert curve.

    ``unit`` is the side up to which boxes are of the lowest class. ``place``
    is one number, class and curve together, so that a query of a box is a
    list of ranges of one column, which Parquet's row groups are skipped by.
    Boxes that lie beyond the bounds count as on their edge, boxes with a null or undefined side
    have no place and are found by no query. A column ``place`` of the table gives way.
    """

    def __init__(self, bounds: tuple[float, float, float, float], unit: float, order: int = 16):
        if not (bounds[0] < bounds[2] and bounds[1] < bounds[3] and unit > 0 and 1 <= order <= 28):
            raise ValueError("bounds must be a box, unit positive and order in 1..28")
        self.bounds, self.unit, self.order = tuple(float(b) for b in bounds), float(unit), order

    def _cell(self, v: float, axis: int) -> int:
        low, high = self.bounds[axis], self.bounds[axis + 2]
        return int(min(max((v - low) / (high - low), 0.0), 1.0) * ((1 << self.order) - 1))

    def place(self) -> Column:
        def cell(axis: int) -> Column:
            low, high = self.bounds[axis], self.bounds[axis + 2]
            centre = (F.col(_BOX[axis]).cast("double") + F.col(_BOX[axis + 2])) / 2.0
            return F.floor(F.least(F.greatest((centre - low) / (high - low), F.lit(0.0)), F.lit(1.0)) * ((1 << self.order) - 1)).cast("long")

        sides = [(F.col(_BOX[a + 2]) - F.col(_BOX[a])).cast("double") for a in (0, 1)]
        side = F.greatest(*sides)
        kind = reduce(lambda n, k: n + (side > F.lit(self.unit * _CLASS**k)).cast("long"), range(1, _CLASSES), (side > F.lit(self.unit)).cast("long"))
        usable = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in _BOX])
        return F.when(usable, kind * (1 << 2 * self.order) + hilbert_key(cell(0), cell(1), self.order))

    def write(self, boxes: DataFrame, path: str, files: int | None = None, row_group_bytes: int = 32 << 20) -> None:
        """Files of neighbouring boxes; those of one place are split between files by the hash of their box if they are many."""
        placed = boxes.withColumn("place", self.place())
        by = ["place", F.xxhash64(*_BOX)]
        dealt = placed.repartitionByRange(*([files] if files else []), *by)
        dealt.sortWithinPartitions("place").write.mode("overwrite").option("parquet.block.size", row_group_bytes).parquet(path)

    def ranges(self, box: tuple, most: int = 8) -> list[tuple[int, int]]:
        """The places at which a box that meets ``box`` can lie: for each class the cells of the box widened by half that class's largest side."""
        out = []
        for kind in range(_CLASSES + 1):
            first = kind << 2 * self.order
            if kind == _CLASSES:
                out.append((first, first + (1 << 2 * self.order) - 1))
                continue
            reach = self.unit * _CLASS**kind / 2 * (1 + 1e-9)
            x0, y0, x1, y1 = (self._cell(box[i] + (-reach if i < 2 else reach), i % 2) for i in range(4))
            # a cell more on each side covers what rounding moves
            top = (1 << self.order) - 1
            found = key_ranges(max(0, x0 - 1), max(0, y0 - 1), min(top, x1 + 1), min(top, y1 + 1), self.order, most)
            out += [(first + a, first + b) for a, b in found]
        return out

    def read(self, spark: SparkSession, path: str, box: tuple, most: int = 8) -> DataFrame:
        """The boxes that share a point with ``box``."""
        spans = [F.col("place").between(a, b) for a, b in self.ranges(box, most)]
        while len(spans) > 1:  # a balanced tree of conditions
            spans = [spans[i] | spans[i + 1] if i + 1 < len(spans) else spans[i] for i in range(0, len(spans), 2)]
        return spark.read.parquet(path).where(spans[0] & boxes_meet(_BOX, tuple(F.lit(v) for v in box)))
