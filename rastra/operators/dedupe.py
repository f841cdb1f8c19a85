"""Deduplication of detections: distance clusters and box suppression."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastra.functions.geo import box_iou
from rastra.operators.graph import SMALL, connected_components
from rastra.operators.joins import box_pairs
from rastra.storage import exchanged, settle


def cluster(points: DataFrame, eps: float, x: str = "x", y: str = "y", key: str = "id", by: str | None = None) -> DataFrame:
    """Adds ``cluster``: the smallest key of all points that chains of steps of at most ``eps`` reach.

    This is DBSCAN with one sample to a core, of each value of ``by`` apart if
    that is given. Points of one cell of width ``eps / sqrt 2`` are within
    ``eps`` of each other, so a cell is one node and heaps of points make no
    pairs; of two neighbouring cells only the points near the other cell are
    compared.
    """
    group = F.lit(0) if by is None else F.col(by)
    places = points.groupBy(group.alias("grp"), F.col(x).alias("px"), F.col(y).alias("py")).agg(F.min(key).alias("first"))
    side = eps / math.sqrt(2) if eps > 0 else 1.0
    at = {c: F.floor(F.col(p) / side).cast("long") for c, p in (("cx", "px"), ("cy", "py"))} if eps > 0 else {"cx": F.xxhash64("px", "py"), "cy": F.lit(0)}
    places = settle(places.withColumns(at), "cluster_places")
    cells = places.groupBy("grp", "cx", "cy").agg(F.min("first").alias("node"))
    named = settle(places.join(cells, ["grp", "cx", "cy"]), "cluster_cells")
    steps = [(dx, dy) for dx in range(3) for dy in range(-2, 3) if (dx, dy) > (0, 0) and (dx, abs(dy)) != (2, 2)] if eps > 0 else [(0, 0)]
    reach = F.lit(eps * eps * (1 + 1e-12))

    def gap(p: str, c: str, d: Column) -> Column:
        """How far a place is from its neighbouring cell, along one axis."""
        low = (F.col(c) + d) * side
        return F.greatest(low - F.col(p), F.col(p) - low - side, F.lit(0.0))

    def facing(sign: int) -> DataFrame:
        """Places that can reach the cell some steps ahead (or behind), with that cell."""
        to = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in steps]))
        rows = named.withColumn("to", to).withColumns({"dx": F.col("to.dx") * sign, "dy": F.col("to.dy") * sign})
        g, h = gap("px", "cx", F.col("dx")), gap("py", "cy", F.col("dy"))
        return rows.where(g * g + h * h <= reach * (1 + 1e-6))

    ahead = facing(1).select("grp", (F.col("cx") + F.col("dx")).alias("kx"), (F.col("cy") + F.col("dy")).alias("ky"), "dx", "dy", "px", "py", F.col("node").alias("src"))
    behind = facing(-1).select(
        "grp", F.col("cx").alias("kx"), F.col("cy").alias("ky"), (-F.col("dx")).alias("dx"), (-F.col("dy")).alias("dy"), F.col("px").alias("qx"), F.col("py").alias("qy"), F.col("node").alias("dst")
    )
    dx, dy = F.col("px") - F.col("qx"), F.col("py") - F.col("qy")
    edges = ahead.join(behind, ["grp", "kx", "ky", "dx", "dy"]).where((F.col("src") != F.col("dst")) & (dx * dx + dy * dy <= eps * eps)).select("src", "dst").distinct()
    found = connected_components(edges, small=SMALL)
    final = named.join(found, F.col("node") == F.col("id"), "left").select("grp", "px", "py", F.coalesce("component", "node").alias("cluster"))
    on = (group.eqNullSafe(F.col("grp")) if by else F.lit(True)) & (F.col(x) == F.col("px")) & (F.col(y) == F.col("py"))
    return points.join(final, on).drop("grp", "px", "py")


def best_of_cluster(clustered: DataFrame, score: str = "score", key: str = "id") -> DataFrame:
    """The row with the highest score of each cluster; the smallest key wins ties."""
    columns = [c for c in clustered.columns if c != "cluster"]
    best = clustered.groupBy("cluster").agg(F.max_by(F.struct(*columns), F.struct(F.col(score), -F.col(key))).alias("best"))
    return best.select(*[F.col(f"best.`{c}`").alias(c) for c in columns], "cluster")


def _stronger(score: str, key: str) -> Column:
    return (F.col(f"l.{score}") > F.col(f"r.{score}")) | ((F.col(f"l.{score}") == F.col(f"r.{score}")) & (F.col(f"l.{key}") < F.col(f"r.{key}")))


def decide(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """The ids that greedy suppression drops, from pairs of stronger and weaker neighbours that fit in memory; each is looked at once all stronger ones are decided."""
    ids, at = np.unique(np.concatenate([hi, lo]), return_inverse=True)
    up, down = at[: len(hi)], at[len(hi) :]
    order = np.argsort(up, kind="stable")
    weaker, starts = down[order].tolist(), np.searchsorted(up[order], np.arange(len(ids) + 1)).tolist()
    waits, gone = np.bincount(down, minlength=len(ids)), [False] * len(ids)
    ready, waits = np.flatnonzero(waits == 0).tolist(), waits.tolist()
    while ready:
        node = ready.pop()
        for k in weaker[starts[node] : starts[node + 1]]:
            gone[k] = gone[k] or not gone[node]
            waits[k] -= 1
            if not waits[k]:
                ready.append(k)
    return ids[np.array(gone, dtype=bool)]


def _decide_all(edges: DataFrame) -> DataFrame:
    """``lo``, what greedy suppression drops of a small table of pairs, from one task."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs = list(parts)
        if pairs:
            whole = pd.concat(pairs)
            yield pd.DataFrame({"lo": decide(whole["hi"].to_numpy(), whole["lo"].to_numpy())})

    return edges.coalesce(1).mapInPandas(run, edges.select("lo").schema)


def greedy(rows: DataFrame, over: DataFrame, key: str = "id", small: int = SMALL) -> DataFrame:
    """In order of strength a row stays if none that stays before it is its neighbour; ``over`` has ``hi, lo``, stronger and weaker neighbours.

    A round keeps every row without an undecided stronger neighbour and drops
    the neighbours of those; this gives what one pass in order gives, and no
    task ever holds more than its share. Once at most ``small`` pairs are
    undecided one task looks at them in order, with the same result.
    """
    edges = settle(over, "nms_edges")
    gone: DataFrame | None = None
    while not edges.isEmpty():
        if small and edges.limit(small + 1).count() <= small:
            last = settle(_decide_all(edges), "nms_dropped")
            gone = last if gone is None else gone.unionByName(last)
            break
        kept = edges.select("hi").distinct().join(edges.select(F.col("lo").alias("hi")).distinct(), "hi", "left_anti")
        dropped = settle(edges.join(kept, "hi", "left_semi").select("lo").distinct(), "nms_dropped")
        gone = dropped if gone is None else gone.unionByName(dropped)
        rest = edges.join(dropped, "lo", "left_anti").join(dropped.select(F.col("lo").alias("hi")), "hi", "left_anti")
        edges = settle(rest.select("hi", "lo"), "nms_edges")
    return rows if gone is None else rows.join(gone.select(F.col("lo").alias(key)), key, "left_anti")


#: Boxes of a class are up to so many times as wide as the narrowest; a tile is so many times as wide as the widest.
_CLASS, _TILE = 16, 4
#: The class of all boxes that are smaller still.
_FINEST = -6
_SIDES = ("xmin", "ymin", "xmax", "ymax")


def _level(x: Column, size: float) -> Column:
    """The class of boxes as wide as that."""
    return F.greatest(F.ceil(F.log(x / F.lit(float(size))) / math.log(_CLASS)), F.lit(_FINEST)).cast("int")


def _wide() -> Column:
    return F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")).cast("double")


def _tiles(boxes: DataFrame, threshold: float, size: float, classes: list[int]) -> DataFrame:
    """Each box once in every tile where a box that it may suppress, or that may suppress it, has its middle: ``_k, _x, _y``, and whether it is that tile's ``own``.

    Boxes with an IoU of at least the threshold differ in width and height by that factor at most.
    ``classes`` are those of all boxes: a tile of another class would hold none of its own and decide nothing.
    """
    least = threshold * (1 - 1e-9)
    w, h = F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")
    wide, there = _wide(), F.array(*[F.lit(c) for c in classes]).cast("array<int>")
    met = F.filter(there, lambda k: (k >= _level(wide * least, size)) & (k <= _level(wide / least, size)))
    d = boxes.withColumns({"_own": _level(wide, size), "_k": F.explode(met)})
    d = d.withColumn("_side", F.pow(F.lit(float(_CLASS)), F.col("_k")) * float(size * _TILE))
    at = lambda x: F.floor(x / F.col("_side")).cast("long")
    most = F.col("_side") / _TILE * (1 + 1e-9)
    touched = lambda lo, hi, x: F.sequence(at(F.col(lo) - F.least(x / least, most) / 2), at(F.col(hi) + F.least(x / least, most) / 2))
    d = d.withColumn("_x", F.explode(touched("xmin", "xmax", w))).withColumn("_y", F.explode(touched("ymin", "ymax", h)))
    middle = [at((F.col(lo) + F.col(hi)) / 2) for lo, hi in (("xmin", "xmax"), ("ymin", "ymax"))]
    own = (F.col("_k") == F.col("_own")) & (F.col("_x") == middle[0]) & (F.col("_y") == middle[1])
    return d.select(*boxes.columns, "_k", "_x", "_y", own.alias("own"))


#: So many boxes of a tile are held against each other at once, and so many pairs with those before them.
_BLOCK, _PAIRS = 256, 1 << 16


def _repeats(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether each box of ``a`` and each of ``b`` have an IoU of at least the threshold."""
    area = [(s[:, 2] - s[:, 0]) * (s[:, 3] - s[:, 1]) for s in (a, b)]
    (ax0, ay0, ax1, ay1), (bx0, by0, bx1, by1) = a.T[:, :, None], b.T[:, None]
    both = np.minimum(ax1, bx1)
    both -= np.maximum(ax0, bx0)
    np.maximum(both, 0, out=both)
    high = np.minimum(ay1, by1)
    high -= np.maximum(ay0, by0)
    np.maximum(high, 0, out=high)
    both *= high
    either = np.add(area[0][:, None], area[1][None], out=high)
    either -= both
    both /= either
    return both >= threshold


class _Held:
    """Boxes of one tile that are held against those after them."""

    def __init__(self):
        self.n, self.sides = 0, np.empty((64, 4))

    def add(self, boxes: np.ndarray) -> None:
        while self.n + len(boxes) > len(self.sides):
            self.sides = np.concatenate([self.sides, self.sides])
        self.sides[self.n : self.n + len(boxes)] = boxes
        self.n += len(boxes)

    def repeat(self, boxes: np.ndarray, threshold: float) -> np.ndarray:
        """Which of the boxes repeat one that is held."""
        out = np.zeros(len(boxes), bool)
        step = max(1, _PAIRS // max(1, len(boxes)))
        for at in range(0, self.n if len(boxes) else 0, step):
            out |= _repeats(self.sides[at : min(at + step, self.n)], boxes, threshold).any(axis=0)
        return out


class _Tile:
    """Boxes of one tile that stay, and those that may stay, so far."""

    def __init__(self, threshold: float):
        self.threshold, self.stay, self.may = threshold, _Held(), _Held()

    def judge(self, sides: np.ndarray, own: np.ndarray, sure: np.ndarray) -> np.ndarray:
        """Which of the next boxes, the strongest first, go; ``sure`` is set for those that are found to stay.

        What goes by a box before this block is told for all at once; the others are held against each other and looked at in order.
        """
        goes = np.zeros(len(sides), bool)
        goes[~sure] = self.stay.repeat(sides[~sure], self.threshold)
        left = np.flatnonzero(~goes)
        waits = np.zeros(len(left), bool)
        open_ = own[left] & ~sure[left]  # the others are decided in other tiles
        waits[open_] = self.may.repeat(sides[left[open_]], self.threshold)
        if len(left) > 1:
            hit = np.triu(_repeats(sides[left], sides[left], self.threshold), 1)
            gone, firm = np.zeros(len(left), bool), sure[left]
            for i in np.flatnonzero(hit.any(axis=1)).tolist():
                if not firm[i]:
                    if gone[i]:
                        continue
                    firm[i] = own[left[i]] and not waits[i]
                if firm[i]:
                    gone |= hit[i]
                else:
                    waits |= hit[i]
            gone &= ~sure[left]
            goes[left[gone]] = True
            left, waits = left[~gone], waits[~gone]
        sure[left] |= own[left] & ~waits
        self.stay.add(sides[left[sure[left]]])
        self.may.add(sides[left[~sure[left]]])
        return goes


def _judge(threshold: float):
    """Boxes tile by tile, the strongest first; of the tile's own ones those that stay (``sure``) or wait."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, tile = None, _Tile(threshold)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch[c].to_numpy() for c in ("_k", "_x", "_y")], axis=1)
            sides = np.stack([batch[c].to_numpy() for c in _SIDES], axis=1)
            sure, own = (batch[c].to_numpy(zero_copy_only=False).copy() for c in ("sure", "own"))
            stays = own.copy()
            starts = np.append(0, np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1)
            ends = np.append(starts[1:], len(keys))
            # a tile whose own boxes are all decided, or that has none, tells nothing; the first and last one may go on in another batch
            told = np.add.reduceat(own & ~sure, starts) == 0
            told[[0, -1]] = False
            for start, end in zip(starts[~told].tolist(), ends[~told].tolist(), strict=True):
                key = tuple(keys[start].tolist())
                if key != last:
                    last, tile = key, _Tile(threshold)
                for at in range(start, end, _BLOCK):
                    rows = slice(at, min(at + _BLOCK, end))
                    stays[rows] &= ~tile.judge(sides[rows], own[rows], sure[rows])
            at = np.flatnonzero(stays)
            kept = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*[kept[c] for c in (*_SIDES, "rank", "name")], pa.array(sure[at])], names=[*_SIDES, "rank", "name", "sure"])

    return run


def _strongest(boxes: DataFrame, threshold: float, size: float, score: str, key: str) -> DataFrame:
    """``name``, the keys of the boxes that greedy suppression leaves, found without making pairs.

    Of equal boxes the strongest alone matters: what drops it drops the others,
    and if it stays they go. The rest is dealt to tiles. Tasks walk through a
    tile in order of strength and hold each box against those before it that
    stay or may stay, a number that room bounds and crowds don't. A box that hangs
    on one whose fate is decided in another tile waits for the next round, which
    knows what this one found; the strongest of those that wait is decided in each.
    """
    rank = F.struct((~F.isnan(F.col(score).cast("double"))).alias("number"), (-F.col(score)).alias("s"), F.col(key).alias("name"))  # ascending; NaN is the highest score
    state = boxes.groupBy(*[F.col(c).cast("double").alias(c) for c in _SIDES]).agg(F.min(rank).alias("rank"))
    state = settle(state.select(*_SIDES, "rank", F.col("rank.name").alias("name"), F.lit(False).alias("sure")), "nms_boxes")
    classes = sorted(r[0] for r in state.select(_level(_wide(), size)).distinct().collect())  # few: sizes span what a double holds
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in state.schema)
    while not state.where("NOT sure").isEmpty():
        # a box costs more work than bytes, so tasks are cut by boxes
        tasks = -(-state.count() // 16384)
        dealt = _tiles(state, threshold, size, classes).repartition(tasks, "_k", "_x", "_y").sortWithinPartitions("_k", "_x", "_y", "rank")
        state = settle(dealt.mapInArrow(_judge(threshold), ddl), "nms_boxes")
    return state.select("name")


def suppress(boxes: DataFrame, threshold: float, size: float, score: str = "score", key: str = "id") -> DataFrame:
    """Greedy suppression: in order of score, then key, a box stays if its IoU with all that stay before it is below the threshold.

    Boxes without a score or without an area stay and suppress none. Keys must differ. ``size`` is about the width of a usual box.
    """
    slim = boxes.select(key, score, *_SIDES)
    if threshold > 0:
        whole = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) & (F.abs(F.col(c)).cast("double") < float("inf")) for c in _SIDES]
        judged = whole[0] & whole[1] & whole[2] & whole[3] & F.col(score).isNotNull() & (F.col("xmax") > F.col("xmin")) & (F.col("ymax") > F.col("ymin"))
        judged = F.coalesce(judged, F.lit(False))
        kept = _strongest(slim.where(judged), threshold, size, score, key).select(F.col("name").alias("_kept"))
        stay = boxes.withColumn("_judged", judged).join(exchanged(kept), F.col(key) == F.col("_kept"), "left").where(~F.col("_judged") | F.col("_kept").isNotNull())
        return stay.select(*[F.col(f"`{c}`") for c in boxes.columns])
    side = lambda s: tuple(f"{s}.{c}" for c in _SIDES)
    over = box_pairs(slim, slim, size, _stronger(score, key) & (box_iou(side("l"), side("r")) >= threshold))
    return greedy(boxes, over.select(F.col(f"l.{key}").alias("hi"), F.col(f"r.{key}").alias("lo")), key)


def region_overlaps(cells: DataFrame, key: str = "id", at: tuple[str, ...] = ("raster_id", "row", "col")) -> DataFrame:
    """``a, b, iou`` of the regions that share a pixel: polygons along pixel edges intersect in just the pixels that both have."""
    sizes = cells.groupBy(key).agg(F.count("*").alias("n"))
    left, right = cells.select(F.col(key).alias("a"), *at), cells.select(F.col(key).alias("b"), *at)
    shared = left.join(right, list(at)).where("a < b").groupBy("a", "b").agg(F.count("*").alias("both"))
    both = shared.join(sizes.select(F.col(key).alias("a"), F.col("n").alias("n_a")), "a").join(sizes.select(F.col(key).alias("b"), F.col("n").alias("n_b")), "b")
    return both.select("a", "b", (F.col("both") / (F.col("n_a") + F.col("n_b") - F.col("both"))).alias("iou"))


def suppress_regions(regions: DataFrame, cells: DataFrame, threshold: float, score: str = "score", key: str = "id") -> DataFrame:
    """Greedy suppression by the IoU of polygons, whose pixels are ``cells`` (the key and a place)."""
    slim = regions.select(key, score)
    over = region_overlaps(cells, key).where(F.col("iou") >= threshold)
    named = over.join(slim.select(F.col(key).alias("a"), F.struct(key, score).alias("l")), "a").join(slim.select(F.col(key).alias("b"), F.struct(key, score).alias("r")), "b")
    first = _stronger(score, key)
    return greedy(regions, named.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("hi"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("lo")), key)


def deduplicate(
    detections: DataFrame, method: str = "dbscan", eps: float = 0.02, iou: float = 0.3, size: float = 1.0, by: str | None = None, cells: DataFrame | None = None
) -> DataFrame:
    """Detections (``id, x, y, score`` and a box) without repeats, best first.

    Clusters are made within each value of ``by``; overlap is that of the
    regions' pixels if these are given as ``cells``, or else of boxes.
    """
    if method == "dbscan":
        out = best_of_cluster(cluster(detections, eps, by=by)).drop("cluster")
    elif method == "iou":
        out = suppress(detections, iou, size) if cells is None else suppress_regions(detections, cells, iou)
    else:
        raise ValueError(f"Unknown dedup method: {method}")
    return out.orderBy(F.desc("score"), "id")


def stratified_split(chips: DataFrame, key: str = "id", order: str = "shuffle", positive: str = "is_positive", train: float = 0.7, val: float = 0.15, buckets: int = 256, span: int = 1 << 20) -> DataFrame:
    """Adds ``split``: of each class the first ``int(n * train)`` in shuffled order train, the next ``int(n * val)`` validate, the rest test.

    ``order`` is a hash of the key below ``span``; it is ranked in buckets.
    """
    from rastra.operators.scan import global_rank

    ranked = global_rank(chips, F.floor(F.col(order) * F.lit(buckets) / F.lit(span)), [F.col(order), F.col(key)], [positive], "_nth")
    sizes = chips.groupBy(F.col(positive).alias("_class")).agg(F.count("*").alias("_n"))
    joined = ranked.join(F.broadcast(sizes), F.col(positive) == F.col("_class"))  # two rows
    n_train, n_val = F.floor(F.col("_n") * train), F.floor(F.col("_n") * val)
    split = F.when(F.col("_nth") < n_train, "train").when(F.col("_nth") < n_train + n_val, "val").otherwise("test")
    return joined.withColumn("split", split).drop("_nth", "_class", "_n")
