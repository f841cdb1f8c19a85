"""Suppression's walk through tiles, in blocks, against one box at a time."""

import numpy as np
import pyarrow as pa
import pytest

from rastra.operators import dedupe


def iou(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    both = max(w, 0) * max(h, 0)
    return both / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both)


def one_by_one(key, sides, own, sure, threshold):
    """The boxes of a tile's own that stay or wait, and whether they are sure to stay."""
    out, held, last = {}, [], None
    for i, k in enumerate(key):
        if k != last:
            held, last = [], k
        firm = sure[i]
        if not firm:
            hit = [s for box, s in held if iou(box, sides[i]) >= threshold]
            if any(hit):
                continue
            firm = own[i] and not hit
        held.append((sides[i], firm))
        if own[i]:
            out[i] = bool(firm)
    return out


@pytest.mark.parametrize("n, tiles, spread", [(900, 1, 60), (900, 3, 8), (600, 200, 6), (40, 40, 3)])
@pytest.mark.parametrize("cut", [1000, 70])
def test_blocks_of_a_tile(n, tiles, spread, cut):
    rng = np.random.default_rng(n + tiles)
    key = np.sort(rng.integers(0, tiles, n))
    middle, half = rng.integers(0, spread, (n, 2)) * 1.0, rng.integers(1, 12, (n, 1)) * 1.0
    sides = np.concatenate([middle - half, middle + half], axis=1)
    own, sure = (rng.random(n) < 0.6) & (key % 4 != 1), rng.random(n) < 0.1
    numbers = np.arange(n)
    columns = {"_k": np.zeros(n, np.int32), "_x": key, "_y": -key, **dict(zip(dedupe._SIDES, sides.T, strict=True)), "rank": numbers, "name": numbers, "sure": sure, "own": own}
    whole = pa.RecordBatch.from_pydict({c: pa.array(np.ascontiguousarray(v)) for c, v in columns.items()})
    got = pa.Table.from_batches(list(dedupe._judge(0.3)(whole.slice(at, cut) for at in range(0, n, cut))))
    assert dict(zip(got["name"].to_pylist(), got["sure"].to_pylist(), strict=True)) == one_by_one(key, sides, own, sure, 0.3)


def test_no_tiles_without_boxes_of_their_own(spark, monkeypatch):
    """A crowd of boxes of one class may repeat boxes of the next one, but there are none."""
    made, tiles = [], dedupe._tiles
    monkeypatch.setattr(dedupe, "_tiles", lambda *args: made.append(tiles(*args).cache()) or made[-1])
    rows = [(i, i / 400, float(i % 20), float(i // 20), i % 20 + 60.0 + i % 40, i // 20 + 60.0 + i % 40) for i in range(400)]
    boxes = spark.createDataFrame(rows, "id long, score double, xmin double, ymin double, xmax double, ymax double")
    kept = dedupe.suppress(boxes, 0.3, 110.0).collect()
    left = []
    for r in sorted(rows, key=lambda r: -r[1]):
        if all(iou(r[2:], s[2:]) < 0.3 for s in left):
            left.append(r)
    assert sorted(r["id"] for r in kept) == sorted(r[0] for r in left)
    for t in made:
        assert [r["_k"] for r in t.select("_k").distinct().collect()] == [0]
