"""Tile pyramids and tables laid out along a curve."""

import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rastra import sinks
from rastra.operators import layout, pyramid

KIND = "id long, score double, lon double, lat double"


def test_pyramid_counts_every_detection_once_a_zoom(spark):
    rng = random.Random(5)
    rows = [(i, rng.random(), rng.uniform(-180, 179.9), rng.uniform(-80, 80)) for i in range(300)] + [(1000 + i, 0.5, 10.0, 10.0) for i in range(700)]
    cells = pyramid.tile_pyramid(spark.createDataFrame(rows, KIND), 0, 7, min_score=0.0, per_side=8).toPandas()
    assert (cells.groupby("z")["n"].sum() == 1000).all()
    assert (cells.groupby(["z", "x", "y"]).size() <= 64).all()
    assert cells[["px", "py"]].min().min() >= 0 and cells[["px", "py"]].max().max() < 4096
    assert cells.groupby("z").size().is_monotonic_increasing
    hot = cells[(cells["z"] == 7) & (cells["n"] >= 700)]
    assert len(hot) == 1 and (hot["score"] >= 0.5).all()


def test_pyramid_of_awkward_rows(spark):
    nan = float("nan")
    rows = [(1, None, 0.1, 0.1), (2, nan, 0.1, 0.1), (3, 0.9, None, 0.0), (4, 0.9, nan, 0.0), (5, 0.9, 0.0, 90.0), (6, 0.9, 0.0, -90.0), (7, 0.9, 180.0, 0.0), (8, 0.9, 500.0, 0.0), (9, 0.5, 0.1, 0.1), (9, 0.5, 0.1, 0.1), (8, 0.5, 0.1, 0.1)]
    got = pyramid.tile_pyramid(spark.createDataFrame(rows, KIND), 2, 2, min_score=0.0).collect()
    assert [(r["z"], r["x"], r["y"], r["id"], r["score"], r["n"]) for r in got] == [(2, 2, 1, 8, 0.5, 5)]
    assert pyramid.tile_pyramid(spark.createDataFrame([], KIND), 0, 3).count() == 0
    for low, high, side in ((3, 2, 64), (0, 25, 64), (0, 1, 48)):
        with pytest.raises(ValueError):
            pyramid.tile_pyramid(spark.createDataFrame([], KIND), low, high, per_side=side)


def test_pyramid_as_vector_tiles(spark):
    rows = [(1, 0.9, -90.0, 40.0), (2, 0.8, -90.0, 40.0), (3, 0.7, 90.0, -40.0)]
    tiles = sinks.vector_tiles(pyramid.tile_pyramid(spark.createDataFrame(rows, KIND), 0, 1), ["z", "x", "y"]).toPandas()
    assert sorted(zip(tiles["z"], tiles["x"], tiles["y"])) == [(0, 0, 0), (1, 0, 0), (1, 1, 1)]
    assert all(b"detections" in t for t in tiles["tile"])


def test_curve(spark):
    cells = [(x, y) for x in range(16) for y in range(16)]
    keys = [layout.hilbert_cell(x, y, 4) for x, y in cells]
    assert sorted(keys) == list(range(256))
    path = [cells[keys.index(k)] for k in range(256)]
    assert all(abs(a - c) + abs(b - d) == 1 for (a, b), (c, d) in zip(path, path[1:]))
    got = spark.createDataFrame(cells, "x int, y int").select("x", "y", layout.hilbert_key(F.col("x"), F.col("y"), 4).alias("k")).collect()
    assert {(r["x"], r["y"]): r["k"] for r in got} == dict(zip(cells, keys))
    for box in ((0, 0, 15, 15), (3, 5, 9, 6), (7, 7, 8, 8), (15, 0, 15, 0)):
        inside = {k for (x, y), k in zip(cells, keys) if box[0] <= x <= box[2] and box[1] <= y <= box[3]}
        exact = layout.key_ranges(*box, 4, 1000)
        assert {k for a, b in exact for k in range(a, b + 1)} == inside
        few = layout.key_ranges(*box, 4, 3)
        assert len(few) <= 3 and inside <= {k for a, b in few for k in range(a, b + 1)}


def test_a_box_reads_a_part_of_the_row_groups(spark, tmp_path):
    rng = random.Random(9)
    rows = []
    for i in range(40000):
        x, y, half = rng.uniform(-180, 180), rng.uniform(-90, 90), 10 ** rng.uniform(-3, -1)
        rows.append((i, x - half, y - half, x + half, y + half))
    rows += [(-1, -180.0, -90.0, 180.0, 90.0), (-2, -60.0, -60.0, 60.0, 60.0), (-3, 170.0, 80.0, 400.0, 95.0), (-4, None, 0.0, 1.0, 1.0), (-5, float("nan"), 0.0, 1.0, 1.0), (-6, 9.0, 9.0, 9.0, 9.0), (-6, 9.0, 9.0, 9.0, 9.0)]
    frame = spark.createDataFrame(rows, "id long, xmin double, ymin double, xmax double, ymax double")
    laid, path = layout.Layout((-180, -90, 180, 90), unit=0.01), str(tmp_path / "laid")
    laid.write(frame, path, files=32)
    assert spark.read.parquet(path).count() == len(rows)
    for box in ((9.0, 9.0, 12.0, 11.0), (179.0, 89.0, 300.0, 200.0), (-0.5, -0.5, 0.5, 0.5)):
        want = sorted(i for i, a, b, c, d in rows if a is not None and a <= box[2] and c >= box[0] and b <= box[3] and d >= box[1])
        found = laid.read(spark, path, box)
        assert sorted(r["id"] for r in found.collect()) == want
        assert "place" in found._jdf.queryExecution().executedPlan().toString().split("PushedFilters", 1)[1]
    groups = read = 0
    spans = laid.ranges((9.0, 9.0, 12.0, 11.0))
    for name in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.to_arrow_schema().get_field_index("place")
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            groups += 1
            read += not stats.has_min_max or any(a <= stats.max and stats.min <= b for a, b in spans)
    assert groups >= 32 and read <= groups / 4


def test_layout_of_no_boxes(spark, tmp_path):
    laid = layout.Layout((0, 0, 1, 1), unit=0.1)
    laid.write(spark.createDataFrame([], "id long, xmin double, ymin double, xmax double, ymax double"), str(tmp_path / "none"))
    assert laid.read(spark, str(tmp_path / "none"), (0.0, 0.0, 1.0, 1.0)).count() == 0
    with pytest.raises(ValueError):
        layout.Layout((0, 0, 0, 1), unit=0.1)
