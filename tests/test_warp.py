"""Warping: weights, systems there and back, awkward pixels."""

import math

import pytest
from pyspark.sql import functions as F

from rastra.functions import geo
from rastra.operators.warp import Grid, warp, warp_blocks
from rastra.sources import manifests

KIND = "raster_id long, row int, col int, red double"


def ramp(spark, n, value=lambda r, c: 3.0 * c + 7.0 * r):
    return spark.createDataFrame([(1, r, c, float(value(r, c))) for r in range(n) for c in range(n)], KIND)


def test_utm_there_and_back(spark):
    places = [(lon, lat) for lon in (-2.9, 0.1, 3.0, 5.9) for lat in (-60.0, -0.5, 0.0, 47.3, 79.0)]
    for south in (False, True):
        east, north = geo.utm("lon", "lat", 31, south)
        frame = spark.createDataFrame(places, "lon double, lat double").select("lon", "lat", east.alias("e"), north.alias("n"))
        lon, lat = geo.utm_lonlat("e", "n", 31, south)
        for r in frame.select("lon", "lat", lon.alias("u"), lat.alias("v")).collect():
            assert abs(r["lon"] - r["u"]) < 1e-8 and abs(r["lat"] - r["v"]) < 1e-8


@pytest.mark.parametrize("crs", [4326, 3857])
def test_a_raster_comes_back_within_half_a_pixel(spark, crs):
    zone = Grid((30.0, 0.0, 448000.0, 0.0, -30.0, 5412000.0), 24, 24, 32631)
    lon, lat = (spark.range(1).select(*[c.alias(n) for c, n in zip(geo.utm_lonlat(F.lit(448000.0), F.lit(5412000.0), 31), ("x", "y"))]).first()[k] for k in (0, 1))
    if crs == 4326:
        there = Grid((0.0003, 0.0, lon - 0.001, 0.0, -0.0002, lat + 0.001), 60, 60, crs)
    else:
        x, y = spark.range(1).select(geo.mercator_x(F.lit(lon)), geo.mercator_y(F.lit(lat))).first()
        there = Grid((35.0, 0.0, x - 100.0, 0.0, -35.0, y + 100.0), 60, 60, crs)
    out = warp(ramp(spark, 24), zone, there, ("red",))
    back = warp(out, there, zone, ("red",)).collect()
    assert len(back) == 24 * 24
    inner = [r for r in back if 2 <= r["row"] < 22 and 2 <= r["col"] < 22]
    # half a pixel of the ramp is 1.5 across and 3.5 down
    assert len(inner) == 400 and all(abs(r["red"] - (3 * r["col"] + 7 * r["row"])) < 1.5 for r in inner)


def test_weights_and_missing_pixels(spark):
    rows = [(1, 0, 0, 1.0), (1, 0, 1, None), (1, 1, 0, float("nan")), (1, 1, 1, 5.0), (1, 7, 7, 99.0)]
    here = Grid((1.0, 0.0, 0.0, 0.0, 1.0, 0.0), 2, 2)
    frame = spark.createDataFrame(rows, KIND)
    got = {(r["row"], r["col"]): r["red"] for r in warp(frame, here, Grid((1.0, 0.0, 0.5, 0.0, 1.0, 0.5), 8, 8), ("red",)).collect()}
    assert len(got) == 64 and got[0, 0] == 3.0 and got[1, 1] == 5.0 and got[0, 1] == 5.0 and got[5, 5] is None and got[7, 7] is None
    near = {(r["row"], r["col"]): r["red"] for r in warp(frame, here, here, ("red",), "nearest").collect()}
    assert near == {(0, 0): 1.0, (0, 1): None, (1, 0): None, (1, 1): 5.0}


def test_turned_grid(spark):
    """A grid turned by 90 degrees has rows for columns."""
    here, turned = Grid((1.0, 0.0, 0.0, 0.0, 1.0, 0.0), 5, 5), Grid((0.0, 1.0, 0.0, 1.0, 0.0, 0.0), 5, 5)
    assert all(math.isclose(r["red"], 3 * r["row"] + 7 * r["col"]) for r in warp(ramp(spark, 5), here, turned, ("red",)).collect())


def test_what_is_refused_and_nothing(spark):
    here = Grid((1.0, 0.0, 0.0, 0.0, 1.0, 0.0), 2, 2)
    assert warp(spark.createDataFrame([], KIND), here, here, ("red",)).count() == 0
    for bad in (lambda: Grid((1.0, 1.0, 0.0, 1.0, 1.0, 0.0), 2, 2), lambda: Grid(here.affine, 0, 2), lambda: warp(ramp(spark, 2), here, here, ("red",), "cubic"), lambda: warp(ramp(spark, 2), here, Grid(here.affine, 2, 2, 4326), ("red",)), lambda: warp(ramp(spark, 2), Grid(here.affine, 2, 2, 1234), Grid(here.affine, 2, 2, 4326), ("red",))):
        with pytest.raises(ValueError):
            bad()


@pytest.mark.parametrize("method", ["bilinear", "nearest"])
def test_blocks_give_what_pixels_give(spark, method):
    cells = [(i, r, c, float((r * 37 + c * 61 + i) % 101), float(r * c)) for i in (1, 2) for r in range(19) for c in range(23)]
    cells = [(i, r, c, float("nan") if (r, c) in ((4, 5), (4, 6), (5, 5), (5, 6)) else red, nir) for i, r, c, red, nir in cells]
    frame = spark.createDataFrame(cells, "raster_id long, row int, col int, red double, nir double")
    blocks = manifests.pixels_to_blocks(frame, 8, ("red", "nir"))
    here = Grid((10.0, 0.0, 500000.0, 0.0, -10.0, 5000000.0), 19, 23, 32632)
    turned = Grid((6.0, 1.5, 499980.0, -1.0, -7.0, 5000010.0), 37, 41, 32632)
    other = Grid((0.0001, 0.0, 8.9997, 0.0, -0.0001, 45.1535), 24, 30, 4326)
    for target in (turned, other):
        one = {(r["raster_id"], r["row"], r["col"]): (r["red"], r["nir"]) for r in warp(frame, here, target, ("red", "nir"), method).collect()}
        two = {(r["raster_id"], r["row"], r["col"]): (r["red"], r["nir"]) for r in warp_blocks(blocks, here, target, ("red", "nir"), method, edge=8, out_edge=16).collect()}
        assert one.keys() == two.keys() and len(one) == 2 * target.height * target.width
        assert any(v[0] is not None for v in one.values()) and any(v[0] is None for v in one.values())
        for k, v in one.items():
            assert all((a is None) == (b is None) and (a is None or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)) for a, b in zip(v, two[k])), (k, v, two[k])
    assert warp_blocks(blocks.limit(0), here, turned, ("red", "nir"), method, edge=8).count() == 0


def test_blocks_off_the_grid_and_lost_blocks(spark):
    blocks = manifests.pixels_to_blocks(ramp(spark, 8), 4, ("red",))
    here = Grid((1.0, 0.0, 0.0, 0.0, 1.0, 0.0), 8, 8)
    with pytest.raises(Exception, match="not on the grid"):
        warp_blocks(blocks, here, here, ("red",), edge=6).collect()
    found = {(r["row"], r["col"]): r["red"] for r in warp_blocks(blocks.where("block_row = 0"), here, here, ("red",), edge=4).collect()}
    assert found == {(r, c): 3.0 * c + 7.0 * r if r < 4 else None for r in range(8) for c in range(8)}
    with pytest.raises(ValueError):
        warp_blocks(blocks, here, here, ("red",), "cubic", edge=4)
