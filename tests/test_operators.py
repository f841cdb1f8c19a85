"""Operators against plain versions and hand-made cases."""

import json
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rastra import sinks
from rastra.functions import algebra, geo
from rastra.operators import catalog, composite, dedupe, evaluate, graph, grid, inference, joins, regions, scan
from rastra.plans import pipelines
from rastra.sources import manifests


def raster(spark, image, raster_id=0, value="value"):
    rows = [(raster_id, r, c, float(v)) for r, line in enumerate(image) for c, v in enumerate(line)]
    return spark.createDataFrame(rows, f"raster_id long, row int, col int, {value} double")


def flood(image, on):
    """Labels by flood fill, numbered by their smallest pixel."""
    h, w = image.shape
    labels = {}
    for r in range(h):
        for c in range(w):
            if on[r, c] and (r, c) not in labels:
                todo, name = [(r, c)], r * w + c
                while todo:
                    y, x = todo.pop()
                    if 0 <= y < h and 0 <= x < w and on[y, x] and (y, x) not in labels:
                        labels[y, x] = name
                        todo += [(y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)]
    return labels


def test_regions_match_flood_fill(spark):
    rng = np.random.default_rng(3)
    image = rng.random((23, 17))
    pixels = raster(spark, image)
    got = regions.label_regions(pixels.where(algebra.at_least("value", 0.45)), 17, 23 * 17).collect()
    assert {(r["row"], r["col"]): r["component"] for r in got} == flood(image, image >= 0.45)


def test_region_measures_and_outline_of_a_ring(spark):
    image = np.ones((3, 3))
    image[1, 1] = 0
    on = raster(spark, image).where("value > 0")
    labelled = regions.label_regions(on, 3, 9)
    r = regions.region_features(labelled, "value").first()
    assert (r["area_px"], r["perimeter"], r["centroid_x"], r["centroid_y"]) == (8, 16.0, 1.5, -1.5)
    rings = regions.trace_outlines(labelled).first()["rings"]
    area = lambda ring: abs(sum(a["x"] * b["y"] - b["x"] * a["y"] for a, b in zip(ring, ring[1:]))) / 2
    assert sorted(area(x) for x in rings) == [1.0, 9.0]


def test_diagonal_pixels_are_two_regions_and_nan_is_off(spark):
    image = np.array([[1.0, float("nan")], [0.0, 1.0]])
    found = regions.extract_regions(raster(spark, image), "value", 0.5, 2, 4, min_px=1)
    assert found.count() == 2
    assert regions.extract_regions(raster(spark, np.zeros((2, 2))), "value", 0.5, 2, 4).count() == 0


def test_components_of_a_long_chain_and_noise(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100), (200, 201), (None, 3)]
    got = dict(graph.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect())
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 200, 201: 200}
    assert graph.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_suppression_is_greedy(spark):
    rnd = random.Random(5)
    boxes = [(i, rnd.randrange(20) / 20, *(p := (rnd.randrange(60), rnd.randrange(60))), p[0] + rnd.randrange(1, 20), p[1] + rnd.randrange(1, 20)) for i in range(150)]

    def iou(a, b):
        w, h = min(a[4], b[4]) - max(a[2], b[2]), min(a[5], b[5]) - max(a[3], b[3])
        both = max(w, 0) * max(h, 0)
        return both / ((a[4] - a[2]) * (a[5] - a[3]) + (b[4] - b[2]) * (b[5] - b[3]) - both)

    kept = []
    for b in sorted(boxes, key=lambda b: (-b[1], b[0])):
        if all(iou(b, k) < 0.3 for k in kept):
            kept.append(b)
    df = spark.createDataFrame(boxes, "id long, score double, xmin long, ymin long, xmax long, ymax long")
    assert {r["id"] for r in dedupe.suppress(df, 0.3, 20.0).collect()} == {b[0] for b in kept}


@pytest.mark.parametrize("threshold", [0.1, 0.3, 0.8])
def test_suppression_of_crowds_makes_no_pairs(spark, monkeypatch, threshold):
    """Boxes of all sizes in heaps, copies, equal and undefined scores, over many tiles."""
    rnd = random.Random(6)
    rows = []
    for i in range(600):
        x, y, w = rnd.randrange(6) * 30 - 60 + rnd.random() * 4, rnd.randrange(6) * 30 - 60 + rnd.random() * 4, rnd.choice([0.01, 0.5, 3, 20, 90]) * (1 + rnd.random())
        rows.append((i, rnd.choice([rnd.random(), 0.5, float("nan")]), x, y, x + w, y + w * (0.5 + rnd.random())))
    rows += [(600 + k, rnd.random(), *b[2:]) for k, b in enumerate(rows[:200])]

    def iou(a, b):
        w, h = min(a[4], b[4]) - max(a[2], b[2]), min(a[5], b[5]) - max(a[3], b[3])
        both = max(w, 0) * max(h, 0)
        return both / ((a[4] - a[2]) * (a[5] - a[3]) + (b[4] - b[2]) * (b[5] - b[3]) - both)

    kept = []
    for b in sorted(rows, key=lambda b: (b[1] == b[1], -b[1] if b[1] == b[1] else 0, b[0])):
        if all(iou(b, k) < threshold for k in kept):
            kept.append(b)
    odd = [(900, None, 0.0, 0.0, 9.0, 9.0), (901, 2.0, 0.0, 0.0, 0.0, 9.0), (902, 2.0, None, 0.0, 1.0, 9.0), (903, 2.0, float("nan"), 0.0, 1.0, 9.0)]
    df = spark.createDataFrame(rows + odd, "id long, score double, xmin double, ymin double, xmax double, ymax double")
    monkeypatch.setattr(dedupe, "box_pairs", None)
    got = dedupe.suppress(df, threshold, 4.0)
    assert got.columns == df.columns
    assert sorted(r["id"] for r in got.collect()) == sorted(b[0] for b in kept + odd)


def test_clusters_chain_and_reach_is_inclusive(spark):
    pts = [(0, 0.0, 0.0, 0.1), (1, 2.0, 0.0, 0.9), (2, 4.0, 0.0, 0.9), (3, 6.5, 0.0, 0.2), (4, 6.5, 0.0, 0.2)]
    df = spark.createDataFrame(pts, "id long, x double, y double, score double")
    best = {r["id"]: r["cluster"] for r in dedupe.best_of_cluster(dedupe.cluster(df, 2.0)).collect()}
    assert best == {1: 0, 3: 3}
    assert [r["id"] for r in dedupe.deduplicate(df, eps=2.0).collect()] == [1, 3]
    with pytest.raises(ValueError):
        dedupe.deduplicate(df, "other")


def test_split_sizes(spark):
    chips = spark.range(1003).selectExpr("id", "id * 7919 % 1048573 AS shuffle", "id % 10 = 0 AS is_positive")
    got = {(r["is_positive"], r["split"]): r["count"] for r in dedupe.stratified_split(chips).groupBy("is_positive", "split").count().collect()}
    for positive, n in ((True, 101), (False, 902)):
        train, val = int(n * 0.7), int(n * 0.15)
        assert (got[positive, "train"], got[positive, "val"], got[positive, "test"]) == (train, val, n - train - val)


def test_tile_windows_match_the_formula(spark):
    rows = [(i, h, w) for i, (h, w) in enumerate([(1024, 1024), (255, 900), (256, 256), (700, 300)])]
    df = spark.createDataFrame(rows, "raster_id long, height int, width int")
    got = dict(grid.tile_windows(df, 256, 64).groupBy("raster_id").count().collect())
    for i, h, w in rows:
        assert got.get(i, 0) == max(0, (h - 256) // 192 + 1) * max(0, (w - 256) // 192 + 1)


def test_overlap_average_and_uncovered_edges(spark):
    pixels = spark.range(100).selectExpr("0L AS raster_id", "CAST(id DIV 10 AS INT) AS row", "CAST(id % 10 AS INT) AS col", "1.0D AS prob")
    full = grid.fill_uncovered(pixels, grid.overlap_average(grid.to_tiles(pixels, 4, 1, 10, 10)))
    assert full.agg(F.sum("prob")).first()[0] == 100
    cut = grid.fill_uncovered(pixels, grid.overlap_average(grid.to_tiles(pixels, 4, 0, 10, 10)))
    assert cut.agg(F.sum("prob")).first()[0] == 64


def test_augment_is_numpy_rot90_and_flips(spark):
    image = np.arange(16).reshape(4, 4)
    for k in range(4):
        out = np.zeros((4, 4))
        for r in grid.augment(raster(spark, image), 4, turns=F.lit(k), flip_h=F.lit(k == 1), flip_v=F.lit(k == 2)).collect():
            out[r["row"], r["col"]] = r["value"]
        want = np.rot90(image, k)
        want = np.fliplr(want) if k == 1 else np.flipud(want) if k == 2 else want
        assert (out == want).all()


def test_composite_ignores_nan_and_stretch_of_flat_bands(spark):
    looks = spark.createDataFrame([(0, 0, 0, 1.0), (0, 0, 0, float("nan")), (0, 0, 0, 2.0), (0, 0, 1, float("nan"))], "raster_id long, row int, col int, blue double")
    got = {r["col"]: r["blue"] for r in composite.temporal_composite(looks, "median", ("blue",)).collect()}
    assert got == {0: 1.5, 1: None}
    with pytest.raises(ValueError):
        composite.temporal_composite(looks, "mode", ("blue",))
    flat = spark.createDataFrame([(0, 0, i, 5.0) for i in range(4)], "raster_id long, row int, col int, blue double")
    assert {r["blue"] for r in composite.percentile_stretch(flat, bands=("blue",)).collect()} == {0.0}


def test_stretch_matches_numpy(spark):
    values = np.random.default_rng(1).normal(size=200)
    df = spark.createDataFrame([(0, 0, i, float(v)) for i, v in enumerate(values)], "raster_id long, row int, col int, blue double")
    got = np.array([r["blue"] for r in composite.percentile_stretch(df, bands=("blue",)).orderBy("col").collect()])
    lo, hi = np.percentile(values, [2, 98])
    assert np.allclose(got, np.clip((values - lo) / (hi - lo), 0, 1))


def test_limits_by_rank_equal_numpy(spark):
    """Groups of one value, of ties, of nulls and NaN; the two ways agree."""
    rng = np.random.default_rng(11)
    values = {0: rng.random(501), 1: np.repeat(3.5, 40), 2: rng.integers(-5, 5, 300).astype(float), 3: np.array([7.0]), 4: np.array([np.nan, np.nan])}
    rows = [(g, float(v), None if i % 3 else float(-v)) for g, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "raster_id int, red double, nir double")
    for small in (True, False):
        found = {r["raster_id"]: r for r in composite.limits(df, ["raster_id"], ("red", "nir"), small=small).collect()}
        for g, vs in values.items():
            if np.isnan(vs).any():
                assert g not in found or found[g]["red_lo"] is None
                continue
            assert np.allclose([found[g]["red_lo"], found[g]["red_hi"]], np.percentile(vs, [2, 98]))
            assert np.allclose([found[g]["nir_lo"], found[g]["nir_hi"]], np.percentile(-vs[::3], [2, 98]))
    stretched = composite.percentile_stretch(df, bands=("red", "nir"))
    assert stretched.count() == len(rows)


def test_indices_of_an_empty_pixel_are_zero(spark):
    zero = spark.createDataFrame([(0.0,) * 6], ", ".join(f"{b} double" for b in algebra.BANDS))
    assert list(algebra.add_indices(zero).first())[6:] == [0.0] * 4


def test_calibration_edges(spark):
    scores = [0.3, 0.6, 0.7, 1.0, 0.0, 0.05]
    preds = spark.createDataFrame([(i, 0.0, 0.0, s) for i, s in enumerate(scores)], "id long, x double, y double, score double")
    none = spark.createDataFrame([], "x double, y double")
    got = {r["bin"]: r["count"] for r in evaluate.calibration(preds, none, 1.0).collect()}
    edges = [i * (1 / 10) for i in range(11)]
    assert got == {b: sum(edges[b] <= s < edges[b + 1] for s in scores) for b in range(10)}


def test_site_match_is_strict_and_guards(spark):
    site = spark.createDataFrame([(0.0, 0.0)], "x double, y double")
    preds = spark.createDataFrame([(1, 5.0, 0.0, 0.9)], "id long, x double, y double, score double")
    assert evaluate.recall_at_k(preds, site, 5, 5.0).first()["recall"] == 0
    assert evaluate.recall_at_k(preds, site, 5, 5.1).first()["recall"] == 1
    assert evaluate.recall_at_k(preds, site.where("false"), 5, 5.1).first()["recall"] == 0
    assert evaluate.false_alarms(preds, site, 0.0, 5.1).first()["per_1000_km2"] == 0


def test_running_sum_and_auroc(spark):
    rnd = random.Random(2)
    rows = [(rnd.randrange(40) / 4 - 5, float(rnd.random() < 0.4)) for _ in range(300)]
    df = spark.createDataFrame(rows, "logit double, target double")
    pairs = [(a, b) for a, t in rows if t for b, u in rows if not u]
    want = sum((a > b) + 0.5 * (a == b) for a, b in pairs) / len(pairs)
    assert math.isclose(evaluate.auroc(df, F.col("logit")).first()[0], want)
    ranked = scan.global_rank(spark.range(100), F.floor(F.col("id") / 7), [F.col("id")]).collect()
    assert all(r["rank"] == r["id"] for r in ranked)


def test_inscribed_polygon(spark):
    rng = np.random.default_rng(4)
    xy = rng.uniform(-1.1, 1.1, (400, 2))
    df = spark.createDataFrame([(float(x), float(y)) for x, y in xy], "x double, y double")
    got = [r[0] for r in df.select(geo.in_buffer(F.col("x"), F.col("y"), F.lit(1.0))).collect()]
    corners = np.exp(2j * np.pi * np.arange(65) / 64)
    for (x, y), inside in zip(xy, got):
        side = [(b.real - a.real) * (y - a.imag) - (b.imag - a.imag) * (x - a.real) for a, b in zip(corners, corners[1:])]
        assert inside == (min(side) >= -1e-12) or abs(min(side)) < 1e-9


def test_projections(spark):
    df = spark.createDataFrame([(9.0, 48.5)], "lon double, lat double")
    e, n = df.select(*geo.utm("lon", "lat", 32)).first()
    # the meridian's length from the equator, summed over short pieces
    e2 = 2 / 298.257223563 - 1 / 298.257223563**2
    parts = np.radians((np.arange(200_000) + 0.5) * 48.5 / 200_000)
    arc = (6378137.0 * (1 - e2) / (1 - e2 * np.sin(parts) ** 2) ** 1.5).sum() * math.radians(48.5) / 200_000
    assert abs(e - 500000) < 1e-3 and abs(n - 0.9996 * arc) < 0.01
    _, south = df.select(*geo.utm("lon", -F.col("lat"), 32, south=True)).first()
    assert abs(south - (1e7 - n)) < 1e-3
    lon, lat = df.select(*geo.mercator_lonlat(geo.mercator_x("lon"), geo.mercator_y("lat"))).first()
    assert math.isclose(lon, 9.0) and math.isclose(lat, 48.5)
    with pytest.raises(ValueError):
        geo.tile_bounds(2, 4, 0)


def test_pages(spark):
    df = spark.createDataFrame([(i, 0.5, 0, 0, 1, 1, "m") for i in range(5)], "id long, score double, xmin long, ymin long, xmax long, ymax long, model_version string")
    page = lambda **k: [r["id"] for r in catalog.detections_page(df, (0, 0, 2, 2), 0.1, **k).collect()]
    assert page(limit=2, offset=1) == [1, 2] and page(limit=2, offset=9) == []
    for bad in ({"limit": 0}, {"limit": 1001}, {"offset": -1}):
        with pytest.raises(ValueError):
            page(**bad)
    empty = catalog.feature_collection(catalog.geojson(df.where("false"), "xmin", "ymin", "id")).first()[0]
    assert json.loads(empty) == {"type": "FeatureCollection", "features": []}
    two = json.loads(catalog.feature_collection(catalog.geojson(df, "xmin", "ymin", "id"), 2).first()[0])
    assert [f["properties"]["id"] for f in two["features"]] == [0, 1]


def test_blocks_round_trip_and_windows(spark):
    pixels = manifests.synthetic_raster(spark, 20, 30)
    blocks = manifests.pixels_to_blocks(pixels, 8)
    back = manifests.blocks_to_pixels(blocks)
    assert back.exceptAll(pixels).count() == 0 and back.count() == 600
    part = manifests.read_window(blocks, 0, 5, 9, 10, 4, 8)
    assert part.count() == 40 and part.agg(F.min("col")).first()[0] == 9
    with pytest.raises(ValueError):
        manifests.read_window(blocks, 0, 0, 0, 0, 4, 8)


def test_manifests(spark, tmp_path):
    p = tmp_path / "sites.json"
    p.write_text(json.dumps({"description": "d", "sites": [{"name": "a", "lat": 1.0, "lon": 2.0, "country": "X"}]}))
    assert manifests.read_sites(spark, str(p)).first()["buffer_km"] == 2.0
    p = tmp_path / "aois.json"
    p.write_text(json.dumps({"aois": [{"name": "a", "bbox": [0, 1, 2, 3], "priority": 1}]}))
    assert manifests.read_aois(spark, str(p)).first()["ymax"] == 3.0
    p = tmp_path / "chips.json"
    p.write_text(json.dumps([{"tile_id": "t"}, {"tile_id": "u", "split": "val"}]))
    assert sorted(r["split"] for r in manifests.read_chips(spark, str(p)).collect()) == ["train", "val"]
    assert manifests.Settings.load({"POSTGRES_PORT": "9"}).jdbc_url.endswith(":9/rastra")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, 0.5)], "id long, score double")
    for _ in range(2):  # a rerun replaces
        sinks.store_detections(df, str(tmp_path / "d"), "m1", "a")
    stored = spark.read.parquet(str(tmp_path / "d"))
    assert stored.count() == 2 and stored.agg(F.min("score")).first()[0] == 0.0
    png = sinks.encode_png(2, 1, bytes([255, 0, 0, 0, 255, 0]))
    assert png.startswith(b"\x89PNG") and png.endswith(b"IEND\xaeB`\x82")
    tile = sinks.encode_tile(pd.DataFrame({"id": [3], "px": [10], "py": [20], "score": [0.5]}))
    assert b"detections" in tile and tile[0] == 3 << 3 | 2
    tiles = sinks.vector_tiles(spark.createDataFrame([(1, 3, 10, 20, 0.5)], "t int, id long, px int, py int, score double"), ["t"])
    assert bytes(tiles.first()["tile"]) == tile


def read_message(raw):
    """Fields of a protocol buffer message: number and value."""
    out, at = [], 0

    def varint():
        nonlocal at
        n = shift = 0
        while True:
            byte = raw[at]
            at += 1
            n |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return n

    while at < len(raw):
        tag = varint()
        if tag & 7 == 0:
            out.append((tag >> 3, varint()))
        else:
            size = 8 if tag & 7 == 1 else varint()
            out.append((tag >> 3, raw[at : at + size]))
            at += size
    return out


def test_polygons_in_tiles_are_clipped_and_keep_their_properties(spark):
    lon = lambda px: px / 4096 * 180 - 180  # noqa: E731  tile 1/0/0 is the north-west quarter
    ring = [(lon(100.5), 60.0), (lon(9000.5), 60.0), (lon(9000.5), 10.0), (lon(100.5), 10.0), (lon(100.5), 60.0)]
    hole = [(lon(200.5), 50.0), (lon(200.5), 40.0), (lon(300.5), 40.0), (lon(300.5), 50.0), (lon(200.5), 50.0)]
    away = [(100.0, -50.0), (101.0, -50.0), (101.0, -51.0), (100.0, -50.0)]
    rows = [(7, [ring, hole], 0.75, 3.5, "m1", -179.0, 10.0, 0.0, 60.0), (8, [away], 0.9, 1.0, None, 100.0, -51.0, 101.0, -50.0), (9, [ring], 0.05, 1.0, "m1", -179.0, 10.0, 0.0, 60.0)]
    kind = "id long, rings array<array<struct<x: double, y: double>>>, score double, area_km2 double, model_version string, xmin double, ymin double, xmax double, ymax double"
    tiles = sinks.vector_tiles(sinks.tile_polygons(spark.createDataFrame(rows, kind), 1, 0, 0).withColumn("z", F.lit(1)), ["z"])
    (layer,) = [v for n, v in read_message(bytes(tiles.first()["tile"])) if n == 3]
    fields = read_message(layer)
    assert [v for n, v in fields if n == 3] == [b"score", b"area_km2", b"model_version"]
    (feature,) = [read_message(v) for n, v in fields if n == 2]
    assert (1, 7) in feature and (3, 3) in feature
    raw, numbers, at = dict(feature)[4], [], 0
    while at < len(raw):
        n = shift = 0
        while True:
            n |= (raw[at] & 127) << shift
            shift += 7
            at += 1
            if raw[at - 1] < 128:
                break
        numbers.append(n)
    rings, x, y, k = [], 0, 0, 0
    while k < len(numbers):
        command, count = numbers[k] & 7, numbers[k] >> 3
        k += 1
        if command == 1:
            rings.append([])
        for _ in range(count if command != 7 else 0):
            x += numbers[k] >> 1 ^ -(numbers[k] & 1)
            y += numbers[k + 1] >> 1 ^ -(numbers[k + 1] & 1)
            rings[-1].append((x, y))
            k += 2
    area = lambda r: sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:] + r[:1])) / 2
    assert {p[0] for p in rings[0]} == {100, 4096 + 256} and {p[0] for p in rings[1]} == {200, 300}
    assert area(rings[0]) > 0 > area(rings[1])


def test_flow_from_looks_to_detections(spark):
    looks = manifests.synthetic_raster(spark, 64, 64).withColumn("scl", F.lit(4))
    sites = joins.buffer_boxes(spark.createDataFrame([(100.0, -100.0, 2.0)], "x double, y double, b double"), F.col("b") * 10)
    made, chips = pipelines.ingest_and_preprocess(looks, sites, 16, 4, 64, 64, (10.0, 0.0, 0.0, 0.0, -10.0, 0.0))
    assert chips.count() == 25 and chips.where("is_positive").count() > 0
    found = pipelines.scan_and_detect(made, inference.BASELINE, 16, 4, 64, 64, threshold=0.6, min_px=2)
    rows = found.collect()
    assert [r["score"] for r in rows] == sorted((r["score"] for r in rows), reverse=True)


class Flaky:
    """Fails every call but each third one of a process."""

    calls = 0

    def __call__(self, x):
        Flaky.calls += 1
        if Flaky.calls % 3:
            raise TimeoutError("busy")
        return x[:, 3] * 2 - 1


def test_remote_model_inside_the_sliding_window(spark):
    pixels = manifests.synthetic_raster(spark, 32, 32)
    same = inference.LinearModel({"nir": 2.0}, -1.0)
    remote = inference.RemoteModel(Flaky(), attempts=3, pause=0.001)
    one, other = ({(r["row"], r["col"]): r["prob"] for r in inference.sliding_window(pixels, m, 16, 4, 32, 32).collect()} for m in (same, remote))
    assert one.keys() == other.keys() and all(math.isclose(one[k], other[k], abs_tol=1e-6) for k in one)
    with pytest.raises(Exception, match="busy"):
        inference.sliding_window(pixels, inference.RemoteModel(Flaky(), attempts=1), 16, 4, 32, 32).collect()


def test_models_are_saved_and_chosen_by_name(spark, tmp_path):
    model = inference.LinearModel({"nir": 0.25, "ndvi": -1.5}, 0.125)
    model.save(spark, str(tmp_path / "m"))
    found = inference.choose_model(spark, str(tmp_path / "m"))
    assert (found.weights, found.bias) == (model.weights, model.bias)
    assert inference.choose_model(spark, "baseline") is inference.BASELINE


def test_commands_ingest_train_and_detect(spark, tmp_path):
    looks = manifests.synthetic_raster(spark, 64, 64).withColumn("scl", F.lit(4))
    looks.write.parquet(str(tmp_path / "looks"))
    sites = {"description": "", "sites": [{"name": "a", "lat": 48.4995, "lon": 9.0005, "country": "x", "buffer_km": 0.1}]}
    (tmp_path / "sites.json").write_text(json.dumps(sites))
    east, north = spark.range(1).select(*geo.utm(F.lit(9.0), F.lit(48.5), 32)).first()
    common = ["--looks", "looks", "--sites", "sites.json", "--composite", "composite", "--chips", "chips", "--detections", "found", "--model", "model"]
    common = [c if c.startswith("--") else str(tmp_path / c) for c in common]
    common += ["--size", "64", "64", "--tile", "16", "--utm-zone", "32", "--threshold", "0.01", "--affine", "10", "0", str(east), "0", "-10", str(north)]
    for command in ("ingest", "train", "detect"):
        pipelines.main([command, *common])
    chips = spark.read.json(str(tmp_path / "chips"))
    assert 0 < chips.where("is_positive").count() < chips.count()
    assert inference.LinearModel.load(spark, str(tmp_path / "model")).bias < 0
    found = spark.read.parquet(str(tmp_path / "found"))
    assert found.count() > 0 and found.where(F.col("x").between(east, east + 640) & F.col("y").between(north - 640, north)).count() == found.count()


def test_flow_over_areas(spark, tmp_path):
    aois = spark.createDataFrame([("p", 0.0, 0.0, 1.0, 1.0), ("q", 5.0, 5.0, 6.0, 6.0), ("r", 50.0, 50.0, 51.0, 51.0)], "name string, xmin double, ymin double, xmax double, ymax double")
    scenes = spark.createDataFrame(
        [(i, "sentinel-2", f"2024-01-{10 + i:02d} 00:00:00", 5.0, x, x, x + 1.0, x + 1.0) for i, x in enumerate((0.0, 0.5, 5.0, 0.2))],
        "scene_id long, sensor string, ts string, cloud_cover double, xmin double, ymin double, xmax double, ymax double",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    one = manifests.synthetic_raster(spark, 32, 32).withColumn("scl", F.lit(4)).drop("raster_id")
    looks = one.crossJoin(spark.range(4).withColumnRenamed("id", "scene_id")).withColumn("nir", (F.col("nir") + 997 * F.col("scene_id")) % 10000)
    made = pipelines.composites_of_areas(aois, scenes, looks, "2024-01-01", "2024-02-01", limit=2)
    assert {(r["aoi"], r["n"]) for r in made.groupBy("aoi").agg(F.count("*").alias("n")).collect()} == {("p", 1024), ("q", 1024)}
    options = dict(tile=16, overlap=4, height=32, width=32, threshold=0.55, min_px=2, eps=1.0)
    totals = {r["aoi"]: r["detections"] for r in pipelines.detect_areas(made, inference.BASELINE, str(tmp_path / "d"), "v", **options).collect()}
    alone = {}
    for aoi in ("p", "q"):
        alone[aoi] = pipelines.scan_and_detect(made.where(F.col("aoi") == aoi), inference.BASELINE, **options).count()
    assert totals == alone and min(totals.values()) > 0


@pytest.mark.parametrize("eps", [0.0, 1.0, 2.5, 5.0])
def test_clusters_equal_all_pairs(spark, eps):
    rng = random.Random(7)
    points = [(i, rng.randrange(60) / 2, rng.randrange(60) / 2, i % 2) for i in range(220)] + [(300 + i, 7.0, 7.0 + i % 3, 0) for i in range(90)]
    first = {p[0]: p[0] for p in points}
    for _ in range(40):
        for a in points:
            first[a[0]] = min(first[b[0]] for b in points if a[3] == b[3] and (a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2 <= eps * eps)
    df = spark.createDataFrame([(*p, 0.5) for p in points], "id long, x double, y double, g int, score double")
    assert {r["id"]: r["cluster"] for r in dedupe.cluster(df, eps, by="g").collect()} == first


def test_suppression_of_regions_by_shared_pixels(spark):
    rng = random.Random(5)
    shapes = {i: {(rng.randrange(6), rng.randrange(6)) for _ in range(rng.randrange(4, 25))} for i in range(30)}
    score = {i: rng.randrange(5) / 4 for i in shapes}
    kept = []
    for i in sorted(shapes, key=lambda i: (-score[i], i)):
        if all(len(shapes[i] & shapes[k]) < 0.4 * len(shapes[i] | shapes[k]) for k in kept):
            kept.append(i)
    cells = spark.createDataFrame([(i, 0, r, c) for i, s in shapes.items() for r, c in s], "id long, raster_id long, row int, col int")
    rated = spark.createDataFrame(list(score.items()), "id long, score double")
    assert sorted(r["id"] for r in dedupe.suppress_regions(rated, cells, 0.4).collect()) == sorted(kept)


def test_scene_crop_keeps_faults_and_clamps(spark):
    grids = [(1, "blue", 10.0, 0.0, 40.0, 4, 4), (1, "red", 20.0, 0.0, 40.0, 2, 2), (1, "nir", 10.0, 900.0, 40.0, 4, 4), (2, "red", 20.0, 0.0, 40.0, 2, 2)]
    pixels = [(1, b, r, c, float(10 * r + c)) for b, n in (("blue", 4), ("red", 2), ("nir", 4)) for r in range(n) for c in range(n)]
    stacked, faults = manifests.crop_scenes(
        spark.createDataFrame(pixels, "scene_id long, band string, row int, col int, value double"),
        spark.createDataFrame(grids, "scene_id long, band string, size double, left double, top double, height int, width int"),
        (11.0, -50.0, 99.0, 22.0), ("blue", "green", "red", "nir"),
    )
    got = {(r["scene_id"], r["row"], r["col"]): (r["blue"], r["green"], r["red"], r["nir"]) for r in stacked.collect()}
    assert got == {(1, r, c): (10.0 * (r + 2) + c + 1, None, 10.0 * ((r + 2) // 2) + (c + 1) // 2, None) for r in range(2) for c in range(3)}
    missing = {(r["scene_id"], r["band"], r["reason"]) for r in faults.collect()}
    assert missing == {(1, "nir", "no overlap"), (1, "green", "no such band"), (2, "red", "no pixels"), *[(2, b, "no such band") for b in ("blue", "green", "nir")]}


def test_label_arrays_and_block_headers(spark):
    labels = raster(spark, np.eye(6), value="label")
    tiles = {r["tile_id"]: r["labels"] for r in sinks.label_arrays(labels, 4, 2, 6, 6).collect()}
    assert tiles["tile_0_0"] == np.eye(4).ravel().tolist() and set(tiles) == {"tile_0_0", "tile_2_0", "tile_0_2", "tile_2_2"}
    blocks = manifests.pixels_to_blocks(manifests.synthetic_raster(spark, 8, 8), 4, affine=(10.0, 0.0, 5.0, 0.0, -10.0, 7.0), crs=32632)
    assert {(r["affine"]["a"], r["affine"]["f"], r["crs"]) for r in blocks.collect()} == {(10.0, 7.0, 32632)}
    assert manifests.read_window(blocks, 0, -2, 6, 4, 9, 4).count() == 2 * 2
    assert manifests.raster_size(manifests.synthetic_raster(spark, 8, 5)).first()[1:] == (8, 5)
    with pytest.raises(ValueError):
        manifests.read_window(blocks, 0, -4, 0, 4, 4)


def test_linear_fit_separates(spark):
    rows = spark.range(40).selectExpr("CAST(id >= 20 AS DOUBLE) AS label", *[f"{'id / 40.0D' if c == 'nir' else '0.0D'} AS {c}" for c in inference.CHANNELS])
    model = inference.fit_linear(rows, steps=60, rate=5.0)
    assert model.weights["nir"] > 1 and model.bias < 0
    with pytest.raises(ValueError):
        inference.LinearModel({"no": 1.0})


def test_streaming_composite(spark, tmp_path):
    from rastra.streaming import scenes

    schema = "raster_id long, row int, col int, scl int, ts timestamp, blue double"
    days = [("2024-01-01", 4, 1.0), ("2024-01-05", 4, 3.0), ("2024-01-06", 9, 99.0), ("2024-06-01", 4, 7.0), ("2024-12-01", 4, 8.0)]
    for i, (day, scl, v) in enumerate(days):
        df = spark.createDataFrame([(0, 0, 0, scl, v)], "raster_id long, row int, col int, scl int, blue double")
        df.withColumn("ts", F.to_timestamp(F.lit(day))).select(*[c.split()[0] for c in schema.split(", ")]).write.mode("append").parquet(str(tmp_path / "in"))
    stream = scenes.windowed_composite(scenes.read_looks(spark, str(tmp_path / "in"), schema), window="30 days", bands=("blue",))
    q = scenes.write_composite(stream, str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    assert 2.0 in {r["blue"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
