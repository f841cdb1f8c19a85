"""Small graphs finished in one task, Newton steps, outlines of detections, the benchmark matrix."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rastra.functions.algebra import index_columns
from rastra.operators import dedupe, graph, inference, regions
from rastra.plans import matrix, pipelines
from rastra.sources import manifests


@pytest.mark.parametrize("small", [0, 40, 1 << 18])
def test_components_finished_at_any_size(spark, small):
    rnd = random.Random(small)
    edges = [(rnd.randrange(1 << 40), rnd.randrange(1 << 40)) for _ in range(30)]
    edges += [(a, b) for a, b in zip(range(100, 160), range(101, 161))] + [(7, 7), (9, 8), (8, 9), (None, 1)]
    edges += [(edges[k][0], edges[k + 1][1]) for k in range(0, 20, 2)]
    least = {}
    for a, b in edges:
        if a is not None:
            least.setdefault(a, a)
            least.setdefault(b, b)
    for _ in least:
        for a, b in edges:
            if a is not None:
                least[a] = least[b] = min(least[a], least[b])
    found = graph.connected_components(spark.createDataFrame(edges, "src long, dst long"), small=small)
    assert dict(found.collect()) == least


@pytest.mark.parametrize("small", [0, 25, 1 << 18])
def test_greedy_finished_at_any_size(spark, small):
    rnd = random.Random(3)
    rank = list(range(60))
    rnd.shuffle(rank)
    pairs = {tuple(sorted(rnd.sample(range(60), 2), key=lambda k: rank[k])) for _ in range(90)}
    gone = set()
    for k in sorted(range(60), key=lambda k: rank[k]):
        if any(hi not in gone for hi, lo in pairs if lo == k):
            gone.add(k)
    rows, over = spark.range(60), spark.createDataFrame(sorted(pairs), "hi long, lo long")
    assert {r["id"] for r in dedupe.greedy(rows, over, small=small).collect()} == set(range(60)) - gone
    assert dedupe.greedy(rows, over.limit(0), small=small).count() == 60


def test_a_long_chain_of_suppression():
    n = 200_001
    gone = dedupe.decide(np.arange(n - 1), np.arange(1, n))
    assert gone.tolist() == list(range(1, n, 2))


def test_newton_reaches_the_optimum(spark):
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(400, 2))
    y = (rnd.random(400) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] + 0.5)))).astype(float)
    rows = spark.createDataFrame([(float(l), *map(float, p)) for l, p in zip(y, x)] + [(1.0, float("nan"), 0.0), (1.0, None, 0.0), (None, 1.0, 1.0)], "label double, nir double, red double")
    model = inference.fit_newton(rows, ("nir", "red"), ridge=0.01)
    w = np.array([model.weights["nir"], model.weights["red"], model.bias])
    full = np.column_stack([x, np.ones(400)])
    slope = full.T @ (1 / (1 + np.exp(-full @ w)) - y) / 400 + np.array([0.01, 0.01, 0.0]) * w
    assert np.abs(slope).max() < 1e-4
    apart = rows.where("NOT isnan(nir) AND nir IS NOT NULL").withColumn("label", (F.col("nir") > 0).cast("double"))
    assert 1 < inference.fit_newton(apart, ("nir", "red")).weights["nir"] < 1e4
    empty = inference.fit_newton(rows.limit(0), ("nir", "red"))
    assert set(empty.weights.values()) == {0.0} and empty.bias == 0.0
    one = inference.fit_newton(rows.where("red = red").withColumn("red", F.lit(0.0)), ("nir", "red"))
    assert one.weights["red"] == 0.0


def test_detections_keep_the_outlines_that_their_regions_have(spark):
    pixels = manifests.synthetic_raster(spark, 32, 32)
    affine = (10.0, 0.0, 700.0, 0.0, -10.0, 900.0)
    plain = pipelines.scan_and_detect(pixels, inference.BASELINE, 16, 4, 32, 32, threshold=0.55, min_px=2, affine=affine, eps=1.0).collect()
    found = pipelines.scan_and_detect(pixels, inference.BASELINE, 16, 4, 32, 32, threshold=0.55, min_px=2, affine=affine, eps=1.0, outlines=True)
    assert [r["component"] for r in found.collect()] == [r["component"] for r in plain]
    for r in found.collect():
        def area(ring):
            return sum(q["x"] * p["y"] - p["x"] * q["y"] for p, q in zip(ring, ring[1:])) / 2

        assert abs(sum(map(area, r["rings"])) - r["area"]) < 1e-6
        xs, ys = [p["x"] for p in r["rings"][0]], [p["y"] for p in r["rings"][0]]
        assert (min(xs), min(ys), max(xs), max(ys)) == (r["xmin"], r["ymin"], r["xmax"], r["ymax"])
    one = spark.createDataFrame([(0, 5)], "raster_id long, component long")
    assert regions.add_outlines(one, one.limit(0).withColumns({"row": F.lit(0), "col": F.lit(0)})).first()["rings"] is None


class Broken:
    def __call__(self, rows):
        raise ValueError("no answer")


def test_matrix(spark, tmp_path):
    ways = matrix.scorers() | {"broken": Broken()}
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    rows = matrix.run_matrix(spark, ways, (32, 40), (0, 4), (1, 4), tile=16).collect()
    assert len(rows) == 2 * 2 * (1 + 2 + 2)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == batch
    for r in rows:
        assert (r["error"] is not None) == (r["mode"] == "broken")
        if r["mode"] == "broken":
            assert "no answer" in r["error"] and r["seconds"] is None
            continue
        step = 16 - r["overlap"]
        assert r["n_tiles"] == ((r["height"] - 16) // step + 1) ** 2 and r["tiles_per_sec"] > 0
        assert (r["p50"] is None) == (r["mode"] == "engine") and (r["batch"] is None) == (r["mode"] == "engine")
    pixels = manifests.synthetic_raster(spark, 32, 16)
    assert [(r["height"], r["width"]) for r in matrix.run_matrix(spark, {"engine": None}, overlaps=(0,), tile=16, pixels=pixels).collect()] == [(32, 16)]
    matrix.main(["--sizes", "16", "--overlaps", "0", "--batches", "1", "--modes", "engine,arrow", "--tile", "16", "--output", str(tmp_path / "m")])
    written = [json.loads(line) for f in (tmp_path / "m").glob("*.json") for line in f.read_text().splitlines()]
    assert {w["mode"] for w in written} == {"engine", "arrow"}
    with pytest.raises(ValueError):
        matrix.main(["--modes", "other", "--output", "x"])


def test_calls_are_counted(spark):
    rows = manifests.synthetic_raster(spark, 16, 16).withColumns(index_columns()).coalesce(1)
    calls = matrix.call_times(rows, matrix.scorers()["arrow"], 100).collect()
    assert [c["n"] for c in calls] == [100, 100, 56] and min(c["ms"] for c in calls) >= 0
