"""Percentile limits of groups of any size, by sketches and exactly, and ranks where one value lies far from all others."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rastra.operators import composite, evaluate


def groups():
    rng = np.random.default_rng(4)
    skewed = np.concatenate([rng.normal(size=5000), [1e12, -1e15]])
    tied = np.concatenate([np.zeros(3000), rng.random(500), np.full(900, 7.0)])
    return {0: skewed, 1: tied, 2: np.full(50, 2.5), 3: np.array([1.0]), 4: np.array([1.0, 2.0]), 5: rng.integers(0, 9, 4000).astype(float), 6: np.exp(rng.normal(size=3000) * 5), 7: np.array([np.nan] * 3)}


@pytest.mark.parametrize(("k", "sorted_"), [(composite.SKETCH_K, 4000), (256, 500), (64, 3000)])
def test_exact_limits(spark, monkeypatch, k, sorted_):
    """Small sketches and few sorted values make several passes, and small sketches with many sorted values brackets that may miss."""
    monkeypatch.setattr(composite, "SKETCH_K", k)
    monkeypatch.setattr(composite, "SKETCH_ERROR", 2.296 / k**0.9021 if k > 64 else 1e-4)
    monkeypatch.setattr(composite, "_SORTED", sorted_)
    df = spark.createDataFrame([(g, float(v), None if i % 2 else float(-v)) for g, vs in groups().items() for i, v in enumerate(vs)], "raster_id int, red double, nir double").repartition(4)
    found = {r["raster_id"]: r for r in composite.limits(df, ["raster_id"], ("red", "nir")).collect()}
    for g, vs in groups().items():
        if g == 7:
            assert found[g]["red_lo"] is None and found[g]["nir_hi"] is None
            continue
        for band, x in (("red", vs), ("nir", -vs[::2])):
            assert np.allclose([found[g][f"{band}_lo"], found[g][f"{band}_hi"]], np.percentile(x, [2, 98]), rtol=1e-12), (g, band)


def test_sketched_limits_are_within_the_error(spark):
    vs = {g: v for g, v in groups().items() if g in (0, 6)}
    df = spark.createDataFrame([(g, float(v)) for g, x in vs.items() for v in x], "raster_id int, red double").repartition(7)
    for r in composite.sketched_limits(df, ["raster_id"], ("red",)).collect():
        x = np.sort(vs[r["raster_id"]])
        for got, p in ((r["red_lo"], 0.02), (r["red_hi"], 0.98)):
            assert abs(np.searchsorted(x, got) / len(x) - p) <= 3 * composite.SKETCH_ERROR + 1 / len(x)


def test_no_window_in_the_plan_of_limits(spark, monkeypatch):
    monkeypatch.setattr(composite, "_SORTED", 500)
    df = spark.range(1000).select(F.lit(1).alias("raster_id"), F.rand(1).alias("red"))
    plan = composite.limits(df, ["raster_id"], ("red",))._jdf.queryExecution().toString()
    assert "Window" not in plan
    assert composite.limits(df.limit(0), ["raster_id"], ("red",)).collect() == []


def test_auroc_with_scores_far_away(spark):
    rng = np.random.default_rng(9)
    rows = [(float(s), float(t)) for s, t in zip(np.round(rng.normal(size=3000), 2), rng.random(3000) < 0.4, strict=True)] + [(1e18, 1.0), (-1e18, 0.0)]
    df = spark.createDataFrame(rows, "s double, target double")
    pos, neg = ([s for s, t in rows if t == k] for k in (1.0, 0.0))
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert math.isclose(evaluate.auroc(df, F.col("s")).first()[0], wins)
    assert evaluate.auroc(df.where("target = 1"), F.col("s")).first()[0] is None
    assert evaluate.auroc(df.limit(0), F.col("s")).first()[0] is None
