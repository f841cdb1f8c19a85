"""Sliding-window inference over tiled rasters with a pluggable model."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rastra.functions.algebra import BANDS, INDICES, index_columns, sigmoid
from rastra.operators.composite import percentile_stretch
from rastra.operators.grid import fill_uncovered, overlap_average, to_tiles

CHANNELS = BANDS + INDICES


class Model(Protocol):
    """Adds ``logit`` to pixels of stretched tiles that have the ten channels."""

    def logits(self, rows: DataFrame) -> DataFrame: ...


class LinearModel:
    """Logistic regression on the ten channels, wholly in the engine."""

    def __init__(self, weights: dict[str, float], bias: float = 0.0):
        unknown = set(weights) - set(CHANNELS)
        if unknown:
            raise ValueError(f"no such channels: {sorted(unknown)}")
        self.weights, self.bias = weights, bias

    def logit(self) -> Column:
        return sum((F.col(c) * w for c, w in self.weights.items()), F.lit(self.bias))

    def logits(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("logit", self.logit())

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the weights as one line of JSON in the folder."""
        line = json.dumps({"kind": "linear", "weights": self.weights, "bias": self.bias})
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LinearModel:
        kept = json.loads(spark.read.text(path).first()["value"])
        if kept.get("kind") != "linear":
            raise ValueError(f"not a linear model: {path}")
        return cls(kept["weights"], kept["bias"])


class RemoteModel:
    """A function of Arrow batches, as for a remote model server."""

    def __init__(self, score: Callable[[np.ndarray], np.ndarray], channels: tuple[str, ...] = CHANNELS, attempts: int = 3, pause: float = 0.5):
        self.score, self.options = score, {"channels": channels, "attempts": attempts, "pause": pause}

    def logits(self, rows: DataFrame) -> DataFrame:
        return batch_score(rows, self.score, **self.options)


#: Weights of the deterministic model that the queries use.
BASELINE = LinearModel({"ndbi": 2.0, "bsi": 1.5, "ndvi": -1.0, "swir22": 1.0}, -0.5)


#: Models that can be asked for by name.
MODELS: dict[str, Model] = {"baseline": BASELINE}


def choose_model(spark: SparkSession, name: str) -> Model:
    """A registered model by name, or one that was saved in a folder."""
    from rastra.operators.convolution import ConvolutionalModel

    if name in MODELS:
        return MODELS[name]
    kind = json.loads(spark.read.text(name).first()["value"]).get("kind")
    return (ConvolutionalModel if kind == "convolutional" else LinearModel).load(spark, name)


def sliding_window(pixels: DataFrame, model: Model, tile: int = 256, overlap: int = 64, height: int = 0, width: int = 0) -> DataFrame:
    """Probability of each pixel: tiles are stretched one by one, scored, and averaged where they overlap.

    A pixel has another value in each tile, since a tile is stretched between
    its own percentiles. Pixels in no whole tile get 0.
    """
    keys = ["raster_id", "row_off", "col_off"]
    tiled = to_tiles(pixels, tile, overlap, height, width)
    channels = percentile_stretch(tiled, keys, small=True).withColumns(index_columns())
    scored = model.logits(channels).select("raster_id", "row", "col", sigmoid("logit").alias("prob"))
    return fill_uncovered(pixels, overlap_average(scored))


def batch_score(rows: DataFrame, score: Callable[[np.ndarray], np.ndarray], channels: tuple[str, ...] = CHANNELS, attempts: int = 3, pause: float = 0.5) -> DataFrame:
    """Adds ``logit`` from a function of Arrow batches, as for a remote model server.

    A failing call is tried again after a pause that doubles each time; the last
    failure ends the task, which Spark then repeats elsewhere.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for attempt in range(attempts):
                try:
                    logit = score(pdf[list(channels)].to_numpy(np.float32))
                    break
                except (OSError, TimeoutError):
                    if attempt == attempts - 1:
                        raise
                    time.sleep(pause * 2**attempt)
            yield pdf.assign(logit=logit.astype(np.float64))

    return rows.mapInPandas(run, rows.select("*", F.lit(0.0).alias("logit")).schema)


def fit_linear(rows: DataFrame, channels: tuple[str, ...] = CHANNELS, target: str = "label", steps: int = 25, rate: float = 1.0) -> LinearModel:
    """Logistic regression by gradient steps; each step is one aggregate over all rows, and only sums reach the driver."""
    w, b = dict.fromkeys(channels, 0.0), 0.0
    cached = rows.select(target, *channels).persist()
    try:
        for _ in range(steps):
            p = sigmoid(LinearModel(w, b).logit())
            miss = p - F.col(target)
            g = cached.agg(F.avg(miss).alias("_b"), *[F.avg(miss * F.col(c)).alias(c) for c in channels]).first()
            if g["_b"] is None:
                break
            b -= rate * g["_b"]
            w = {c: v - rate * g[c] for c, v in w.items()}
    finally:
        cached.unpersist()
    return LinearModel(w, b)


def fit_newton(rows: DataFrame, channels: tuple[str, ...] = CHANNELS, target: str = "label", steps: int = 25, ridge: float = 1e-4, tolerance: float = 1e-8) -> LinearModel:
    """Logistic regression by Newton steps: one aggregate a step gives loss, gradient and curvature at once, some eighty numbers.

    Minimises the mean log loss and ``ridge / 2`` times the squared weights (not the
    bias), which keeps the weights finite where the classes can be told apart. A
    step that makes the loss greater is halved; the fit ends after ``steps`` aggregates, or once a step would
    gain less than ``tolerance``. Rows with a null or NaN channel or target don't count; without any row all weights are 0.
    """
    names = [*channels, "_one"]
    fit = rows.select(F.col(target).cast("double").alias("_y"), *[F.col(c).cast("double").alias(c) for c in channels]).withColumn("_one", F.lit(1.0))
    fit = fit.where(" AND ".join(f"NOT isnan(`{c}`) AND `{c}` IS NOT NULL" for c in ("_y", *channels))).persist()
    penalty = np.array([ridge] * len(channels) + [0.0])
    kept, move, lowest, slope, bend = np.zeros(len(names)), np.zeros(len(names)), np.inf, None, None
    try:
        for _ in range(steps):
            at = kept + move
            z = LinearModel(dict(zip(channels, at.tolist())), float(at[-1])).logit()
            p = sigmoid(z)
            loss = F.greatest(z, F.lit(0.0)) - z * F.col("_y") + F.log1p(F.exp(-F.abs(z)))
            rated = fit.withColumns({"_loss": loss, "_miss": p - F.col("_y"), "_w": p * (1 - p)})
            pairs = [(a, b) for k, a in enumerate(names) for b in names[k:]]
            found = rated.agg(F.avg("_loss"), *[F.avg(F.col("_miss") * F.col(c)) for c in names], *[F.avg(F.col("_w") * F.col(a) * F.col(b)) for a, b in pairs]).first()
            if found[0] is None:
                break
            now = found[0] + float(penalty @ at**2) / 2
            if now > lowest:
                move = move / 2
                continue
            kept, lowest = at, now
            slope = np.array(found[1 : 1 + len(names)]) + penalty * kept
            bend = np.zeros((len(names), len(names)))
            bend[np.triu_indices(len(names))] = found[1 + len(names) :]
            bend = bend + np.triu(bend, 1).T + np.diag(penalty)
            move = -np.linalg.lstsq(bend, slope, rcond=None)[0]
            if -float(slope @ move) / 2 < tolerance:
                break
    finally:
        fit.unpersist()
    return LinearModel(dict(zip(channels, kept[:-1].tolist())), float(kept[-1]))
