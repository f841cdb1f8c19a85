"""A small convolutional model that sees a pixel's surroundings, trained in the engine on tiles."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastra.operators.inference import CHANNELS
from rastra.storage import discard, settle

_TILE = ["raster_id", "row_off", "col_off"]


class Network:
    """Two 3 x 3 convolutions with rectifiers and a 1 x 1 one, over tiles ``(channels, rows, columns)``; beyond a tile's edges all is 0."""

    def __init__(self, channels: int, hidden: int = 8, seed: int = 7):
        rng = np.random.default_rng(seed)
        scale = lambda *shape: rng.normal(0, np.sqrt(2 / np.prod(shape[1:])), shape)
        self.parts = [scale(hidden, channels, 3, 3), np.zeros(hidden), scale(hidden, hidden, 3, 3), np.zeros(hidden), scale(1, hidden, 1, 1), np.zeros(1)]

    @property
    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts])

    @flat.setter
    def flat(self, values: np.ndarray) -> None:
        cuts = np.cumsum([p.size for p in self.parts])[:-1]
        self.parts = [v.reshape(p.shape) for v, p in zip(np.split(np.asarray(values, dtype=np.float64), cuts), self.parts, strict=True)]

    @staticmethod
    def _around(x: np.ndarray, k: int) -> np.ndarray:
        """The ``k`` x ``k`` surroundings of each pixel: ``(channels, k, k, rows, columns)``."""
        pad = k // 2
        wide = np.pad(x, ((0, 0), (pad, pad), (pad, pad)))
        return np.lib.stride_tricks.sliding_window_view(wide, x.shape[1:], axis=(1, 2))

    def logits(self, x: np.ndarray, kept: list | None = None) -> np.ndarray:
        for nth in range(0, 6, 2):
            w, b = self.parts[nth], self.parts[nth + 1]
            around = self._around(x, w.shape[2])
            out = np.tensordot(w, around, 3) + b[:, None, None]
            if kept is not None:
                kept.append((around, out))
            x = np.maximum(out, 0) if nth < 4 else out
        return x[0]

    def gradient(self, kept: list, slope: np.ndarray) -> np.ndarray:
        """Derivatives by all weights, from those by the logits of one tile; ``kept`` is what ``logits`` has left."""
        parts: list[np.ndarray] = []
        back = slope[None]
        for nth in (4, 2, 0):
            w, (around, out) = self.parts[nth], kept[nth // 2]
            if nth < 4:
                back = back * (out > 0)
            parts[:0] = [np.tensordot(back, around, ((1, 2), (3, 4))), back.sum((1, 2))]
            if nth:
                turned = w[:, :, ::-1, ::-1].transpose(1, 0, 2, 3)
                back = np.tensordot(turned, self._around(back, w.shape[2]), 3)
        return np.concatenate([p.ravel() for p in parts])


def tile_loss(z: np.ndarray, target: np.ndarray, alpha: float = 0.25, gamma: float = 2.0, smoothing: float = 0.05, dice_weight: float = 0.5, eps: float = 1e-6) -> tuple[float, np.ndarray]:
    """Mean focal loss of smoothed targets plus weighed dice loss of a tile, and its derivatives by the logits; a NaN target counts for nothing."""
    seen = ~np.isnan(target)
    n, y = max(1, int(seen.sum())), np.where(seen, target, 0.0)
    z = np.clip(z, -30, 30)
    p = 1 / (1 + np.exp(-z))
    t = y * (1 - smoothing) + 0.5 * smoothing
    bce, pt = np.logaddexp(0, z) - z * t, p * t + (1 - p) * (1 - t)
    at, slope = alpha * t + (1 - alpha) * (1 - t), p * (1 - p)
    focal = at * (1 - pt) ** gamma * bce
    by_focal = at * ((1 - pt) ** gamma * (p - t) - gamma * (1 - pt) ** (gamma - 1) * slope * (2 * t - 1) * bce)
    both, either = 2 * (p * y * seen).sum() + eps, (p * seen).sum() + y.sum() + eps
    by_dice = slope * (both - 2 * y * either) / either**2
    return float((focal * seen).sum() / n + dice_weight * (1 - both / either)), seen * (by_focal / n + dice_weight * by_dice)


def tile_arrays(tiled: DataFrame, edge: int, channels: tuple[str, ...] = CHANNELS, target: str = "label") -> DataFrame:
    """One row a tile (``raster_id, row_off, col_off``) with its channels and targets as arrays of floats; missing and undefined channels are 0, missing targets NaN."""
    value = lambda c, other: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(other)).cast("float")
    cell = ((F.col("row") - F.col("row_off")) * edge + F.col("col") - F.col("col_off")).alias("at")
    pixel = F.struct(cell, F.array(*[value(c, 0.0) for c in channels]).alias("x"), value(target, float("nan")).alias("y"))
    grouped = tiled.groupBy(*_TILE).agg(F.collect_list(pixel).alias("pixels"))  # a tile's size bounds its row
    return grouped.select(*_TILE, F.col("pixels.at").alias("at"), F.flatten("pixels.x").alias("x"), F.col("pixels.y").alias("y"))


def _dense(at: np.ndarray, x: np.ndarray, y: np.ndarray, channels: int, edge: int) -> tuple[np.ndarray, np.ndarray]:
    image, target = np.zeros((channels, edge * edge)), np.full(edge * edge, np.nan)
    image[:, at] = np.asarray(x, dtype=np.float64).reshape(-1, channels).T
    target[at] = y
    return image.reshape(channels, edge, edge), target.reshape(edge, edge)


def _sums(tiles: DataFrame, network: Network, channels: int, edge: int, learn: bool, loss: dict) -> tuple[np.ndarray, np.ndarray]:
    """Over all tiles: number, loss and counts of true and false ones, and the summed gradient. Tasks add up their own; one row a weight reaches the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tally, slope = np.zeros(5), np.zeros(network.flat.size if learn else 0)
        for pdf in batches:
            for at, x, y in zip(pdf["at"], pdf["x"], pdf["y"], strict=True):
                image, target = _dense(at, x, y, channels, edge)
                kept: list = []
                z = network.logits(image, kept)
                lost, by = tile_loss(z, target, **loss)
                said, true, seen = z > 0, target > 0.5, ~np.isnan(target)
                tally += (1, lost, (said & true).sum(), (said & ~true & seen).sum(), (~said & true).sum())
                if learn:
                    slope += network.gradient(kept, by)
        both = np.concatenate([tally, slope])
        yield pd.DataFrame({"k": np.arange(len(both)), "v": both})

    found = tiles.select("at", "x", "y").mapInPandas(run, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(5 + (network.flat.size if learn else 0))
    for r in found:
        out[r["k"]] = r["v"]
    return out[:5], out[5:]


class ConvolutionalModel:
    """Adds ``logit`` to pixels of tiles, each tile scored as a whole."""

    def __init__(self, network: Network, edge: int, channels: tuple[str, ...] = CHANNELS):
        self.network, self.edge, self.channels = network, edge, tuple(channels)

    def logits(self, rows: DataFrame) -> DataFrame:
        network, edge, channels = self.network, self.edge, list(self.channels)

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            at = ((pdf["row"] - pdf["row_off"]) * edge + pdf["col"] - pdf["col_off"]).to_numpy()
            x = np.nan_to_num(pdf[channels].to_numpy(np.float32, na_value=np.nan), nan=0.0)
            image, _ = _dense(at, x.ravel(), np.zeros(len(at)), len(channels), edge)
            return pdf.assign(logit=network.logits(image).ravel()[at])

        return rows.groupBy(*_TILE).applyInPandas(run, rows.select("*", F.lit(0.0).alias("logit")).schema)

    def save(self, spark: SparkSession, path: str) -> None:
        """Write weights and shape as one line of JSON in the folder."""
        line = json.dumps({"kind": "convolutional", "edge": self.edge, "channels": self.channels, "hidden": len(self.network.parts[1]), "weights": self.network.flat.tolist()})
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ConvolutionalModel:
        kept = json.loads(spark.read.text(path).first()["value"])
        if kept.get("kind") != "convolutional":
            raise ValueError(f"not a convolutional model: {path}")
        network = Network(len(kept["channels"]), kept["hidden"])
        network.flat = np.array(kept["weights"])
        return cls(network, kept["edge"], kept["channels"])


def fit_convolutional(
    tiled: DataFrame,
    edge: int,
    channels: tuple[str, ...] = CHANNELS,
    target: str = "label",
    hidden: int = 8,
    epochs: int = 40,
    batches: int = 4,
    rate: float = 0.01,
    held_out: int = 5,
    patience: int = 10,
    lr_patience: int = 5,
    factor: float = 0.5,
    seed: int = 7,
    **loss: float,
) -> tuple[ConvolutionalModel, DataFrame]:
    """Train on the pixels of tiles (``raster_id, row_off, col_off, row, col``, channels, target); the best model and its history.

    One of ``held_out`` tiles, by a hash of its key, validates. The others are
    ``batches`` parts; a step is one pass over a part, whose gradients are added
    up in each task before they are exchanged, and the driver holds the weights
    alone. The rate falls by ``factor`` after ``lr_patience`` epochs without a
    better validation loss, and training stops after ``patience``. History:
    ``epoch, train_loss, val_loss, precision, recall, f1, rate``. Tiles of
    overlapping windows share pixels with their neighbours, so tiles to learn
    from should not overlap. Without tiles to validate the training loss
    decides; without any tiles the weights stay as they were drawn.
    """
    if epochs < 1 or batches < 1 or held_out < 2:
        raise ValueError("epochs and batches must be positive, held_out above 1")
    spark = tiled.sparkSession
    h = F.pmod(F.xxhash64(F.lit(seed), *_TILE), F.lit(held_out * batches))
    tiles = settle(tile_arrays(tiled, edge, channels, target).withColumn("part", F.when(h % held_out == 0, F.lit(-1)).otherwise(F.floor(h / held_out)).cast("int")), "training_tiles")
    network, n = Network(len(channels), hidden, seed), len(channels)
    at, mean, square, best, stale, steps = network.flat, 0.0, 0.0, (np.inf, network.flat), 0, 0
    history = []
    for epoch in range(epochs):
        total = np.zeros(5)
        for part in range(batches):
            tally, slope = _sums(tiles.where(F.col("part") == part), network, n, edge, True, loss)
            total += tally
            if not tally[0]:
                continue
            steps += 1
            slope = slope / tally[0]
            mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
            at = at - rate * (mean / (1 - 0.9**steps)) / (np.sqrt(square / (1 - 0.999**steps)) + 1e-8)
            network.flat = at
        val, _ = _sums(tiles.where("part = -1"), network, n, edge, False, loss)
        shown = val if val[0] else total
        lost, (tp, fp, fn) = shown[1] / max(shown[0], 1.0), shown[2:]
        ratio = lambda a, b: float(a / b) if b else 0.0
        history.append((epoch, float(total[1] / max(total[0], 1.0)), float(lost), ratio(tp, tp + fp), ratio(tp, tp + fn), ratio(2 * tp, 2 * tp + fp + fn), float(rate)))
        best, stale = ((lost, at), 0) if lost < best[0] else (best, stale + 1)
        if stale >= patience or not shown[0]:
            break
        if stale and stale % (lr_patience + 1) == 0:
            rate *= factor
    network.flat = best[1]
    discard(tiles)
    return ConvolutionalModel(network, edge, channels), spark.createDataFrame(history, "epoch int, train_loss double, val_loss double, precision double, recall double, f1 double, rate double")
