"""Benchmark of the sliding window over sizes, overlaps, batches and ways of scoring.

    spark-submit rastra/plans/matrix.py --sizes 1024,4096 --overlaps 0,64 --batches 1,16 --modes engine,arrow --output folder
"""

from __future__ import annotations

import argparse
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastra.functions.algebra import index_columns
from rastra.operators import evaluate, grid, inference, serving
from rastra.operators.composite import percentile_stretch
from rastra.operators.inference import CHANNELS
from rastra.sources import manifests

#: A row a configuration. ``batch`` is in tiles and null where the mode makes no calls, as are the latencies (milliseconds a call); ``error`` is null unless the configuration failed.
SCHEMA = (
    "mode string, raster string, height int, width int, tile int, overlap int, batch int, n_tiles long, seconds double, tiles_per_sec double, pixels_per_sec double, "
    "p50 double, p95 double, p99 double, error string"
)


@dataclass(frozen=True)
class LinearScorer:
    """The linear model as a function of arrays, to measure what leaving the engine costs."""

    weights: tuple[float, ...]
    bias: float

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        return rows @ np.array(self.weights, dtype=np.float32) + np.float32(self.bias)


def scorers(server: str | None = None, model: str = "baseline") -> dict[str, Callable[[np.ndarray], np.ndarray] | None]:
    """Ways of scoring by name: ``engine`` (an expression, no calls), ``arrow`` (a function of Arrow batches) and, where an address is given, ``server``."""
    base = inference.BASELINE
    ways = {"engine": None, "arrow": LinearScorer(tuple(base.weights.get(c, 0.0) for c in CHANNELS), base.bias)}
    return ways | {"server": serving.HttpScorer(server, model)} if server else ways


def call_times(rows: DataFrame, score: Callable[[np.ndarray], np.ndarray], size: int) -> DataFrame:
    """``n, ms``: a row for each call of the function with up to ``size`` rows of channels; the answers are thrown away."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sent = np.stack([batch[c].to_numpy(zero_copy_only=False).astype(np.float32) for c in CHANNELS], axis=1)
            counts, took = [], []
            for at in range(0, len(sent), size):
                began = time.perf_counter()
                score(sent[at : at + size])
                counts.append(len(sent[at : at + size]))
                took.append((time.perf_counter() - began) * 1000.0)
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64()), pa.array(took, pa.float64())], names=["n", "ms"])

    return rows.select(*CHANNELS).mapInArrow(run, "n long, ms double")


def measure(pixels: DataFrame, score: Callable[[np.ndarray], np.ndarray] | None, height: int, width: int, tile: int, overlap: int, batch: int | None) -> dict:
    """Time of one sliding window over all rasters of one size, and the latencies of the calls in a pass of its own.

    A call has at most ``batch`` tiles of rows; Arrow's batches are made that large for the time of the measurement.
    """
    spark, name = pixels.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    sizes = pixels.select("raster_id").distinct().withColumns({"height": F.lit(height), "width": F.lit(width)})
    n_tiles = grid.tile_windows(sizes, tile, overlap).count()
    before = spark.conf.get(name)
    try:
        model = inference.BASELINE
        if score is not None:
            rows = batch * tile * tile
            spark.conf.set(name, str(rows))
            model = serving.ServedModel(score, in_flight=1, rows_a_call=rows, pause=0.05)
        began = time.perf_counter()
        inference.sliding_window(pixels, model, tile, overlap, height, width).write.format("noop").mode("overwrite").save()
        seconds = time.perf_counter() - began
        found = {"n_tiles": n_tiles, "seconds": seconds, "tiles_per_sec": n_tiles / seconds, "pixels_per_sec": n_tiles * tile * tile / seconds}
        if score is not None:
            keys = ["raster_id", "row_off", "col_off"]
            channels = percentile_stretch(grid.to_tiles(pixels, tile, overlap, height, width), keys, small=True).withColumns(index_columns())
            found |= evaluate.latency_percentiles(call_times(channels, score, rows), "ms").first().asDict()
        return found
    finally:
        spark.conf.set(name, before)


def reason(failed: Exception) -> str:
    """The error of a failed job that a task's Python code raised, or else the failure's own first line."""
    raised = re.findall(r"^\w[\w.]*(?:Error|Exception): .*$", str(failed), re.MULTILINE)
    return raised[-1] if raised else f"{type(failed).__name__}: {str(failed).strip().partition(chr(10))[0]}"


def run_matrix(
    spark: SparkSession,
    ways: dict[str, Callable[[np.ndarray], np.ndarray] | None],
    sizes: tuple[int, ...] = (1024, 4096, 11000),
    overlaps: tuple[int, ...] = (0, 32, 64),
    batches: tuple[int, ...] = (1, 8, 16, 32),
    tile: int = 256,
    pixels: DataFrame | None = None,
) -> DataFrame:
    """Every combination of size, overlap, batch and mode, a row each; one that fails is a row with its error, and the others go on.

    Synthetic rasters unless ``pixels`` are given, whose size then takes the place of ``sizes``; rasters of several
    sizes are measured at each of them apart. A mode without calls is measured once for all batches.
    """
    if pixels is None:
        inputs = [(f"synthetic {n}", n, n, manifests.synthetic_raster(spark, n, n)) for n in sizes]
    else:
        known = manifests.raster_size(pixels)
        shapes = [(r["height"], r["width"]) for r in known.select("height", "width").distinct().orderBy("height", "width").toLocalIterator()]
        inputs = [("table", h, w, pixels.join(known.where((F.col("height") == h) & (F.col("width") == w)).select("raster_id"), "raster_id", "left_semi")) for h, w in shapes]
    rows = []
    for name, height, width, cells in inputs:
        for overlap in overlaps:
            for mode, score in ways.items():
                for batch in batches if score is not None else (None,):
                    row = {"mode": mode, "raster": name, "height": height, "width": width, "tile": tile, "overlap": overlap, "batch": batch}
                    try:
                        row |= measure(cells, score, height, width, tile, overlap, batch)
                    except Exception as failed:
                        row["error"] = reason(failed)
                    rows.append(row)
    return spark.createDataFrame(rows, SCHEMA)


def main(argv: list[str] | None = None) -> None:
    """Measure the matrix, write it as JSON lines and print it."""
    numbers = lambda text: tuple(int(x) for x in text.split(","))
    parser = argparse.ArgumentParser(prog="rastra-matrix")
    parser.add_argument("--table", help="pixels to measure instead of synthetic rasters")
    parser.add_argument("--sizes", type=numbers, default=(1024, 4096, 11000))
    parser.add_argument("--overlaps", type=numbers, default=(0, 32, 64))
    parser.add_argument("--batches", type=numbers, default=(1, 8, 16, 32), help="tiles a call")
    parser.add_argument("--modes", default="engine,arrow")
    parser.add_argument("--tile", type=int, default=256)
    parser.add_argument("--model-server", help="address of a model server, for the mode server")
    parser.add_argument("--model", default="baseline", help="name of the server's model")
    parser.add_argument("--output", required=True)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("rastra-matrix").getOrCreate()
    ways, wanted = scorers(args.model_server, args.model), args.modes.split(",")
    unknown = sorted(set(wanted) - set(ways))
    if unknown:
        raise ValueError(f"no such modes: {unknown}")
    pixels = spark.read.parquet(args.table) if args.table else None
    found = run_matrix(spark, {m: ways[m] for m in wanted}, args.sizes, args.overlaps, args.batches, args.tile, pixels)
    found.coalesce(1).write.mode("overwrite").json(args.output)
    found.orderBy("height", "width", "overlap", "mode", "batch").show(found.count(), truncate=60)


if __name__ == "__main__":
    main()
