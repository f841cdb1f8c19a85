"""Streaming composites: pixels of newly arriving scenes, averaged over sliding time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastra.functions.algebra import BANDS, is_clear, missing


def read_looks(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1000) -> DataFrame:
    """A stream of looks from a folder of Parquet files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def windowed_composite(looks: DataFrame, time: str = "ts", window: str = "90 days", slide: str | None = None, lateness: str = "10 days", bands: tuple[str, ...] = BANDS) -> DataFrame:
    """Mean of each band's clear looks a pixel and window; looks later than ``lateness`` are dropped by the watermark.

    The state is a sum and a count for each pixel of the open windows.
    """
    spans = F.window(time, window, slide) if slide else F.window(time, window)
    clear = looks.where(is_clear()).withWatermark(time, lateness)
    rows = clear.groupBy(spans.alias("span"), "raster_id", "row", "col").agg(*[F.avg(missing(b)).alias(b) for b in bands])
    return rows.select(F.col("span.start").alias("start"), F.col("span.end").alias("end"), "raster_id", "row", "col", *bands)


def write_composite(composite: DataFrame, path: str, checkpoint: str):
    """Append closed windows to a Parquet table, exactly once."""
    return composite.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start()
