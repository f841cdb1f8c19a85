"""JSON manifests, raster block tables, synthetic rasters and settings."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastra.functions.algebra import BANDS

AOI_SCHEMA = "description string, default_params struct<tile_size_px: int, gsd_m: int, composite_days: int, overlap_px: int>, aois array<struct<name: string, description: string, bbox: array<double>, priority: int>>"
SITE_SCHEMA = "description string, sites array<struct<name: string, lat: double, lon: double, country: string, buffer_km: double>>"
CHIP_SCHEMA = "tile_id string, path string, bbox array<double>, row_off int, col_off int, aoi string, split string, label_path string"
BLOCK_SCHEMA = "raster_id bigint, block_row int, block_col int, row_off int, col_off int, h int, w int, bands array<array<float>>, affine struct<a: double, b: double, c: double, d: double, e: double, f: double>, crs int"


def read_aois(spark: SparkSession, path: str) -> DataFrame:
    """One row an area, with its box in four columns."""
    rows = spark.read.schema(AOI_SCHEMA).json(path, multiLine=True).select(F.explode("aois").alias("a"))
    box = [F.get("a.bbox", F.lit(i)).alias(n) for i, n in enumerate(("xmin", "ymin", "xmax", "ymax"))]
    return rows.select("a.name", "a.description", *box, "a.priority")


def read_sites(spark: SparkSession, path: str, default_buffer_km: float = 2.0) -> DataFrame:
    """One row a known site; a site without a buffer gets the default."""
    rows = spark.read.schema(SITE_SCHEMA).json(path, multiLine=True).select(F.explode("sites").alias("s"))
    return rows.select("s.name", "s.lat", "s.lon", "s.country", F.coalesce("s.buffer_km", F.lit(default_buffer_km)).alias("buffer_km"))


def read_chips(spark: SparkSession, path: str) -> DataFrame:
    """A chip manifest: a JSON array, or JSON lines; a chip without a split is for training."""
    chips = spark.read.schema(CHIP_SCHEMA).json(path, multiLine=True)
    return chips.withColumn("split", F.coalesce("split", F.lit("train")))


def pixels_to_blocks(
    pixels: DataFrame, edge: int = 256, bands: tuple[str, ...] = BANDS, affine: tuple = (1.0, 0.0, 0.0, 0.0, -1.0, 0.0), crs: int | None = None
) -> DataFrame:
    """Pack a pixel table into blocks of ``edge`` x ``edge``, of ``BLOCK_SCHEMA``; a block is bounded, so is its row. Blocks must be full from their first row and column on."""
    cell = F.struct(F.expr("row * 1000000L + col").alias("at"), *[F.col(b).cast("float").alias(b) for b in bands])
    packed = pixels.groupBy(
        "raster_id", F.floor(F.col("row") / edge).cast("int").alias("block_row"), F.floor(F.col("col") / edge).cast("int").alias("block_col")
    ).agg(F.array_sort(F.collect_list(cell)).alias("cells"), F.max(F.pmod("row", F.lit(edge)) + 1).cast("int").alias("h"), F.max(F.pmod("col", F.lit(edge)) + 1).cast("int").alias("w"))
    arrays = F.array(*[F.col(f"cells.{b}") for b in bands])
    return packed.select(
        "raster_id", "block_row", "block_col", (F.col("block_row") * edge).alias("row_off"), (F.col("block_col") * edge).alias("col_off"), "h", "w", arrays.alias("bands"),
        F.struct(*[F.lit(float(v)).alias(n) for n, v in zip("abcdef", affine, strict=True)]).alias("affine"), F.lit(crs).cast("int").alias("crs"),
    )


def blocks_to_pixels(blocks: DataFrame, bands: tuple[str, ...] = BANDS) -> DataFrame:
    """Unpack full blocks into a pixel table."""
    at = blocks.select("raster_id", "row_off", "col_off", "w", F.posexplode(F.arrays_zip(*[F.col("bands")[i].alias(b) for i, b in enumerate(bands)])).alias("pos", "v"))
    return at.select(
        "raster_id",
        (F.col("row_off") + F.expr("pos DIV w")).cast("int").alias("row"),
        (F.col("col_off") + F.expr("pos % w")).cast("int").alias("col"),
        *[F.col(f"v.{b}").cast("double").alias(b) for b in bands],
    )


def read_window(blocks: DataFrame, raster_id: int, row: int, col: int, height: int, width: int, edge: int = 256) -> DataFrame:
    """Pixels of a window; only the blocks that it meets are read. A window without pixels is an error, one that reaches over the raster's edge is cut there."""
    if height <= 0 or width <= 0 or row + height <= 0 or col + width <= 0:
        raise ValueError("the window has no pixels")
    near = blocks.where(
        (F.col("raster_id") == raster_id)
        & F.col("block_row").between(max(row, 0) // edge, (row + height - 1) // edge)
        & F.col("block_col").between(max(col, 0) // edge, (col + width - 1) // edge)
    )
    return blocks_to_pixels(near).where(F.col("row").between(row, row + height - 1) & F.col("col").between(col, col + width - 1))


def crop_scenes(pixels: DataFrame, grids: DataFrame, box: tuple[float, float, float, float], bands: tuple[str, ...] = BANDS) -> tuple[DataFrame, DataFrame]:
    """Bands of scenes, each on a grid of its own, cut to a box and stacked on the grid of a scene's first band.

    ``pixels`` has ``scene_id, band, row, col, value`` and ``grids`` for each
    band of a scene ``size`` (of a pixel), ``left, top`` and ``height, width``.
    The box is clamped to the raster and rounded to whole pixels; further bands
    are sampled at the nearest pixel. Returns ``scene_id, row, col`` with the
    columns of ``bands``, null where a band has failed, and the faults:
    ``scene_id, band, reason``. A scene whose first band fails has the next one's grid; one without any has no rows.
    """
    west, south, east, north = box
    clamp = lambda v, hi: F.least(F.greatest(v, F.lit(0)), hi).cast("int")
    rank = F.array_position(F.array(*[F.lit(b) for b in bands]), F.col("band"))
    wanted = grids.where(F.col("band").isin(*bands)).withColumns(
        {
            "nth": rank,
            "c0": clamp(F.round((F.lit(west) - F.col("left")) / F.col("size")), F.col("width")),
            "c1": clamp(F.round((F.lit(east) - F.col("left")) / F.col("size")), F.col("width")),
            "r0": clamp(F.round((F.col("top") - F.lit(north)) / F.col("size")), F.col("height")),
            "r1": clamp(F.round((F.col("top") - F.lit(south)) / F.col("size")), F.col("height")),
        }
    )
    read = pixels.select("scene_id", "band").distinct().withColumn("read", F.lit(True))
    judged = wanted.join(read, ["scene_id", "band"], "left").withColumn(
        "reason", F.when((F.col("c1") <= F.col("c0")) | (F.col("r1") <= F.col("r0")), "no overlap").when(F.col("read").isNull(), "no pixels")
    )
    absent = grids.select("scene_id").distinct().withColumn("band", F.explode(F.array(*[F.lit(b) for b in bands]))).join(grids.select("scene_id", "band"), ["scene_id", "band"], "left_anti")
    faults = judged.where("reason IS NOT NULL").select("scene_id", "band", "reason").unionByName(absent.withColumn("reason", F.lit("no such band")))
    good = judged.where("reason IS NULL")
    base = good.groupBy("scene_id").agg(F.min_by(F.struct("size", "left", "top", "r0", "r1", "c0", "c1"), "nth").alias("base"))
    cells = base.withColumn("row", F.explode(F.sequence(F.lit(0), F.col("base.r1") - F.col("base.r0") - 1)))
    cells = cells.withColumn("col", F.explode(F.sequence(F.lit(0), F.col("base.c1") - F.col("base.c0") - 1)))
    x = F.col("base.left") + (F.col("base.c0") + F.col("col") + 0.5) * F.col("base.size")
    y = F.col("base.top") - (F.col("base.r0") + F.col("row") + 0.5) * F.col("base.size")
    placed = cells.join(good, "scene_id").select(
        "scene_id", "row", "col", "band",
        F.floor((F.col("top") - y) / F.col("size")).cast("int").alias("_r"), F.floor((x - F.col("left")) / F.col("size")).cast("int").alias("_c"),
    )
    source = pixels.select("scene_id", "band", F.col("row").alias("_r"), F.col("col").alias("_c"), "value")
    stacked = placed.join(source, ["scene_id", "band", "_r", "_c"], "left").groupBy("scene_id", "row", "col")
    return stacked.pivot("band", list(bands)).agg(F.first("value")), faults


def resample_nearest(pixels: DataFrame, height: int, width: int, out_height: int, out_width: int) -> DataFrame:
    """Nearest-neighbour resampling by index arithmetic: each output pixel takes the source pixel under its centre."""
    rows = F.transform(F.sequence(F.lit(0), F.lit(out_height - 1)), lambda i: F.struct(i.alias("o"), F.floor((i + 0.5) * height / out_height).alias("s")))
    cols = F.transform(F.sequence(F.lit(0), F.lit(out_width - 1)), lambda i: F.struct(i.alias("o"), F.floor((i + 0.5) * width / out_width).alias("s")))
    picked = pixels.withColumn("r", F.explode(F.filter(rows, lambda x: x["s"] == F.col("row")))).withColumn("c", F.explode(F.filter(cols, lambda x: x["s"] == F.col("col"))))
    return picked.withColumns({"row": F.col("r.o").cast("int"), "col": F.col("c.o").cast("int")}).drop("r", "c")


def synthetic_raster(spark: SparkSession, height: int, width: int, seed: int = 42, raster_id: int = 0, bands: tuple[str, ...] = BANDS) -> DataFrame:
    """Uniform integers in 0..9999 for each band, the same for the same seed on any cluster."""
    cells = spark.range(height * width)
    return cells.select(
        F.lit(raster_id).cast("long").alias("raster_id"),
        F.expr(f"CAST(id DIV {width} AS INT)").alias("row"),
        F.expr(f"CAST(id % {width} AS INT)").alias("col"),
        *[F.pmod(F.xxhash64("id", F.lit(k), F.lit(seed)), F.lit(10000)).cast("double").alias(b) for k, b in enumerate(bands)],
    )


def raster_size(pixels: DataFrame) -> DataFrame:
    """``raster_id, height, width``."""
    return pixels.groupBy("raster_id").agg((F.max("row") + 1).alias("height"), (F.max("col") + 1).alias("width"))


@dataclass(frozen=True)
class Settings:
    """Connection and path settings, each from an environment variable of the same name in capitals."""

    postgres_user: str = "postgres"
    postgres_password: str = "postgres"
    postgres_host: str = "localhost"
    postgres_port: int = 5432
    postgres_db: str = "rastra"
    warehouse: str = "warehouse"
    model_server: str = ""
    extra: dict = field(default_factory=dict)

    @classmethod
    def load(cls, env: dict[str, str] | None = None) -> Settings:
        env = dict(os.environ if env is None else env)
        known = {k: type(v.default)(env[k.upper()]) for k, v in cls.__dataclass_fields__.items() if k != "extra" and k.upper() in env}
        return cls(**known)

    @property
    def jdbc_url(self) -> str:
        return f"jdbc:postgresql://{self.postgres_host}:{self.postgres_port}/{self.postgres_db}"

    def read_jdbc(self, spark: SparkSession, table: str, column: str = "id", lower: int = 0, upper: int = 1 << 31, parts: int = 32) -> DataFrame:
        """A live table, read in ranges of its key."""
        options = {"url": self.jdbc_url, "dbtable": table, "user": self.postgres_user, "password": self.postgres_password}
        split = {"partitionColumn": column, "lowerBound": lower, "upperBound": upper, "numPartitions": parts}
        return spark.read.format("jdbc").options(**options, **split).load()
