"""Domain tables derived from the star-schema tables by integer arithmetic alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clumped detections in hundredths of a degree: one an order."""
    d = read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id",
        "(o_custkey * 7919) % 36000 - 18000 + (o_orderkey * 17) % 7 AS lon_c",
        "(o_custkey * 104729) % 18000 - 9000 + (o_orderkey * 31) % 7 AS lat_c",
        "(o_orderkey * 31337) % 1000 AS score_m",
        "(o_orderkey * 613) % 500 AS area_c",
        "1 + (o_orderkey * 17) % 50 AS half_c",
        "o_orderstatus AS model_version",
    )
    return d.selectExpr(
        "*",
        "lon_c - half_c AS xmin",
        "lat_c - half_c AS ymin",
        "lon_c + half_c AS xmax",
        "lat_c + half_c AS ymax",
        "score_m / 1000D AS score",
    )


def known_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier").join(read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return s.selectExpr(
        "s_suppkey AS site_id",
        "s_name AS name",
        "(s_suppkey * 7919) % 36000 - 18000 AS lon_c",
        "(s_suppkey * 104729) % 18000 - 9000 AS lat_c",
        "1 + s_suppkey % 5 AS buffer_km",
        "n_name AS country",
    )


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenes of two sensors; radar scenes have no cloud cover."""
    return read(spark, sf_dir, "events").selectExpr(
        "event_id AS scene_id",
        "CASE WHEN event_id % 5 = 0 THEN 'sentinel-1' ELSE 'sentinel-2' END AS sensor",
        "ts",
        "CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id * 37 % 100 END AS cloud_cover",
        "(user_id * 7919) % 340 - 170 AS xmin",
        "(user_id * 104729) % 160 - 80 AS ymin",
        "(user_id * 7919) % 340 - 170 + 2 AS xmax",
        "(user_id * 104729) % 160 - 80 + 2 AS ymax",
    )


def aois(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas of interest: a box of 20 by 20 degrees a nation."""
    return read(spark, sf_dir, "nation").selectExpr(
        "n_name AS name",
        "(n_nationkey * 53) % 320 - 160 AS xmin",
        "(n_nationkey * 31) % 140 - 70 AS ymin",
        "(n_nationkey * 53) % 320 - 140 AS xmax",
        "(n_nationkey * 31) % 140 - 50 AS ymax",
    )


#: Rows and columns of the derived raster.
EDGE = 64


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several looks at each pixel of one 64 x 64 raster, six bands and a scene class."""
    return read(spark, sf_dir, "lineitem").selectExpr(
        "CAST(0 AS BIGINT) AS raster_id",
        f"CAST(l_partkey % {EDGE} AS INT) AS row",
        f"CAST(l_suppkey % {EDGE} AS INT) AS col",
        "l_linenumber AS t",
        "CAST(l_orderkey % 97 AS DOUBLE) AS blue",
        "CAST((l_orderkey * 31) % 10000 AS DOUBLE) AS green",
        "CAST((l_orderkey * 17 + l_linenumber) % 10000 AS DOUBLE) AS red",
        "CAST((l_partkey * 13 + l_linenumber * 7) % 10000 AS DOUBLE) AS nir",
        "CAST((l_suppkey * 29 + l_orderkey) % 10000 AS DOUBLE) AS swir16",
        "CAST((l_orderkey * 7) % 10000 AS DOUBLE) AS swir22",
        "CAST((l_orderkey + l_linenumber) % 12 AS INT) AS scl",
    )


def chips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 x 8 rasters, one a vector: ``raster_id, row, col, value``."""
    e = read(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "x"))
    return e.selectExpr("vec_id AS raster_id", "CAST(pos DIV 8 AS INT) AS row", "CAST(pos % 8 AS INT) AS col", "CAST(x AS DOUBLE) AS value")


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stars of eight corners on whole numbers, on a map of 64 x 64, some with a hole; one a supplier."""
    s = read(spark, sf_dir, "supplier").selectExpr("s_suppkey AS id", "6 + s_suppkey * 29 % 52 AS cx", "6 + s_suppkey * 47 % 52 AS cy")
    ways = ((1, 0), (1, 1), (0, 1), (-1, 1), (-1, 0), (-1, -1), (0, -1), (1, -1))
    reach = lambda k: 2 + (F.col("id") * (k + 3) * 7) % 4
    point = lambda x, y: F.struct((F.col("cx") + x).cast("double").alias("x"), (F.col("cy") + y).cast("double").alias("y"))
    star = F.array(*[point(reach(k) * dx, reach(k) * dy) for k, (dx, dy) in enumerate(ways)])
    hole = F.array(point(F.lit(0), F.lit(1)), point(F.lit(1), F.lit(0)), point(F.lit(0), F.lit(-1)), point(F.lit(-1), F.lit(0)))
    return s.select("id", F.when(F.col("id") % 2 == 0, F.array(star, hole)).otherwise(F.array(star)).alias("rings"))
