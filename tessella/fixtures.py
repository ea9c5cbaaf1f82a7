"""Derived tables: detections, rasters, features and pixels computed from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three overlapping boxes for each event, the third cut short."""
    e = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.expr("(event_id*7919)%4096 AS x0"), F.expr("(event_id*104729)%4096 AS y0"), F.expr("20+(event_id*31)%80 AS w"), F.expr("20+(event_id*17)%80 AS h"), F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("k"))
    return e.selectExpr(
        "event_id*3+k AS det_id", "concat('image', cast(user_id%4 AS string)) AS image_id",
        "cast(CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 ELSE 2 END AS int) AS class_id",
        "cast(x0+k*((event_id*13)%5) AS double) AS x1", "cast(y0+k*((event_id*11)%4) AS double) AS y1",
        "cast(x0+k*((event_id*13)%5)+CASE WHEN k=2 THEN w*3 div 5 ELSE w END AS double) AS x2",
        "cast(y0+k*((event_id*11)%4)+h AS double) AS y2",
        "cast((event_id*37+k*211)%1024 AS double)/1024D AS conf")


def tiled_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections with the tile (stride 64) their corner lies in, and its name."""
    d = detections(spark, sf_dir).withColumns({"tile_r": F.floor(F.col("y1") / 64).cast("int"), "tile_c": F.floor(F.col("x1") / 64).cast("int")})
    return d.withColumn("tile", F.format_string("tile_%s_r%04d_c%04d.tif", "image_id", "tile_r", "tile_c"))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = detections(spark, sf_dir).filter("det_id % 3 = 0 AND det_id % 9 <> 0")
    return d.select("image_id", "class_id", F.col("det_id").alias("gt_id"), "x1", "y1", "x2", "y2")


def rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "concat('image', cast(p_partkey AS string)) AS image_id", "cast(100+(p_partkey*997)%3900 AS int) AS w", "cast(100+(p_partkey*613)%3100 AS int) AS h",
        "10D AS a", "0D AS b", "cast(500000+p_partkey*50000 AS double) AS c", "0D AS d", "-10D AS e", "cast(9900000-p_partkey*50000 AS double) AS f")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = "(o_orderkey*7919)%3091", "(o_orderkey*104729)%2000"
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS feature_id", "concat('image', cast(o_orderkey%4 AS string)) AS image_id", f"cast({x} AS double) AS x1", f"cast({y} AS double) AS y1",
        f"cast({x}+8+(o_orderkey*31)%90 AS double) AS x2", f"cast({y}+8+(o_orderkey*17)%70 AS double) AS y2")


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as 8 by 8 pixel bands, four bands a tile."""
    return table(spark, sf_dir, "embeddings").selectExpr("vec_id div 4 AS tile_id", "cast(vec_id%4 AS int) AS band", "vec_id", "embedding AS pixels")


# The same tables in the oracle's dialect, as common table expressions.
DETECTIONS = """detections AS (
  SELECT event_id*3+k AS det_id, concat('image', cast(user_id%4 AS varchar)) AS image_id,
    cast(CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 ELSE 2 END AS int) AS class_id,
    cast(x0+k*((event_id*13)%5) AS double) AS x1, cast(y0+k*((event_id*11)%4) AS double) AS y1,
    cast(x0+k*((event_id*13)%5)+CASE WHEN k=2 THEN w*3//5 ELSE w END AS double) AS x2, cast(y0+k*((event_id*11)%4)+h AS double) AS y2,
    cast((event_id*37+k*211)%1024 AS double)/cast(1024 AS double) AS conf
  FROM (SELECT event_id, user_id, event_type, k, (event_id*7919)%4096 x0, (event_id*104729)%4096 y0, 20+(event_id*31)%80 w, 20+(event_id*17)%80 h
        FROM events CROSS JOIN (SELECT unnest([0,1,2]) k)))"""
TILED = DETECTIONS + """, tiled AS (
  SELECT *, printf('tile_%s_r%04d_c%04d.tif', image_id, tile_r, tile_c) AS tile
  FROM (SELECT *, cast(floor(y1/64) AS int) AS tile_r, cast(floor(x1/64) AS int) AS tile_c FROM detections))"""
TRUTH = DETECTIONS + """, truth AS (
  SELECT image_id, class_id, det_id AS gt_id, x1, y1, x2, y2 FROM detections WHERE det_id%3=0 AND det_id%9<>0)"""
RASTERS = """rasters AS (
  SELECT concat('image', cast(p_partkey AS varchar)) image_id, cast(100+(p_partkey*997)%3900 AS int) w, cast(100+(p_partkey*613)%3100 AS int) h,
    cast(10 AS double) a, cast(0 AS double) b, cast(500000+p_partkey*50000 AS double) c, cast(0 AS double) d, cast(-10 AS double) e,
    cast(9900000-p_partkey*50000 AS double) f
  FROM part)"""
TILES = RASTERS + """, tiles AS (
  SELECT image_id, tile_r, tile_c, tile_c*64 AS x0, tile_r*64 AS y0, printf('%s_r%04d_c%04d', image_id, tile_r, tile_c) AS tile_id
  FROM (SELECT image_id, nc, unnest(CASE WHEN nr>0 THEN range(nr) ELSE [] END)::int AS tile_r
        FROM (SELECT image_id, cast({way}((h-256)/cast(64 AS double)) AS int)+1 nr, cast({way}((w-256)/cast(64 AS double)) AS int)+1 nc FROM rasters)) x,
       LATERAL (SELECT unnest(CASE WHEN nc>0 THEN range(nc) ELSE [] END)::int AS tile_c))"""
FEATURES = """features AS (
  SELECT o_orderkey feature_id, concat('image', cast(o_orderkey%4 AS varchar)) image_id, cast((o_orderkey*7919)%3091 AS double) x1,
    cast((o_orderkey*104729)%2000 AS double) y1, cast((o_orderkey*7919)%3091+8+(o_orderkey*31)%90 AS double) x2,
    cast((o_orderkey*104729)%2000+8+(o_orderkey*17)%70 AS double) y2
  FROM orders)"""
PIXELS = "pixels AS (SELECT vec_id//4 AS tile_id, cast(vec_id%4 AS int) AS band, vec_id, embedding AS pixels FROM embeddings)"
