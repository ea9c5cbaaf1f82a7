"""Profiles of layers and counters of stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def layer_profile(features: DataFrame, geom_type: Column, valid: Column, empty: Column, box: tuple[Column, Column, Column, Column], by: str = "layer") -> DataFrame:
    """``rows, invalid_geoms, empty_geoms, geom_types`` and bounds of each layer; the histogram is a map."""
    kinds = features.groupBy(by, geom_type.alias("_type")).agg(F.count("*").alias("n"), F.count_if(~valid).alias("bad"), F.count_if(empty).alias("none"), *(f(c).alias(n) for f, c, n in zip((F.min, F.min, F.max, F.max), box, ("minx", "miny", "maxx", "maxy"), strict=True)))
    types = F.map_from_entries(F.array_sort(F.collect_list(F.struct("_type", "n"))))
    return kinds.groupBy(by).agg(F.sum("n").alias("rows"), F.sum("bad").alias("invalid_geoms"), F.sum("none").alias("empty_geoms"), types.alias("geom_types"), F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"))


def status_counts(scored: DataFrame) -> DataFrame:
    """Tiles and boxes by status of the scoring."""
    return scored.groupBy("status").agg(F.count_distinct("tile").alias("tiles"), F.count("x1").alias("boxes"))


def distinct_tiles(df: DataFrame, tile: str = "tile") -> DataFrame:
    return df.select(tile).distinct().orderBy(tile)


def reduction_percent(before: Column, after: Column) -> Column:
    """How much of ``before`` is gone, in percent; zero of nothing."""
    return F.when(before > 0, F.lit(100.0) * (F.lit(1.0) - after / before)).otherwise(F.lit(0.0))
