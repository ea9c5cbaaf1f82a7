"""The chains of operators that users run as one: merge, export, dataset building, drawing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import boxes as bx
from ..functions import georef
from ..operators import labels, split
from ..operators.suppress import cut_boxes, duplicates, nested, nms, suppress


def georeference(detections: DataFrame, rasters: DataFrame) -> DataFrame:
    """Map rectangles of detections whose image is among ``rasters``; others are left out.

    One row per raster is needed; Spark broadcasts it while it is small and joins by key when not.
    """
    t = rasters.select("image_id", *(F.col(c).alias(f"t_{c}") for c in "abcdef"))
    joined = detections.join(t, "image_id")
    box = georef.box_to_map(georef.Affine.of("t_"), bx.Box.of())
    return joined.withColumns(dict(zip(("minx", "miny", "maxx", "maxy"), box, strict=True))).drop(*(f"t_{c}" for c in "abcdef"))


def images_without_raster(detections: DataFrame, rasters: DataFrame) -> DataFrame:
    """How many detections each image has that no raster is known for."""
    return detections.join(rasters.select("image_id"), "image_id", "left_anti").groupBy("image_id").agg(F.count("*").alias("n"))


def merge_detections(detections: DataFrame, min_conf: float = 0.0, nms_iou: float = 0.30, coverage: float = 0.85, tolerance: float = 3.0, margin: float = 0.0, keys: Sequence[str] = ("image_id", "class_id"), strategy: str = "auto") -> DataFrame:
    """Confidence filter (above zero only), then non-maximum, then nested suppression per image and class."""
    chosen = detections.filter(bx.confident(F.col("conf"), min_conf)) if min_conf > 0 else detections
    return suppress(suppress(chosen, nms(nms_iou), keys, strategy=strategy), nested(coverage, tolerance, margin), keys, strategy=strategy)


def export_detections(detections: DataFrame, min_conf: float = 0.25, dedup: bool = True, by_class: bool = False, coverage: float = 0.90, tolerance: float = 3.0, dup_iou: float = 0.90, strategy: str = "auto") -> DataFrame:
    """Confidence filter, then cut boxes, then duplicates; per image, or per image and class."""
    chosen = detections.filter(bx.confident(F.col("conf"), min_conf))
    if not dedup:
        return chosen
    keys = ("image_id", "class_id") if by_class else ("image_id",)
    return suppress(suppress(chosen, cut_boxes(coverage, tolerance), keys, strategy=strategy), duplicates(dup_iou), keys, strategy=strategy)


def build_labels(features: DataFrame, rasters: DataFrame, tile_size: int, stride: int, ratios: dict[str, float], seed: int = 42, block_tiles: int | Column = 4, min_area_fraction: float = 0.25, min_bbox_px: int = 4, class_id: int = 0) -> DataFrame:
    """Labels of every whole tile with its split: the tiles met, split, clip, filter, shares."""
    hits = labels.join_raster_tiles(features, rasters, tile_size, stride)
    placed = split.without_empty_splits(split.with_split(hits, ratios, seed, block_tiles), ratios)
    return labels.pixel_labels(labels.clip_boxes(placed, tile_size), tile_size, min_area_fraction, min_bbox_px, class_id)


def draw_list(detections: DataFrame, stride: int, width: int, height: int, min_conf: float = 0.25) -> DataFrame:
    """Rectangles and captions to draw on each tile: local pixels, held inside the tile."""
    chosen = detections.filter(bx.confident(F.col("conf"), min_conf))
    local = bx.clamped(bx.to_tile(bx.Box.of(), F.col("tile_r"), F.col("tile_c"), stride), width, height)
    out = chosen.select(*detections.columns, *local.columns(("dx1", "dy1", "dx2", "dy2")))
    return out.withColumns({"caption": F.format_string("%.2f", "conf"), "text_x": F.col("dx1"), "text_y": F.greatest(F.lit(0), F.col("dy1") - 5)})
