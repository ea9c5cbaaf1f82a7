"""Names of tiles and label lines, written and read."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what a tile's file name looks like.
TILE_NAME = r"(?i)tile_(?:([^_]+)_)?r(\d+)_c(\d+)\.(?:tif|tiff|png|jpg|jpeg)$"


def _four(number: Column) -> Column:
    """As the format %04d; the usual numbers without the cost of a format."""
    return F.when((number >= 0) & (number < 10_000), F.lpad(number.cast("string"), 4, "0")).otherwise(F.format_string("%04d", number))


def tile_row_id(image_id: Column, row: Column) -> Column:
    """What the names of a row of tiles begin with."""
    return F.concat(F.coalesce(image_id, F.lit("null")), F.lit("_r"), _four(row))


def tile_col_id(col: Column) -> Column:
    return F.concat(F.lit("_c"), _four(col))


def tile_id(image_id: Column, row: Column, col: Column) -> Column:
    return F.concat(tile_row_id(image_id, row), tile_col_id(col))


def tile_file(image_id: Column, row: Column, col: Column, extension: str = "tif") -> Column:
    return F.concat(F.lit("tile_"), tile_id(image_id, row, col), F.lit(f".{extension}"))


def parse_tile(name: Column) -> dict[str, Column]:
    """``image_id`` (null without one), ``tile_r`` and ``tile_c``; null where the name is no tile's."""
    good = name.rlike(TILE_NAME)
    part = lambda k: F.regexp_extract(name, TILE_NAME, k)
    prefix = F.when(good & (part(1) != ""), part(1))
    return {"image_id": prefix, "tile_r": F.when(good, part(2).cast("int")), "tile_c": F.when(good, part(3).cast("int"))}


def image_prefix(tile: Column) -> Column:
    """The image's name in a tile's: what stands before the first ``_r``, without ``tile_``; null for others."""
    good = tile.startswith("tile_") & tile.contains("_r")
    return F.when(good, F.replace(F.element_at(F.split(tile, "_r"), 1), F.lit("tile_"), F.lit("")))


def has_prefix(tile: Column, image_id: str) -> Column:
    """Whether a tile's name starts as those of ``image_id`` do (so do those of ids that extend it)."""
    return tile.startswith(f"tile_{image_id}_")


def label_line(class_id: Column, cx: Column, cy: Column, bw: Column, bh: Column) -> Column:
    """Class and shares, six decimals each, halves to even: as plain formatting of the doubles rounds them.

    A share whose seventh decimal is a five and the last has so few decimals that the decimal number
    is the double itself.
    """
    six = [F.bround(c.cast("decimal(20,15)"), 6).cast("decimal(12,6)").cast("string") for c in (cx, cy, bw, bh)]
    return F.concat_ws(" ", class_id.cast("string"), *six)
