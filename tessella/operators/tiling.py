"""Tile grids over rasters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.naming import tile_col_id, tile_row_id
from ..storage import dealt_out

#: Rows of tiles that a task makes at once.
BAND = 16


def tile_size_from_ground(metres: float, pixel_size: Column) -> Column:
    """Tile side in pixels: the ground size, to the nearest multiple of 32 (half to even), 32 at least."""
    return F.greatest(F.lit(32), (F.bround(F.bround(F.lit(float(metres)) / pixel_size) / 32) * 32).cast("int"))


def checked_tile_size(pixels: int) -> int:
    """A tile side given in pixels: a positive multiple of 32."""
    if pixels <= 0 or pixels % 32:
        raise ValueError(f"tile_size_px must be positive and divisible by 32 (got {pixels})")
    return pixels


def stride_of(tile_size: int | Column, fraction: float) -> Column:
    """Pixels from one tile to the next: a share of the side, rounded half to even; one at least."""
    if not 0 < fraction <= 1:
        raise ValueError(f"stride_frac must be in (0, 1] (got {fraction})")
    side = tile_size if isinstance(tile_size, Column) else F.lit(tile_size)
    stride = F.bround(side * F.lit(float(fraction))).cast("int")
    return F.when(stride > 0, stride).otherwise(F.raise_error(F.lit("stride must be positive")).cast("int"))


def uniform_tiling(rasters: DataFrame, tile: str = "tile_size", stride: str = "stride") -> tuple[int, int]:
    """The tile side and stride that all rasters share; an error if they differ or there are none."""
    low, high = rasters.agg(F.min(F.struct(tile, stride)), F.max(F.struct(tile, stride))).first()
    if low is None or low != high:
        raise ValueError("all inputs must have the same tile size and stride")
    return low[tile], low[stride]


def tile_count(size: Column, tile: Column, stride: Column, cover: bool) -> Column:
    """Tiles along a side; ``cover``: up to the edge and beyond it. Zero or less where the side is too short."""
    steps = (size - tile) / stride
    return (F.ceil(steps) if cover else F.floor(steps)).cast("int") + 1


def tile_grid(rasters: DataFrame, tile_size: int, stride: int, cover_edges: bool, width: str = "w", height: str = "h", image_id: str = "image_id", carry: Sequence[str] = ()) -> DataFrame:
    """``(image_id, tile_r, tile_c, x0, y0, tile_id)`` and columns ``carry`` of the raster for each tile of each raster.

    Without ``cover_edges`` only whole tiles inside the raster count; with it the last row and column
    may reach beyond it (to be padded). A raster smaller than a tile by a stride or more gives none.
    A table of rasters is small and its grid large, so bands of rows are dealt to tasks before tiles are made.
    """
    step = F.lit(stride)
    bands = _shaped(rasters, tile_size, stride, cover_edges, width, height, F.col(image_id).alias("image_id"), *carry)
    bands = bands.withColumn("_first", F.explode(F.sequence(F.lit(0), F.col("_nr") - 1, F.lit(BAND))))
    bands = bands.repartition(dealt_out(rasters.sparkSession), "image_id", "_first")
    rows = bands.withColumn("tile_r", F.explode(F.sequence("_first", F.least(F.col("_first") + BAND, F.col("_nr")) - 1)))
    # What all tiles of a row share is made once.
    rows = rows.withColumn("_stem", tile_row_id(F.col("image_id"), F.col("tile_r")))
    cells = rows.withColumn("tile_c", F.explode(F.sequence(F.lit(0), F.col("_nc") - 1)))
    x0, y0 = (F.col("tile_c") * step).alias("x0"), (F.col("tile_r") * step).alias("y0")
    return cells.select("image_id", "tile_r", "tile_c", x0, y0, F.concat("_stem", tile_col_id(F.col("tile_c"))).alias("tile_id"), *carry)


def _shaped(rasters: DataFrame, tile_size: int, stride: int, cover_edges: bool, width: str, height: str, *columns: Column | str) -> DataFrame:
    """``columns`` and the tiles along the height ``_nr`` and the width ``_nc`` of rasters that have tiles."""
    nr, nc = (tile_count(F.col(n), F.lit(tile_size), F.lit(stride), cover_edges) for n in (height, width))
    return rasters.select(*columns, nr.alias("_nr"), nc.alias("_nc")).filter("_nr > 0 AND _nc > 0")


def grid_counts(rasters: DataFrame, tile_size: int, stride: int, cover_edges: bool, width: str = "w", height: str = "h") -> DataFrame:
    """``rasters`` that have tiles plus ``n_rows``, ``n_cols`` and ``tiles`` (long) of their grid."""
    made = _shaped(rasters, tile_size, stride, cover_edges, width, height, "*")
    return made.withColumn("tiles", F.col("_nr").cast("long") * F.col("_nc")).withColumnsRenamed({"_nr": "n_rows", "_nc": "n_cols"})


def grid_places(rasters: DataFrame, tile_size: int, stride: int, cover_edges: bool, width: str = "w", height: str = "h") -> DataFrame:
    """``(tile_r, tile_c)`` of all tiles of the grids, whatever the image: as many rows as the largest grids have."""
    widest = _shaped(rasters, tile_size, stride, cover_edges, width, height).groupBy("_nr").agg(F.max("_nc").alias("_nc"))
    rows = widest.select(F.explode(F.sequence(F.lit(0), F.col("_nr") - 1)).alias("tile_r"), "_nc").groupBy("tile_r").agg(F.max("_nc").alias("_nc"))
    return rows.select("tile_r", F.explode(F.sequence(F.lit(0), F.col("_nc") - 1)).alias("tile_c"))
