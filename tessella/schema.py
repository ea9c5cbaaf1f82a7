"""Schemas of the tables that operators exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


_D, _I, _L, _S = T.DoubleType(), T.IntegerType(), T.LongType(), T.StringType()

#: A detection as its CSV holds it, in pixels of the whole image.
DETECTION = _struct(tile=_S, tile_r=_I, tile_c=_I, x1=_D, y1=_D, x2=_D, y2=_D, conf=_D, class_id=_I)
#: A label of a tile, in shares of its side.
LABEL = _struct(class_id=_I, cx=_D, cy=_D, bw=_D, bh=_D)
#: One row per raster: size, affine transform, projection tag.
RASTER = _struct(image_id=_S, path=_S, w=_I, h=_I, bands=_I, nodata=_D, a=_D, b=_D, c=_D, d=_D, e=_D, f=_D, crs=_S)
#: What scoring a tile leaves besides boxes.
SCORED = T.StructType([*DETECTION.fields, T.StructField("status", _S)])
RASTER_META = _struct(id=_S, raster=_S, crs=_S, raster_size_px=T.ArrayType(_I), pixel_size=T.ArrayType(_D), n_rows=_I, n_cols=_I, tiles_written=_L, tiles_skipped_all_nodata=_L)
TILES_META = T.StructType([T.StructField("inputs", T.ArrayType(RASTER_META)), *_struct(tile_size=_I, stride=_I, ms_bands_1_indexed=T.ArrayType(_I), rgb_bands_1_indexed=T.ArrayType(_I), skip_empty=T.BooleanType(), input_id=_S, raster=_S).fields])


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` itself, or an error that names what it lacks."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df
