"""Vector features joined with tiles, clipped and turned into labels."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import boxes as bx
from ..functions.naming import tile_id
from . import tiling


def explode_parts(features: DataFrame, parts: str = "parts") -> DataFrame:
    """Multi-part geometries as one row a part; null geometries go, as do null parts."""
    return features.filter(F.col(parts).isNotNull()).withColumn(parts, F.explode(parts)).filter(F.col(parts).isNotNull())


def join_tiles(features: DataFrame, tiles: DataFrame, tile_size: int, stride: int, box: bx.Box | None = None, touching: bool = False) -> DataFrame:
    """Features (pixel boxes x1..y2 and ``image_id``) with each tile of their image that they meet.

    The grid is regular, so a feature's tiles are ranges of rows and columns: they are listed and
    equi-joined on (image, row, column), and no feature meets the tiles of other places. With
    ``touching`` a common edge or corner counts.
    """
    b = box or bx.Box.of()
    first, last = _span(tile_size, stride, touching)
    span = lambda low, high: F.explode(_steps(first(low), last(high)))
    places = features.withColumn("tile_r", span(b.y1, b.y2)).withColumn("tile_c", span(b.x1, b.x2))
    return places.join(tiles, ["image_id", "tile_r", "tile_c"])


def _span(tile_size: int, stride: int, touching: bool):
    """The first and the last row (or column) of tiles that a box meets, from its lower and its upper coordinate."""
    step, side = F.lit(float(stride)), F.lit(float(tile_size))
    if touching:
        return lambda low: F.greatest(F.ceil((low - side) / step), F.lit(0)), lambda high: F.floor(high / step)
    return lambda low: F.greatest(F.floor((low - side) / step) + 1, F.lit(0)), lambda high: F.ceil(high / step) - 1


def _steps(first: Column, last: Column) -> Column:
    return F.when(last >= first, F.sequence(first.cast("int"), last.cast("int"))).otherwise(F.array().cast("array<int>"))


def join_raster_tiles(features: DataFrame, rasters: DataFrame, tile_size: int, stride: int, cover_edges: bool = False, touching: bool = False) -> DataFrame:
    """What ``join_tiles`` gives for the whole grids of ``rasters``, without making the grids: only the
    tiles that features meet are ever listed, cut to the number of rows and columns of their raster."""
    n = {c: tiling.tile_count(F.col(c), F.lit(tile_size), F.lit(stride), cover_edges) for c in ("w", "h")}
    limits = rasters.select("image_id", n["h"].alias("_rows"), n["w"].alias("_cols"))
    first, last = _span(tile_size, stride, touching)
    along = lambda low, high, most: F.explode(_steps(first(low), F.least(last(high), most - 1)))
    b = bx.Box.of()
    placed = features.join(limits, "image_id").withColumn("tile_r", along(b.y1, b.y2, F.col("_rows"))).withColumn("tile_c", along(b.x1, b.x2, F.col("_cols")))
    x0, y0 = (F.col("tile_c") * stride).alias("x0"), (F.col("tile_r") * stride).alias("y0")
    return placed.select("image_id", "tile_r", "tile_c", *(c for c in features.columns if c != "image_id"), x0, y0, tile_id(F.col("image_id"), F.col("tile_r"), F.col("tile_c")).alias("tile_id"))


def clip_boxes(pairs: DataFrame, tile_size: int, orig_area: Column | None = None) -> DataFrame:
    """Adds the box inside the tile (``cx1`` to ``cy2``, pixels from the tile's corner) and ``area_fraction``.

    The fraction is that of the feature's own area; a feature without area counts its clipped one.
    """
    side = F.lit(float(tile_size))
    x0, y0 = F.col("x0").cast("double"), F.col("y0").cast("double")
    cut = bx.Box(F.greatest(F.col("x1"), x0), F.greatest(F.col("y1"), y0), F.least(F.col("x2"), x0 + side), F.least(F.col("y2"), y0 + side))
    own = orig_area if orig_area is not None else (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    area = bx.area(cut)
    moved = bx.shifted(cut, -x0, -y0)
    fraction = F.when(own > 0, area / own).otherwise(F.try_divide(area, area))
    return pairs.withColumns({"area_fraction": fraction} | dict(zip(("cx1", "cy1", "cx2", "cy2"), moved, strict=True)))


def pixel_labels(clipped: DataFrame, tile_size: int, min_area_fraction: float = 0.25, min_bbox_px: int = 4, class_id: int = 0) -> DataFrame:
    """Labels of the clipped boxes that are large enough: whole pixels, then shares of the tile.

    Gone: clips without area, fractions below ``min_area_fraction``, boxes that collapse, and boxes
    narrower or lower than ``min_bbox_px``. Corners are floored and held inside the tile first.
    """
    top = F.lit(tile_size - 1)
    fit = lambda c: F.greatest(F.lit(0), F.least(F.floor(F.col(c)).cast("int"), top))
    px = clipped.filter((F.col("area_fraction") > 0) & (F.col("area_fraction") >= F.lit(float(min_area_fraction)))).withColumns({n: fit(c) for n, c in zip(("px1", "py1", "px2", "py2"), ("cx1", "cy1", "cx2", "cy2"), strict=True)})
    w, h = F.col("px2") - F.col("px1"), F.col("py2") - F.col("py1")
    kept = px.filter((w > 0) & (h > 0) & (w >= min_bbox_px) & (h >= min_bbox_px))
    shares = bx.centred(bx.Box.of(names=("px1", "py1", "px2", "py2")), tile_size)
    names = ("cx", "cy", "bw", "bh")
    return kept.withColumn("label_class", F.lit(class_id)).withColumns(dict(zip(names, shares, strict=True)))


def split_counts(labels: DataFrame) -> DataFrame:
    """Tiles and labels written to each split."""
    return labels.groupBy("split").agg(F.count_distinct("image_id", "tile_r", "tile_c").alias("tiles_written"), F.count("*").alias("labels_written"))


def tiles_without_labels(hits: DataFrame, labels: DataFrame) -> int:
    """Tiles that features meet but in which no label survives."""
    key = ["image_id", "tile_r", "tile_c"]
    return hits.select(*key).distinct().join(labels.select(*key).distinct(), key, "left_anti").count()


# --- polygons --------------------------------------------------------------------------------------

RINGS = T.ArrayType(T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])))
CLIP = T.StructType([T.StructField(n, T.DoubleType()) for n in ("area", "minx", "miny", "maxx", "maxy")])


def ring_area(ring: Column) -> Column:
    """Signed area of a closed ring of points, by the shoelace sum."""
    turns = F.transform(F.sequence(F.lit(0), F.size(ring) - 2), lambda i: F.get(ring, i)["x"] * F.get(ring, i + 1)["y"] - F.get(ring, i + 1)["x"] * F.get(ring, i)["y"])
    return F.when(F.size(ring) < 3, F.lit(0.0)).otherwise(F.aggregate(turns, F.lit(0.0), lambda s, t: s + t) / 2)


def polygon_area(rings: Column) -> Column:
    """Area of the outer ring less those of the holes."""
    sizes = F.transform(rings, lambda r: F.abs(ring_area(r)))
    return F.element_at(sizes, 1) * 2 - F.aggregate(sizes, F.lit(0.0), lambda s, a: s + a)


def _ring_is_simple(p: np.ndarray) -> bool:
    """Closed, four points at least, and no two edges that cross or touch but neighbours at their corner."""
    if len(p) < 4 or not np.isfinite(p).all() or (p[0] != p[-1]).any():
        return False
    a, b = p[:-1], p[1:]
    n = len(a)
    cross = lambda o, u, v: (u[..., 0] - o[..., 0]) * (v[..., 1] - o[..., 1]) - (u[..., 1] - o[..., 1]) * (v[..., 0] - o[..., 0])
    for i in range(n - 1):
        j = np.arange(i + 1, n)
        j = j[(j != i + 1) & ~((i == 0) & (j == n - 1))]
        if not len(j):
            continue
        s1, s2 = np.sign(cross(a[i], b[i], a[j])), np.sign(cross(a[i], b[i], b[j]))
        s3, s4 = np.sign(cross(a[j], b[j], a[i][None])), np.sign(cross(a[j], b[j], b[i][None]))
        low, high = np.minimum(a[j], b[j]), np.maximum(a[j], b[j])
        meet = (low <= np.maximum(a[i], b[i])).all(axis=1) & (high >= np.minimum(a[i], b[i])).all(axis=1)
        if (meet & (s1 * s2 <= 0) & (s3 * s4 <= 0)).any():
            return False
    area = (a[:, 0] * b[:, 1] - b[:, 0] * a[:, 1]).sum()
    return bool(area != 0)


def _points(ring) -> np.ndarray:
    return np.array([(q["x"], q["y"]) for q in ring], float).reshape(-1, 2)


def _cut(points: np.ndarray, axis: int, bound: float, keep_below: bool) -> np.ndarray:
    """A ring cut by one side of the window."""
    if len(points) < 2:
        return points[:0]
    inside = points[:, axis] <= bound if keep_below else points[:, axis] >= bound
    out = []
    for p, q, pin, qin in zip(points, np.roll(points, -1, axis=0), inside, np.roll(inside, -1), strict=True):
        if pin:
            out.append(p)
        if pin != qin:
            t = (bound - p[axis]) / (q[axis] - p[axis])
            cross = p + t * (q - p)
            cross[axis] = bound
            out.append(cross)
    return np.array(out).reshape(-1, 2)


def _holds(ring: np.ndarray, x: float, y: float) -> bool:
    a, b = ring[:-1], ring[1:]
    over = (a[:, 1] > y) != (b[:, 1] > y)
    with np.errstate(divide="ignore", invalid="ignore"):
        at = a[:, 0] + (y - a[:, 1]) / (b[:, 1] - a[:, 1]) * (b[:, 0] - a[:, 0])
    return bool((over & (x < at)).sum() % 2)


def clip_rings(rings: list[np.ndarray], window: tuple[float, float, float, float]) -> tuple[float, float, float, float, float] | None:
    """Area and bounds of a polygon (outer ring, then holes) inside a window; None if they share no area.

    Bounds come from the outer ring's corners inside, its crossings with the window and the window's
    corners inside the polygon, as a cut concave ring may run along the window's edge where nothing is.
    """
    x1, y1, x2, y2 = window
    area = 0.0
    for k, ring in enumerate(rings):
        cut = ring[:-1]
        for axis, bound, below in ((0, x1, False), (0, x2, True), (1, y1, False), (1, y2, True)):
            cut = _cut(cut, axis, bound, below)
        if len(cut) >= 3:
            n = np.roll(cut, -1, axis=0)
            part = abs((cut[:, 0] * n[:, 1] - n[:, 0] * cut[:, 1]).sum()) / 2
            area += part if k == 0 else -part
    if area <= 0:
        return None
    outer = rings[0]
    spots = [p for p in outer if x1 <= p[0] <= x2 and y1 <= p[1] <= y2]
    for p, q in zip(outer[:-1], outer[1:], strict=True):
        for axis, bound in ((0, x1), (0, x2), (1, y1), (1, y2)):
            if p[axis] != q[axis] and 0 <= (t := (bound - p[axis]) / (q[axis] - p[axis])) <= 1:
                c = p + t * (q - p)
                c[axis] = bound
                if x1 <= c[0] <= x2 and y1 <= c[1] <= y2:
                    spots.append(c)
    spots += [np.array([x, y]) for x in (x1, x2) for y in (y1, y2) if _holds(outer, x, y)]
    s = np.array(spots)
    return (float(area), *map(float, s.min(axis=0)), *map(float, s.max(axis=0)))


def valid_polygon(rings: Column) -> Column:
    """Whether every ring is closed, has an area and meets itself nowhere."""

    def check(column: pd.Series) -> pd.Series:
        return column.map(lambda rings: rings is not None and len(rings) > 0 and all(_ring_is_simple(_points(r)) for r in rings))

    return F.pandas_udf(check, T.BooleanType())(rings)


def clip_polygon(rings: Column, window: bx.Box) -> Column:
    """``area, minx, miny, maxx, maxy`` of a polygon inside a window; null if they share no area."""
    def cut(rings: pd.Series, x1: pd.Series, y1: pd.Series, x2: pd.Series, y2: pd.Series) -> pd.DataFrame:
        found = [clip_rings([_points(r) for r in g], w) for g, *w in zip(rings, x1, y1, x2, y2, strict=True)]
        return pd.DataFrame([f or (None,) * 5 for f in found], columns=CLIP.names, dtype="float64")

    return F.pandas_udf(cut, CLIP)(rings, window.x1, window.y1, window.x2, window.y2)
