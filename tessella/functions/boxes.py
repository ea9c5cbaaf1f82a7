"""Box arithmetic as column expressions: areas, overlaps, containment, coordinate moves."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# The guards against division by zero of the merge, export and evaluation steps.
EPS_AREA = 1e-9
EPS_EVAL = 1e-6


class Box(NamedTuple):
    """Corner coordinates; x runs right, y down."""

    x1: Column
    y1: Column
    x2: Column
    y2: Column

    @classmethod
    def of(cls, prefix: str = "", names: tuple[str, ...] = ("x1", "y1", "x2", "y2")) -> Box:
        return cls(*(F.col(f"{prefix}{n}") for n in names))

    def columns(self, names: tuple[str, ...] = ("x1", "y1", "x2", "y2")) -> list[Column]:
        return [c.alias(n) for c, n in zip(self, names, strict=True)]


def area(b: Box) -> Column:
    """Width times height, each zero at least."""
    return F.greatest(b.x2 - b.x1, F.lit(0.0)) * F.greatest(b.y2 - b.y1, F.lit(0.0))


def area_eps(b: Box) -> Column:
    return area(b) + F.lit(EPS_AREA)


def area_floored(b: Box) -> Column:
    """Plain width times height, EPS_AREA at least; for ordered corners."""
    return F.greatest((b.x2 - b.x1) * (b.y2 - b.y1), F.lit(EPS_AREA))


def ordered(b: Box) -> Box:
    """The same box with x1 <= x2 and y1 <= y2."""
    return Box(F.least(b.x1, b.x2), F.least(b.y1, b.y2), F.greatest(b.x1, b.x2), F.greatest(b.y1, b.y2))


def intersection(a: Box, b: Box) -> Column:
    width = F.least(a.x2, b.x2) - F.greatest(a.x1, b.x1)
    height = F.least(a.y2, b.y2) - F.greatest(a.y1, b.y1)
    return F.greatest(width, F.lit(0.0)) * F.greatest(height, F.lit(0.0))


def iou_merge(a: Box, b: Box) -> Column:
    """Intersection over union, the union grown by EPS_AREA."""
    inter = intersection(a, b)
    return inter / (area(a) + area(b) - inter + F.lit(EPS_AREA))


def iou_export(a: Box, b: Box) -> Column:
    """Intersection over union with areas and union EPS_AREA at least; for ordered corners."""
    inter = intersection(a, b)
    return inter / F.greatest(area_floored(a) + area_floored(b) - inter, F.lit(EPS_AREA))


def iou_eval(a: Box, b: Box) -> Column:
    """Intersection over union grown by EPS_EVAL; zero for boxes apart; areas may be negative."""
    left, top, right, bottom = F.greatest(a.x1, b.x1), F.greatest(a.y1, b.y1), F.least(a.x2, b.x2), F.least(a.y2, b.y2)
    inter = (right - left) * (bottom - top)
    own = lambda x: (x.x2 - x.x1) * (x.y2 - x.y1)
    return F.when((right < left) | (bottom < top), F.lit(0.0)).otherwise(inter / (own(a) + own(b) - inter + F.lit(EPS_EVAL)))


def coverage_merge(small: Box, big: Box) -> Column:
    """Share of ``small`` that ``big`` covers; the share's base grown by EPS_AREA."""
    return intersection(small, big) / area_eps(small)


def coverage_export(small: Box, big: Box) -> Column:
    """Share of ``small`` that ``big`` covers; the share's base EPS_AREA at least."""
    return intersection(small, big) / area_floored(small)


def nearly_inside(inner: Box, outer: Box, tolerance: float) -> Column:
    """Whether all edges of ``inner`` lie within ``outer`` grown by ``tolerance`` (edges included)."""
    tol = F.lit(float(tolerance))
    return (inner.x1 >= outer.x1 - tol) & (inner.y1 >= outer.y1 - tol) & (inner.x2 <= outer.x2 + tol) & (inner.y2 <= outer.y2 + tol)


def shifted(b: Box, dx: Column, dy: Column) -> Box:
    return Box(b.x1 + dx, b.y1 + dy, b.x2 + dx, b.y2 + dy)


def to_image(b: Box, row: Column, col: Column, stride: int | Column) -> Box:
    """Tile coordinates to those of the whole image."""
    step = stride if isinstance(stride, Column) else F.lit(stride)
    return shifted(b, col * step, row * step)


def to_tile(b: Box, row: Column, col: Column, stride: int | Column) -> Box:
    """Coordinates of the whole image to those of a tile."""
    step = stride if isinstance(stride, Column) else F.lit(stride)
    return shifted(b, -(col * step), -(row * step))


def clamped(b: Box, width: int, height: int) -> Box:
    """Rounded half to even, moved into the picture, corners put in order."""
    fit = lambda c, top: F.greatest(F.lit(0), F.least(F.bround(c).cast("int"), F.lit(top - 1)))
    return ordered(Box(fit(b.x1, width), fit(b.y1, height), fit(b.x2, width), fit(b.y2, height)))


def centred(b: Box, size: int | Column) -> list[Column]:
    """``cx, cy, bw, bh`` as shares of a square tile's side."""
    side = size if isinstance(size, Column) else F.lit(float(size))
    return [((b.x1 + b.x2) / 2 / side).alias("cx"), ((b.y1 + b.y2) / 2 / side).alias("cy"), ((b.x2 - b.x1) / side).alias("bw"), ((b.y2 - b.y1) / side).alias("bh")]


def size_class(b: Box, image_size: float = 512.0) -> Column:
    """small below a hundredth of the image's area, medium below a twenty-fifth, else large."""
    share = (b.x2 - b.x1) * (b.y2 - b.y1) / F.lit(float(image_size) * float(image_size))
    return F.when(share < 0.01, "small").when(share < 0.04, "medium").otherwise("large")


def confident(conf: Column, threshold: float) -> Column:
    """Confidence of ``threshold`` or more; NaN and null never are."""
    return (conf >= F.lit(float(threshold))) & ~F.isnan(conf)


def f1(precision: Column, recall: Column) -> Column:
    return F.lit(2.0) * precision * recall / (precision + recall + F.lit(EPS_EVAL))
