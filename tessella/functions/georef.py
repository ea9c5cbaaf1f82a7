"""Affine georeferencing: pixels to map coordinates and back, rectangles as WKT and WKB."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from .boxes import Box


class Affine(NamedTuple):
    """x = a*col + b*row + c and y = d*col + e*row + f, of a pixel's upper left corner."""

    a: Column
    b: Column
    c: Column
    d: Column
    e: Column
    f: Column

    @classmethod
    def of(cls, prefix: str = "") -> Affine:
        return cls(*(F.col(f"{prefix}{n}") for n in "abcdef"))


def to_map(t: Affine, col: Column, row: Column) -> tuple[Column, Column]:
    return t.a * col + t.b * row + t.c, t.d * col + t.e * row + t.f


def box_to_map(t: Affine, b: Box) -> Box:
    """The map rectangle of a pixel box, its last column and row included, corners in order."""
    left, top = to_map(t, b.x1, b.y1)
    right, bottom = to_map(t, b.x2 + 1, b.y2 + 1)
    return Box(F.least(left, right), F.least(top, bottom), F.greatest(left, right), F.greatest(top, bottom))


def to_pixel(t: Affine, x: Column, y: Column) -> tuple[Column, Column]:
    """Column and row of the pixel that holds a map point."""
    det = t.a * t.e - t.b * t.d
    dx, dy = x - t.c, y - t.f
    return F.floor((t.e * dx - t.b * dy) / det), F.floor((t.a * dy - t.d * dx) / det)


def pixel_size(t: Affine) -> Column:
    """Mean of a pixel's width and height on the map."""
    return (F.abs(t.a) + F.abs(t.e)) / 2


def window_bounds(t: Affine, left: Column, top: Column, size: Column) -> Box:
    """Map bounds of a square window of pixels."""
    x1, y1 = to_map(t, left, top)
    x2, y2 = to_map(t, left + size, top + size)
    return Box(F.least(x1, x2), F.least(y1, y2), F.greatest(x1, x2), F.greatest(y1, y2))


def window_transform(t: Affine, left: Column, top: Column) -> Affine:
    """The transform of a window: its origin moved, all else as it was."""
    x, y = to_map(t, left, top)
    return Affine(t.a, t.b, x, t.d, t.e, y)


def _ring(b: Box) -> list[tuple[Column, Column]]:
    return [(b.x2, b.y1), (b.x2, b.y2), (b.x1, b.y2), (b.x1, b.y1), (b.x2, b.y1)]


def wkt(b: Box) -> Column:
    points = F.concat_ws(", ", *(F.concat_ws(" ", x.cast("string"), y.cast("string")) for x, y in _ring(b)))
    return F.concat(F.lit("POLYGON (("), points, F.lit("))"))


def _double_bits(c: Column) -> Column:
    """Eight bytes, most significant first, as 16 hex digits. Values are finite."""
    sign = F.when(c < 0, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
    size = F.abs(c)
    raw = F.when(size == 0, F.lit(0)).otherwise(F.floor(F.log2(size)).cast("int"))
    # log2 may round up to the next power of two; the fraction then says so.
    exact = F.when(size < F.pow(F.lit(2.0), raw), raw - 1).when(size >= F.pow(F.lit(2.0), raw + 1), raw + 1).otherwise(raw)
    fraction = ((size / F.pow(F.lit(2.0), exact) - 1) * F.lit(2.0**52)).cast("long")
    bits = F.when(size == 0, F.lit(0).cast("long")).otherwise(F.shiftleft((exact + 1023).cast("long"), 52) + fraction)
    return F.lpad(F.hex(bits.bitwiseOR(F.shiftleft(sign, 63))), 16, "0")


def wkb(b: Box) -> Column:
    """A polygon of one ring in well-known binary, big-endian."""
    head = F.lit("00" + "00000003" + "00000001" + "00000005")
    return F.unhex(F.concat(head, *(_double_bits(v) for p in _ring(b) for v in p)))
