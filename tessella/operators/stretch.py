"""Percentile stretch of pixel bands to 8 bits, nodata masks and padded reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fewer valid pixels than this make a band black.
LEAST_VALID = 50


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def pixel_mask(bands: Column, nodata: Column | float | None) -> Column:
    """For each pixel whether it has no data, from an array of equally long bands.

    With a ``nodata`` value: some band equals it (a NaN value equals nothing); without one: some band
    is not finite.
    """
    first = F.element_at(bands, 1)
    if nodata is None:
        bad = lambda x: ~finite(x)
    else:
        value = nodata if isinstance(nodata, Column) else F.lit(float(nodata))
        bad = lambda x: F.coalesce((x == value) & ~F.isnan(value), F.lit(False))
    return F.transform(first, lambda _, i: F.exists(bands, lambda band: bad(F.get(band, i))))


def all_masked(mask: Column) -> Column:
    return F.forall(mask, lambda m: m)


def padded(pixels: Column, width: Column, height: Column, target: int | Column, fill: Column | float | None = None) -> Column:
    """A row-major band widened to a square of ``target`` pixels; new pixels are ``fill``, else 0."""
    side = target if isinstance(target, Column) else F.lit(target)
    value = F.coalesce(fill if isinstance(fill, Column) else F.lit(fill).cast("double"), F.lit(0.0))
    at = lambda k: (F.floor(k / side) * width + k % side).cast("int")
    return F.transform(F.sequence(F.lit(0), side * side - 1), lambda k: F.when((k % side < width) & (F.floor(k / side) < height), F.get(pixels, at(k)).cast("double")).otherwise(value))


def stretched(pixels: Column, mask: Column | None = None, low: float = 0.02, high: float = 0.98) -> Column:
    """``pixels`` between their percentiles ``low`` and ``high`` (linear) as integers 0 to 255, cut off, not rounded.

    Only finite, unmasked pixels count; others become 0. A band with fewer than LEAST_VALID valid
    pixels, or whose percentiles are less than 1e-6 apart, is 0 throughout.
    """
    pixels = F.transform(pixels, lambda x: x.cast("double"))
    ok = (lambda x, i: finite(x)) if mask is None else (lambda x, i: finite(x) & ~F.get(mask, i))
    sorted_valid = F.array_sort(F.filter(pixels, ok))
    n = F.size(sorted_valid)

    def body(v: Column) -> Column:
        lo, hi = _quantile(v, low), _quantile(v, high)
        flat = (F.size(v) < LEAST_VALID) | (hi - lo < F.lit(1e-6))
        scaled = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x - lo) / (hi - lo))) * F.lit(255.0)
        value = lambda x, i: F.when(ok(x, i), F.floor(scaled(x)).cast("int")).otherwise(F.lit(0))
        return F.when(flat, F.transform(pixels, lambda x: F.lit(0))).otherwise(F.transform(pixels, value))

    del n
    # The one-element array binds the sorted pixels, so they are sorted once a band.
    return F.element_at(F.transform(F.array(sorted_valid), body), 1)


def _quantile(v: Column, q: float) -> Column:
    """Linear interpolation between the neighbours of rank q*(n-1) of a sorted array; null if empty."""
    at = (F.size(v) - 1) * F.lit(q)
    low = F.floor(at).cast("int")
    a, b = F.get(v, low), F.get(v, F.least(low + 1, F.size(v) - 1))
    return a + (b - a) * (at - low)


def stretch_all(bands: Column, mask: Column | None = None) -> Column:
    """Each band of an array of bands stretched by itself; ``mask``: pixels that count in none."""
    return F.transform(bands, lambda band: stretched(band, mask))


def stretch_bands(df: DataFrame, pixels: str = "pixels", mask: str | None = None, out: str = "bytes") -> DataFrame:
    return df.withColumn(out, stretched(F.col(pixels), F.col(mask) if mask else None))
