"""Coordinates between longitude and latitude, the UTM zones and web Mercator, as column expressions (WGS 84)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ellipsoid and the scale and offsets of the UTM grid.
AXIS, FLATTENING = 6378137.0, 1 / 298.257223563
SCALE, EAST, SOUTH = 0.9996, 500000.0, 10000000.0

_N = FLATTENING / (2 - FLATTENING)
_RADIUS = AXIS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_E = 2 * math.sqrt(_N) / (1 + _N)
# The series of the transverse Mercator projection to the third power of the flattening.
TO_GRID = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
FROM_GRID = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
TO_LATITUDE = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)


def _zone(epsg: int) -> tuple[float, float]:
    """Middle meridian in degrees and false northing of a UTM zone's code."""
    north, south = 32601 <= epsg <= 32660, 32701 <= epsg <= 32760
    if not north and not south:
        raise ValueError(f"EPSG:{epsg} is not among those that can be converted; reproject the layer first")
    return 6.0 * (epsg % 100) - 183, SOUTH if south else 0.0


def _series(start: Column, factors: tuple[float, ...], term) -> Column:
    for j, f in enumerate(factors, 1):
        start = start + F.lit(f) * term(2 * j)
    return start


def to_lonlat(x: Column, y: Column, epsg: int) -> tuple[Column, Column]:
    """Longitude and latitude in degrees of coordinates in the system ``epsg``."""
    if epsg == 4326:
        return x, y
    if epsg == 3857:
        return F.degrees(x / AXIS), F.degrees(F.atan(F.sinh(y / AXIS)))
    middle, north = _zone(epsg)
    xi, eta = (y - north) / (SCALE * _RADIUS), (x - EAST) / (SCALE * _RADIUS)
    less = tuple(-f for f in FROM_GRID)
    u = _series(xi, less, lambda k: F.sin(xi * k) * F.cosh(eta * k))
    v = _series(eta, less, lambda k: F.cos(xi * k) * F.sinh(eta * k))
    chi = F.asin(F.sin(u) / F.cosh(v))
    return F.lit(middle) + F.degrees(F.atan2(F.sinh(v), F.cos(u))), F.degrees(_series(chi, TO_LATITUDE, lambda k: F.sin(chi * k)))


def from_lonlat(lon: Column, lat: Column, epsg: int) -> tuple[Column, Column]:
    """Coordinates in the system ``epsg`` of longitude and latitude in degrees."""
    if epsg == 4326:
        return lon, lat
    if epsg == 3857:
        return F.radians(lon) * AXIS, F.asinh(F.tan(F.radians(lat))) * AXIS
    middle, north = _zone(epsg)
    phi, away = F.radians(lat), F.radians(lon - middle)
    t = F.sinh(F.atanh(F.sin(phi)) - F.atanh(F.sin(phi) * _E) * _E)
    u, v = F.atan2(t, F.cos(away)), F.atanh(F.sin(away) / F.sqrt(t * t + 1))
    east = _series(v, TO_GRID, lambda k: F.cos(u * k) * F.sinh(v * k))
    rise = _series(u, TO_GRID, lambda k: F.sin(u * k) * F.cosh(v * k))
    return east * (SCALE * _RADIUS) + EAST, rise * (SCALE * _RADIUS) + north


def reproject(x: Column, y: Column, source: int, target: int) -> tuple[Column, Column]:
    """Coordinates of the system ``source`` in ``target``: EPSG 4326, 3857 or a UTM zone's (326zz, 327zz)."""
    return (x, y) if source == target else from_lonlat(*to_lonlat(x, y, source), target)


def code_of(name: str | None) -> int | None:
    """The number in "EPSG:n"; None for other names."""
    kind, _, number = (name or "").partition(":")
    return int(number) if kind.upper() == "EPSG" and number.isdigit() else None
