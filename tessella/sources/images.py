"""Plain TIFF and PNG, written and read with the standard library: uint8 bands, no compression in TIFF."""

from __future__ import annotations

import struct
import zlib

import numpy as np

# Tags of the TIFF format used here.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIPS, SAMPLES, ROWS, COUNTS, PLANAR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284
PIXEL_SCALE, TIE_POINT, GEO_KEYS, NODATA = 33550, 33922, 34735, 42113
# The keys of a system's code.
GEOGRAPHIC, PROJECTED = 2048, 3072
SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 11: 4, 12: 8, 16: 8}


def _checked(chw: np.ndarray) -> np.ndarray:
    if chw.dtype != np.uint8 or chw.ndim != 3:
        raise ValueError("expected uint8 pixels as (bands, height, width)")
    return np.ascontiguousarray(chw)


def _directory(entries: list[tuple[int, int, bytes, int]], at: int, more: bool) -> bytes:
    """One image directory that stands at offset ``at``; values over four bytes follow it."""
    head = struct.pack("<H", len(entries))
    spill_at, spill = at + 2 + 12 * len(entries) + 4, b""
    for tag, kind, raw, n in sorted(entries):
        if len(raw) <= 4:
            value = raw.ljust(4, b"\0")
        else:
            value = struct.pack("<I", spill_at + len(spill))
            spill += raw + b"\0" * (len(raw) % 2)
        head += struct.pack("<HHI", tag, kind, n) + value
    end = spill_at + len(spill)
    return head + struct.pack("<I", end if more else 0) + spill


def _short(tag: int, *v: int) -> tuple[int, int, bytes, int]:
    return tag, 3, struct.pack(f"<{len(v)}H", *v), len(v)


def _long(tag: int, *v: int) -> tuple[int, int, bytes, int]:
    return tag, 4, struct.pack(f"<{len(v)}I", *v), len(v)


def _double(tag: int, *v: float) -> tuple[int, int, bytes, int]:
    return tag, 12, struct.pack(f"<{len(v)}d", *v), len(v)


def multipage_tiff(chw: np.ndarray) -> bytes:
    """One grey page per band."""
    chw = _checked(chw)
    bands, h, w = chw.shape
    out = bytearray(struct.pack("<2sHI", b"II", 42, 8 + bands * h * w))
    out += chw.tobytes()
    for k in range(bands):
        entries = [_long(WIDTH, w), _long(HEIGHT, h), _short(BITS, 8), _short(COMPRESSION, 1), _short(PHOTOMETRIC, 1), _long(STRIPS, 8 + k * h * w), _short(SAMPLES, 1), _long(ROWS, h), _long(COUNTS, h * w)]
        out += _directory(entries, len(out), k < bands - 1)
    return bytes(out)


def _geo_keys(epsg: int | None) -> list[int]:
    """The key directory: pixels are areas; the kind of system (2: degrees, 1: a plane) and its code."""
    keys = [(1025, 1)]
    if epsg:
        keys = [(1024, 2), (1025, 1), (GEOGRAPHIC, epsg)] if epsg == 4326 else [(1024, 1), (1025, 1), (PROJECTED, epsg)]
    return [1, 1, 0, len(keys), *(v for k, value in keys for v in (k, 0, 1, value))]


def geotiff(chw: np.ndarray, transform: tuple[float, float, float, float, float, float], nodata: float | None = None, epsg: int | None = None) -> bytes:
    """One page with a plane per band, georeferenced by scale and tie point (no rotation) and, if given, a system's EPSG code."""
    chw = _checked(chw)
    bands, h, w = chw.shape
    a, b, c, d, e, f = transform
    if b or d:
        raise ValueError("a rotated transform has no pixel scale")
    entries = [
        _long(WIDTH, w), _long(HEIGHT, h), _short(BITS, *[8] * bands), _short(COMPRESSION, 1), _short(PHOTOMETRIC, 1), _long(STRIPS, *(8 + k * h * w for k in range(bands))),
        _short(SAMPLES, bands), _long(ROWS, h), _long(COUNTS, *[h * w] * bands), _short(PLANAR, 2), _double(PIXEL_SCALE, a, -e, 0.0), _double(TIE_POINT, 0.0, 0.0, 0.0, c, f, 0.0),
        _short(GEO_KEYS, *_geo_keys(epsg))]
    if nodata is not None:
        text = f"{nodata:g}\0".encode()
        entries.append((NODATA, 2, text, len(text)))
    start = 8 + bands * h * w
    return struct.pack("<2sHI", b"II", 42, start) + chw.tobytes() + _directory(entries, start, False)


def _tags(data: bytes, at: int, order: str) -> tuple[dict[int, tuple], int]:
    (n,) = struct.unpack_from(f"{order}H", data, at)
    found = {}
    for k in range(n):
        tag, kind, count = struct.unpack_from(f"{order}HHI", data, at + 2 + 12 * k)
        size = SIZES.get(kind, 1) * count
        where = at + 2 + 12 * k + 8
        if size > 4:
            (where,) = struct.unpack_from(f"{order}I", data, where)
        letter = {1: "B", 2: "s", 3: "H", 4: "I", 11: "f", 12: "d", 16: "Q"}.get(kind)
        if letter == "s":
            found[tag] = (data[where : where + count].rstrip(b"\0"),)
        elif letter:
            found[tag] = struct.unpack_from(f"{order}{count}{letter}", data, where)
    (nxt,) = struct.unpack_from(f"{order}I", data, at + 2 + 12 * n)
    return found, nxt


def tiff_header(data: bytes) -> dict:
    """Size, band count, nodata and transform (None without georeference) of a TIFF's first page."""
    order = "<" if data[:2] == b"II" else ">"
    if data[:2] not in (b"II", b"MM"):
        raise ValueError("not a TIFF")
    at = struct.unpack_from(f"{order}I", data, 4)[0]
    tags, nxt = _tags(data, at, order)
    pages = 1
    while nxt:
        _, nxt = _tags(data, nxt, order)
        pages += 1
    scale, tie = tags.get(PIXEL_SCALE), tags.get(TIE_POINT)
    transform = None if not scale or not tie else (scale[0], 0.0, tie[3] - tie[0] * scale[0], 0.0, -scale[1], tie[4] + tie[1] * scale[1])
    nodata = tags.get(NODATA)
    return {"w": int(tags[WIDTH][0]), "h": int(tags[HEIGHT][0]), "bands": int(tags.get(SAMPLES, (1,))[0]) * pages, "transform": transform, "nodata": float(nodata[0]) if nodata else None}


def read_tiff(data: bytes) -> np.ndarray:
    """Pixels as (bands, height, width); 8-bit samples without compression, any page layout."""
    order = "<" if data[:2] == b"II" else ">"
    if data[:2] not in (b"II", b"MM"):
        raise ValueError("not a TIFF")
    at = struct.unpack_from(f"{order}I", data, 4)[0]
    planes = []
    while at:
        tags, at = _tags(data, at, order)
        if tags.get(COMPRESSION, (1,))[0] != 1 or set(tags.get(BITS, (8,))) != {8}:
            raise ValueError("only uncompressed 8-bit TIFF can be read here; plug in another decoder")
        w, h, n = int(tags[WIDTH][0]), int(tags[HEIGHT][0]), int(tags.get(SAMPLES, (1,))[0])
        raw = b"".join(data[o : o + c] for o, c in zip(tags[STRIPS], tags[COUNTS], strict=True))
        flat = np.frombuffer(raw, np.uint8)
        planes.append(flat.reshape(n, h, w) if tags.get(PLANAR, (1,))[0] == 2 or n == 1 else flat.reshape(h, w, n).transpose(2, 0, 1))
    return np.concatenate(planes)


def png(rgb: np.ndarray) -> bytes:
    """An RGB picture (height, width, 3)."""
    if rgb.dtype != np.uint8 or rgb.ndim != 3 or rgb.shape[2] != 3:
        raise ValueError("expected uint8 pixels as (height, width, 3)")
    h, w, _ = rgb.shape
    rows = np.hstack([np.zeros((h, 1), np.uint8), rgb.reshape(h, w * 3)]).tobytes()
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def read_png(data: bytes) -> np.ndarray:
    """Pixels as (height, width, 3): 8-bit grey, RGB or RGBA (alpha dropped), not interlaced."""
    at, body, head = 8, b"", None
    while at < len(data):
        n, kind = struct.unpack_from(">I4s", data, at)
        part = data[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"IDAT":
            body += part
        at += 12 + n
    if head is None or head[2] != 8 or head[3] not in (0, 2, 6) or head[6]:
        raise ValueError("only plain 8-bit PNG can be read here; plug in another decoder")
    w, h, n = head[0], head[1], {0: 1, 2: 3, 6: 4}[head[3]]
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, 1 + w * n)
    out = np.zeros((h, w * n), np.int64)
    for y in range(h):
        kind, line = raw[y, 0], raw[y, 1:].astype(np.int64)
        up = out[y - 1] if y else np.zeros(w * n, np.int64)
        if kind == 0:
            out[y] = line
        elif kind == 2:
            out[y] = (line + up) & 255
        else:
            for x in range(w * n):
                left, corner = (out[y, x - n], up[x - n]) if x >= n else (0, 0)
                if kind == 1:
                    guess = left
                elif kind == 3:
                    guess = (left + up[x]) // 2
                else:
                    p = left + up[x] - corner
                    guess = min((abs(p - left), 0, left), (abs(p - up[x]), 1, up[x]), (abs(p - corner), 2, corner))[2]
                out[y, x] = (line[x] + guess) & 255
    pixels = out.astype(np.uint8).reshape(h, w, n)
    return np.repeat(pixels, 3, axis=2) if n == 1 else pixels[:, :, :3]


def read_tile(name: str, data: bytes) -> np.ndarray:
    """A tile's pixels as (height, width, bands), by its name's extension; samples are cast to 8 bits, not scaled."""
    if name.lower().endswith((".tif", ".tiff")):
        from .rasters import Ranges, open_raster

        source = Ranges(name, data)
        r = open_raster(source)
        return np.stack([r.window(source, b + 1, 0, 0, r.width, r.height).astype(np.uint8) for b in range(r.bands)], axis=2)
    if name.lower().endswith(".png"):
        return read_png(data)
    raise ValueError(f"no decoder for {name}; plug in another")


# Figures of five rows by three columns, a row a digit of three bits.
GLYPHS = {"0": "75557", "1": "26227", "2": "71747", "3": "71717", "4": "55711", "5": "74717", "6": "74757", "7": "71111", "8": "75757", "9": "75717", ".": "00002", "-": "00700"}


def draw_text(rgb: np.ndarray, text: str, x: int, y: int, colour: tuple[int, int, int] = (0, 255, 0), scale: int = 2) -> None:
    """Write figures into the picture, their foot at ``y``; what falls outside is cut off, other signs are blank."""
    h, w, _ = rgb.shape
    for k, sign in enumerate(text):
        bits = np.array([[int(row) >> 2 & 1, int(row) >> 1 & 1, int(row) & 1] for row in GLYPHS.get(sign, "00000")], bool)
        rows, cols = np.nonzero(np.kron(bits, np.ones((scale, scale), bool)))
        rows, cols = rows + y - 5 * scale + 1, cols + x + 4 * scale * k
        inside = (rows >= 0) & (rows < h) & (cols >= 0) & (cols < w)
        rgb[rows[inside], cols[inside]] = colour


def draw_boxes(rgb: np.ndarray, boxes: list[tuple[int, int, int, int]], colour: tuple[int, int, int] = (0, 255, 0), thickness: int = 2) -> np.ndarray:
    """A copy with box outlines."""
    out = rgb.copy()
    h, w, _ = out.shape
    for x1, y1, x2, y2 in boxes:
        for k in range(-(thickness // 2), thickness - thickness // 2):
            for y in (y1 + k, y2 + k):
                if 0 <= y < h:
                    out[y, max(0, x1) : min(w, x2 + 1)] = colour
            for x in (x1 + k, x2 + k):
                if 0 <= x < w:
                    out[max(0, y1) : min(h, y2 + 1), x] = colour
    return out
