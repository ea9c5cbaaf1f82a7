"""Rasters read by byte ranges: headers and windows of bands, without the rest of the file."""

from __future__ import annotations

import io
import math
import struct
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import RASTER
from .images import BITS, COMPRESSION, COUNTS, GEO_KEYS, GEOGRAPHIC, HEIGHT, NODATA, PIXEL_SCALE, PLANAR, PROJECTED, ROWS, SAMPLES, SIZES, STRIPS, TIE_POINT, WIDTH

# The TIFF tags of sample formats, predictors and tiles, the codes of compressions, and LZW's control codes.
FORMAT, PREDICTOR = 339, 317
TILE_WIDTH, TILE_HEIGHT, TILES, TILE_COUNTS = 322, 323, 324, 325
PLAIN, LZW, DEFLATED = 1, 5, (8, 32946)
CLEAR, END = 256, 257
LETTERS = {1: "B", 2: "s", 3: "H", 4: "I", 11: "f", 12: "d", 16: "Q"}
#: A read may take so many times the bytes that are needed, to spare a read per row.
SLACK = 4


class Ranges:
    """Bytes of a file by offset, from a mounted path, any store that Arrow opens by its URI, or memory."""

    def __init__(self, path: str, content: bytes | None = None):
        self.path = path
        if content is not None:
            self.file = io.BytesIO(content)
        elif path.startswith("file:") or "://" not in path:
            self.file = open(path.removeprefix("file://").removeprefix("file:"), "rb")  # noqa: SIM115
        else:
            from pyarrow.fs import FileSystem

            store, inner = FileSystem.from_uri(path)
            self.file = store.open_input_file(inner)

    def at(self, offset: int, size: int) -> bytes:
        self.file.seek(offset)
        data = self.file.read(size)
        if len(data) != size:
            raise ValueError(f"{self.path} ends before byte {offset + size}")
        return data

    def __enter__(self) -> Ranges:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()


def directories(source: Ranges) -> tuple[str, list[dict[int, tuple]]]:
    """Byte order and the tags of each page."""
    head = source.at(0, 8)
    if head[:2] not in (b"II", b"MM"):
        raise ValueError(f"{source.path} is no TIFF")
    order = "<" if head[:2] == b"II" else ">"
    pages = []
    (place,) = struct.unpack_from(f"{order}I", head, 4)
    while place:
        (n,) = struct.unpack(f"{order}H", source.at(place, 2))
        body = source.at(place + 2, 12 * n + 4)
        tags: dict[int, tuple] = {}
        for k in range(n):
            tag, kind, count = struct.unpack_from(f"{order}HHI", body, 12 * k)
            size = SIZES.get(kind, 1) * count
            raw = body[12 * k + 8 : 12 * k + 8 + size] if size <= 4 else source.at(struct.unpack_from(f"{order}I", body, 12 * k + 8)[0], size)
            if kind == 2:
                tags[tag] = (raw.rstrip(b"\0"),)
            elif kind in LETTERS:
                tags[tag] = struct.unpack(f"{order}{count}{LETTERS[kind]}", raw)
        pages.append(tags)
        (place,) = struct.unpack_from(f"{order}I", body, 12 * n)
    return order, pages


def unpacked(data: bytes) -> bytes:
    """LZW as TIFF has it: codes of 9 to 12 bits, high bits first, one bit longer just before the table needs it."""
    out: list[bytes] = []
    table: list[bytes] = []
    last, width, held, bits = b"", 9, 0, 0
    for byte in data:
        held, bits = held << 8 | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code, held = held >> bits, held & ((1 << bits) - 1)
        if code == END:
            break
        if code == CLEAR:
            table, last, width = [bytes([k]) for k in range(256)] + [b"", b""], b"", 9
            continue
        entry = table[code] if code < len(table) else last + last[:1]
        out.append(entry)
        if last:
            table.append(last + entry[:1])
        last = entry
        width = 9 + (len(table) >= 511) + (len(table) >= 1023) + (len(table) >= 2047)
    return b"".join(out)


@dataclass
class Raster:
    """What a TIFF's pages say about its size, place and samples."""

    order: str
    pages: list[dict[int, tuple]]

    @property
    def width(self) -> int:
        return int(self.pages[0][WIDTH][0])

    @property
    def height(self) -> int:
        return int(self.pages[0][HEIGHT][0])

    @property
    def bands(self) -> int:
        return sum(int(p.get(SAMPLES, (1,))[0]) for p in self.pages)

    @property
    def nodata(self) -> float | None:
        text = self.pages[0].get(NODATA)
        return float(text[0]) if text else None

    @property
    def crs(self) -> str:
        """The coordinate system as "EPSG:n"; empty if the file names none."""
        keys = self.pages[0].get(GEO_KEYS, ())
        codes = {keys[k]: keys[k + 3] for k in range(4, len(keys) - 3, 4) if not keys[k + 1]}
        code = codes.get(PROJECTED) or codes.get(GEOGRAPHIC)
        return f"EPSG:{code}" if code else ""

    @property
    def transform(self) -> tuple[float, ...] | None:
        """Affine coefficients a to f of a raster without rotation; None without georeference."""
        scale, tie = self.pages[0].get(PIXEL_SCALE), self.pages[0].get(TIE_POINT)
        if not scale or not tie:
            return None
        return scale[0], 0.0, tie[3] - tie[0] * scale[0], 0.0, -scale[1], tie[4] + tie[1] * scale[1]

    def band(self, number: int) -> tuple[dict[int, tuple], int]:
        """The page and the sample of a band, counted from 1."""
        left = number - 1
        for page in self.pages:
            n = int(page.get(SAMPLES, (1,))[0])
            if 0 <= left < n:
                return page, left
            left -= n
        raise ValueError(f"no band {number} among {self.bands}")

    def window(self, source: Ranges, number: int, x: int, y: int, width: int, height: int, fill: float | None = None) -> np.ndarray:
        """Pixels of a band in a window that may reach beyond the raster: ``fill`` there, else 0."""
        page, sample = self.band(number)
        samples, planar = int(page.get(SAMPLES, (1,))[0]), int(page.get(PLANAR, (1,))[0])
        kind = "uif"[int(page.get(FORMAT, (1,))[0]) - 1]
        dtype = np.dtype(f"{self.order}{kind}{int(page.get(BITS, (8,))[0]) // 8}")
        value = fill if fill is not None else 0
        out = np.full((height, width), value, np.float64 if isinstance(value, float) and (value != value or value % 1) else dtype.newbyteorder("="))
        x1, y1, x2, y2 = max(x, 0), max(y, 0), min(x + width, self.width), min(y + height, self.height)
        if x1 >= x2 or y1 >= y2:
            return out
        apart = planar == 2 or samples == 1
        step = 1 if apart else samples  # samples from one pixel to the next
        if TILE_WIDTH in page:
            tw, th = int(page[TILE_WIDTH][0]), int(page[TILE_HEIGHT][0])
            across, down = math.ceil(self.width / tw), math.ceil(self.height / th)
            for r in range(y1 // th, (y2 - 1) // th + 1):
                for c in range(x1 // tw, (x2 - 1) // tw + 1):
                    index = r * across + c + (sample * across * down if apart else 0)
                    tile = self._decoded(source, page, int(page[TILES][index]), int(page[TILE_COUNTS][index]), th, tw, step, dtype)[:, (0 if apart else sample) :: step]
                    top, end, left, right = max(y1, r * th), min(y2, (r + 1) * th), max(x1, c * tw), min(x2, (c + 1) * tw)
                    out[top - y : end - y, left - x : right - x] = tile[top - r * th : end - r * th, left - c * tw : right - c * tw]
            return out
        tall = min(int(page.get(ROWS, (self.height,))[0]), self.height)
        per_plane = math.ceil(self.height / tall)
        for strip in range(y1 // tall, (y2 - 1) // tall + 1):
            top, end = max(y1, strip * tall), min(y2, (strip + 1) * tall)
            index = strip + (sample * per_plane if apart else 0)
            rows = self._rows(source, page, index, top - strip * tall, end - strip * tall, x1, x2, step, dtype)
            out[top - y : end - y, x1 - x : x2 - x] = rows[:, (0 if apart else sample) :: step]
        return out

    def _rows(self, source: Ranges, page: dict[int, tuple], index: int, first: int, last: int, x1: int, x2: int, step: int, dtype: np.dtype) -> np.ndarray:
        """Samples of columns x1 to x2 in some rows of a strip."""
        size = dtype.itemsize
        line, left, need = self.width * step * size, x1 * step * size, (x2 - x1) * step * size
        start = int(page[STRIPS][index])
        if int(page.get(COMPRESSION, (PLAIN,))[0]) != PLAIN:
            tall = min(int(page.get(ROWS, (self.height,))[0]), self.height)
            rows = min(tall, self.height - index % math.ceil(self.height / tall) * tall)
            return self._decoded(source, page, start, int(page[COUNTS][index]), rows, self.width, step, dtype)[first:last, x1 * step : x2 * step]
        if line <= SLACK * need:
            block = source.at(start + first * line + left, (last - first - 1) * line + need)
            parts = [block[k * line : k * line + need] for k in range(last - first)]
        else:
            parts = [source.at(start + r * line + left, need) for r in range(first, last)]
        return np.frombuffer(b"".join(parts), dtype).reshape(last - first, -1).astype(dtype.newbyteorder("="))


    def _decoded(self, source: Ranges, page: dict[int, tuple], start: int, count: int, height: int, width: int, step: int, dtype: np.dtype) -> np.ndarray:
        """All samples of a strip or tile, a row each."""
        code, data = int(page.get(COMPRESSION, (PLAIN,))[0]), source.at(start, count)
        if code in DEFLATED:
            data = zlib.decompress(data)
        elif code == LZW:
            data = unpacked(data)
        elif code != PLAIN:
            raise ValueError(f"{source.path}: compression {code} cannot be read here; plug in another decoder")
        rows = np.frombuffer(data, dtype, height * width * step).reshape(height, width, step).astype(dtype.newbyteorder("="))
        kind = int(page.get(PREDICTOR, (1,))[0])
        if kind == 2:  # each sample is the difference from the pixel on its left
            rows = np.cumsum(rows, axis=1, dtype=rows.dtype)
        elif kind != 1:
            raise ValueError(f"{source.path}: predictor {kind} cannot be read here; plug in another decoder")
        return rows.reshape(height, width * step)


def open_raster(source: Ranges) -> Raster:
    return Raster(*directories(source))


def read_rasters(spark: SparkSession, path: str, crs: str = "") -> DataFrame:
    """One row of metadata per TIFF; the image's name is the file's. Only headers are read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tif*").load(path).select("path")
    return raster_headers(files, F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1), crs)


def raster_headers(files: DataFrame, image_id, crs: str = "") -> DataFrame:
    """Metadata of the rasters in column ``path``, under the names that the column ``image_id`` gives; ``crs``
    stands for what the files say of their coordinate system."""

    def run(batches):
        for pdf in batches:
            rows = []
            for name, path in zip(pdf["image_id"], pdf["path"], strict=True):
                with Ranges(path) as source:
                    r = open_raster(source)
                rows.append((name, path, r.width, r.height, r.bands, r.nodata, *(r.transform or (None,) * 6), crs or r.crs))
            made = pd.DataFrame(rows, columns=RASTER.names)
            yield made.astype({"w": "Int32", "h": "Int32", "bands": "Int32", "nodata": "float64"})

    return files.select(image_id.alias("image_id"), "path").mapInPandas(run, RASTER)


def read_windows(windows: DataFrame, bands: Sequence[int], side: int, boundless: bool = False, path: str = "path", x: str = "x0", y: str = "y0", out: str = "bands") -> DataFrame:
    """``windows`` plus ``out``: the square of ``side`` pixels at (x, y) of each of ``bands`` (from 1), row by row.

    A window that reaches beyond its raster is cut at the edge; with ``boundless`` it is filled up
    with the raster's nodata value, else 0. Each task opens a raster once for the windows that follow
    each other in it and reads their bytes only. A null path gives null bands.
    """
    names = list(windows.columns)
    schema = T.StructType([*windows.schema, T.StructField(out, T.ArrayType(T.ArrayType(T.DoubleType())))])

    def pixels(raster: Raster, source: Ranges, left: int, top: int) -> list[list[float]]:
        if boundless:
            box = left, top, side, side
        else:
            box = max(left, 0), max(top, 0), max(0, min(left + side, raster.width) - max(left, 0)), max(0, min(top + side, raster.height) - max(top, 0))
        return [raster.window(source, b, *box, raster.nodata).astype(np.float64).ravel().tolist() for b in bands]

    def run(batches):
        at, source, raster = None, None, None
        try:
            for pdf in batches:
                found = []
                for p, left, top in zip(pdf[path], pdf[x], pdf[y], strict=True):
                    if p is None:
                        found.append(None)
                        continue
                    if p != at:
                        if source is not None:
                            source.file.close()
                        source = Ranges(p)
                        at, raster = p, open_raster(source)
                    found.append(pixels(raster, source, int(left), int(top)))
                yield pdf.assign(**{out: found})[[*names, out]]
        finally:
            if source is not None:
                source.file.close()

    return windows.mapInPandas(run, schema)
