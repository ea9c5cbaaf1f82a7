"""GeoPackage layers as DataFrames and back, over the standard library's SQLite."""

from __future__ import annotations

import os
import shutil
import sqlite3
import struct
import tempfile
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import dealt_out
from .rasters import Ranges

#: Row numbers of a layer that one task reads.
SPAN = 50_000
LAYER = "path string, layer string, data_type string, srs_id long, rows long"
FEATURE = "path string, layer string, fid long, srs_id long, geom_type string, empty boolean, parts array<array<array<struct<x: double, y: double>>>>, minx double, miny double, maxx double, maxy double, attributes map<string, string>"
BOX = ["minx", "miny", "maxx", "maxy"]
#: A rectangle as GeoPackage geometry: header with envelope, then a polygon of one ring.
RECTANGLE = np.dtype([("magic", "S2"), ("version", "u1"), ("flags", "u1"), ("srs", "<i4"), ("envelope", "<f8", 4), ("order", "u1"), ("kind", "<u4"), ("rings", "<u4"), ("points", "<u4"), ("ring", "<f8", 10)])
TYPES = ("Geometry", "Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon", "GeometryCollection")


def parse_wkb(data: bytes) -> tuple[str, list[list[list[tuple[float, float]]]]]:
    """Type and parts of a polygon, multi-polygon or simpler geometry; z and m values are dropped."""
    parts: list[list[list[tuple[float, float]]]] = []

    def read(at: int) -> tuple[str, int]:
        order = "<" if data[at] else ">"
        (code,) = struct.unpack_from(f"{order}I", data, at + 1)
        dims = 2 + bin(code >> 30).count("1") if code >> 30 else 2 + (0, 1, 1, 2)[code // 1000 % 4]
        kind = (code & 0x0FFFFFFF) % 1000
        at += 5

        def points(at: int, n: int) -> tuple[list[tuple[float, float]], int]:
            flat = struct.unpack_from(f"{order}{n * dims}d", data, at)
            return [(flat[i], flat[i + 1]) for i in range(0, n * dims, dims)], at + 8 * n * dims

        if kind == 1:
            ring, at = points(at, 1)
            parts.append([ring])
        elif kind == 2:
            (n,) = struct.unpack_from(f"{order}I", data, at)
            ring, at = points(at + 4, n)
            parts.append([ring])
        elif kind == 3:
            (rings,) = struct.unpack_from(f"{order}I", data, at)
            at += 4
            polygon = []
            for _ in range(rings):
                (n,) = struct.unpack_from(f"{order}I", data, at)
                ring, at = points(at + 4, n)
                polygon.append(ring)
            if polygon:
                parts.append(polygon)
        else:
            (n,) = struct.unpack_from(f"{order}I", data, at)
            at += 4
            for _ in range(n):
                _, at = read(at)
        return TYPES[kind], at

    return read(0)[0], parts


def split_header(blob: bytes) -> tuple[int, bool, bytes]:
    """Projection id, emptiness and well-known binary of a GeoPackage geometry."""
    if blob[:2] != b"GP":
        raise ValueError("not a GeoPackage geometry")
    flags = blob[3]
    order = "<" if flags & 1 else ">"
    envelope = (0, 32, 48, 48, 64)[(flags >> 1) & 7]
    return struct.unpack_from(f"{order}i", blob, 4)[0], bool(flags & 16), blob[8 + envelope :]


def _opened(path: str) -> sqlite3.Connection:
    """A file where it is mounted is opened in place; one in another store is fetched whole."""
    if path.startswith("file:") or "://" not in path:
        local = path.removeprefix("file://").removeprefix("file:")
        return sqlite3.connect(f"file:{quote(local)}?mode=ro&immutable=1", uri=True)
    db = sqlite3.connect(":memory:")
    with Ranges(path) as source:
        db.deserialize(source.file.read())
    return db


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gpkg").load(path).select("path")


def list_layers(spark: SparkSession, path: str) -> DataFrame:
    """One row per layer of each file; ``path`` may be a file, a folder or a pattern in any store Spark reads."""

    def run(batches):
        for pdf in batches:
            out = []
            for p in pdf["path"]:
                db = _opened(p)
                for name, kind, srs in db.execute("SELECT table_name, data_type, srs_id FROM gpkg_contents ORDER BY table_name").fetchall():
                    out.append((p, name, kind, srs, db.execute(f"SELECT count(*) FROM {_quoted(name)}").fetchone()[0]))
                db.close()
            yield pd.DataFrame(out, columns=["path", "layer", "data_type", "srs_id", "rows"])

    return _files(spark, path).mapInPandas(run, LAYER)


def read_layer(spark: SparkSession, path: str, layer: str = "") -> DataFrame:
    """Features of ``layer`` (empty: each file's first) with geometry as parts of rings, bounds and attributes as text.

    A null geometry has a null type and parts. A layer is read in spans of SPAN row numbers, each a
    row of work that Spark deals to tasks.
    """

    def spans(batches):
        for pdf in batches:
            out = []
            for p in pdf["path"]:
                db = _opened(p)
                found = db.execute("SELECT c.table_name, g.column_name FROM gpkg_contents c JOIN gpkg_geometry_columns g USING (table_name) ORDER BY c.table_name").fetchall()
                for name, geom in [(t, g) for t, g in found if t == layer] if layer else found[:1]:
                    low, high = db.execute(f"SELECT min(rowid), max(rowid) FROM {_quoted(name)}").fetchone()
                    out += [(p, name, geom, k) for k in range(low, high + 1, SPAN)] if low is not None else []
                db.close()
            yield pd.DataFrame(out, columns=["path", "layer", "geom", "low"])

    def run(batches):
        for batch in batches:
            for work in batch.to_pylist():
                db = _opened(work["path"])
                cursor = db.execute(f"SELECT rowid AS _rowid_, * FROM {_quoted(work['layer'])} WHERE rowid BETWEEN ? AND ?", (work["low"], work["low"] + SPAN - 1))
                names = [c[0] for c in cursor.description]
                while rows := cursor.fetchmany(5000):
                    yield _features(work["path"], work["layer"], names, names.index(work["geom"], 1), rows)
                db.close()

    work = _files(spark, path).mapInPandas(spans, "path string, layer string, geom string, low long")
    # Spans are few and short rows: without a number of partitions they would be put together into one task.
    return work.repartition(dealt_out(spark), "path", "low").mapInArrow(run, FEATURE)


def _features(path: str, layer: str, names: list[str], geom: int, rows: list[tuple]) -> pa.RecordBatch:
    """Rows of a layer (the row number first, the geometry at ``geom``) as rows of FEATURE."""
    blobs = [r[geom] for r in rows]
    shapes = _rectangle_columns(blobs) or _shape_columns(blobs)
    attributes = [(k, n) for k, n in enumerate(names) if k not in (0, geom)]
    keys, items, ends = [], [], [0]
    for r in rows:
        for k, n in attributes:
            if r[k] is not None:
                keys.append(n), items.append(str(r[k]))
        ends.append(len(keys))
    texts = pa.MapArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys, pa.string()), pa.array(items, pa.string()))
    same = [pa.array([v] * len(rows), pa.string()) for v in (path, layer)]
    columns = [*same, pa.array([r[0] for r in rows], pa.int64()), *shapes, texts]
    return pa.RecordBatch.from_arrays(columns, ["path", "layer", "fid", "srs_id", "geom_type", "empty", "parts", "minx", "miny", "maxx", "maxy", "attributes"])


def _nested(spots: np.ndarray, *ends: np.ndarray, nulls: np.ndarray | None = None) -> pa.Array:
    """Points as rings as parts as rows; ``ends``: the offsets of rings, of parts and of rows."""
    out = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(spots[:, k])) for k in (0, 1)], ["x", "y"])
    for k, e in enumerate(ends):
        mask = pa.array(nulls) if nulls is not None and k == len(ends) - 1 else None
        out = pa.ListArray.from_arrays(pa.array(e, pa.int32()), out, mask=mask)
    return out


def _rectangle_columns(blobs: list) -> list[pa.Array] | None:
    """The columns srs_id to maxy where all geometries are as ``_rectangles`` makes them, else None."""
    if any(b is None or len(b) != RECTANGLE.itemsize for b in blobs):
        return None
    made = np.frombuffer(b"".join(blobs), RECTANGLE)
    fixed = {"magic": b"GP", "flags": 3, "order": 1, "kind": 3, "rings": 1, "points": 5}
    if not all((made[n] == v).all() for n, v in fixed.items()):
        return None
    ring = made["ring"].reshape(-1, 5, 2)
    if np.isnan(ring).any():
        return None
    rows = len(made)
    bounds = [pa.array(f(ring[:, :, k], axis=1)) for f, k in ((np.min, 0), (np.min, 1), (np.max, 0), (np.max, 1))]
    parts = _nested(ring.reshape(-1, 2), np.arange(rows + 1) * 5, np.arange(rows + 1), np.arange(rows + 1))
    return [pa.array(made["srs"].astype(np.int64)), pa.array(["Polygon"] * rows), pa.array(np.zeros(rows, bool)), parts, *bounds]


def _shape_columns(blobs: list) -> list[pa.Array]:
    """The columns srs_id to maxy of any geometries."""
    out: list[tuple] = []
    spots, rings, parts, ends = [], [0], [0], [0]
    for blob in blobs:
        if blob is None:
            out.append((None, None, True, *(None,) * 4))
        else:
            srs, empty, wkb = split_header(blob)
            kind, found = parse_wkb(wkb)
            own = [q for part in found for ring in part for q in ring]
            bounds = (min(x for x, _ in own), min(y for _, y in own), max(x for x, _ in own), max(y for _, y in own)) if own else (None,) * 4
            out.append((srs, kind, empty or not own, *bounds))
            spots += own
            for part in found:
                for ring in part:
                    rings.append(rings[-1] + len(ring))
                parts.append(len(rings) - 1)
        ends.append(len(parts) - 1)
    nested = _nested(np.array(spots, float).reshape(-1, 2), np.array(rings), np.array(parts), np.array(ends), nulls=np.array([b is None for b in blobs]))
    srs, kind, empty, *bounds = zip(*out, strict=True)
    return [pa.array(srs, pa.int64()), pa.array(kind, pa.string()), pa.array(empty, pa.bool_()), nested, *(pa.array(b, pa.float64()) for b in bounds)]


def _column_kinds(rows: pd.DataFrame) -> dict[str, str]:
    kind = lambda c: "INTEGER" if pd.api.types.is_integer_dtype(rows[c]) else "REAL" if pd.api.types.is_float_dtype(rows[c]) else "TEXT"
    return {c: kind(c) for c in rows.columns if c not in BOX}


class _Package:
    """A GeoPackage with one polygon layer on the local disk, written a batch of rows at a time."""

    def __init__(self, file: str, layer: str, kinds: dict[str, str], srs_id: int, crs: str):
        self.layer, self.names, self.srs_id = layer, list(kinds), srs_id
        self.bounds = np.array([np.nan] * 4)
        self.db = db = sqlite3.connect(file)
        db.executescript(f"""PRAGMA journal_mode = OFF; PRAGMA synchronous = OFF; PRAGMA application_id = 1196444487; PRAGMA user_version = 10300;
CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER PRIMARY KEY, organization TEXT NOT NULL, organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT);
CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT UNIQUE, description TEXT DEFAULT '', last_change DATETIME DEFAULT (strftime('%Y-%m-%dT%H:%M:%fZ','now')), min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE, srs_id INTEGER);
CREATE TABLE gpkg_geometry_columns (table_name TEXT PRIMARY KEY, column_name TEXT NOT NULL, geometry_type_name TEXT NOT NULL, srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL);
CREATE TABLE {_quoted(layer)} (fid INTEGER PRIMARY KEY AUTOINCREMENT, geom BLOB{"".join(f", {_quoted(c)} {k}" for c, k in kinds.items())});""")
        for name, ident, org in (("Undefined cartesian SRS", -1, "NONE"), ("Undefined geographic SRS", 0, "NONE"), (crs, srs_id, "EPSG" if srs_id > 0 else "NONE")):
            db.execute("INSERT OR REPLACE INTO gpkg_spatial_ref_sys VALUES (?, ?, ?, ?, ?, NULL)", (name, ident, org, ident, crs if ident == srs_id else "undefined"))
        db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'POLYGON', ?, 0, 0)", (layer, srs_id))

    def add(self, rows: pd.DataFrame) -> None:
        values = [_rectangles(rows[BOX].to_numpy(dtype=float), self.srs_id)]
        for c in self.names:
            there = rows[c].notna()
            values.append(rows[c].tolist() if there.all() else rows[c].astype(object).where(there, None).tolist())
        self.db.executemany(f"INSERT INTO {_quoted(self.layer)} (geom{''.join(', ' + _quoted(c) for c in self.names)}) VALUES (?{', ?' * len(self.names)})", zip(*values, strict=True))
        low, high = rows[BOX[:2]].min().to_numpy(dtype=float), rows[BOX[2:]].max().to_numpy(dtype=float)
        self.bounds = np.r_[np.fmin(self.bounds[:2], low), np.fmax(self.bounds[2:], high)]

    def close(self) -> None:
        bounds = [None if np.isnan(v) else float(v) for v in self.bounds]
        self.db.execute("INSERT INTO gpkg_contents (table_name, data_type, identifier, min_x, min_y, max_x, max_y, srs_id) VALUES (?, 'features', ?, ?, ?, ?, ?, ?)", (self.layer, self.layer, *bounds, self.srs_id))
        self.db.commit()
        self.db.close()


def package_bytes(rows: pd.DataFrame, layer: str, srs_id: int = 0, crs: str = "undefined") -> bytes:
    """A GeoPackage with one polygon layer: the rectangles minx..maxy, and all other columns as attributes."""
    with tempfile.TemporaryDirectory() as folder:
        file = os.path.join(folder, "out.gpkg")
        package = _Package(file, layer, _column_kinds(rows), srs_id, crs)
        package.add(rows)
        package.close()
        with open(file, "rb") as f:
            return f.read()


def _rectangles(box: np.ndarray, srs_id: int) -> list[bytes]:
    """GeoPackage geometries of rectangles (minx, miny, maxx, maxy), with their envelopes."""
    made = np.zeros(len(box), RECTANGLE)
    made["magic"], made["flags"], made["srs"] = b"GP", 3, srs_id
    made["order"], made["kind"], made["rings"], made["points"] = 1, 3, 1, 5
    made["envelope"] = box[:, [0, 2, 1, 3]]
    made["ring"] = box[:, [2, 1, 2, 3, 0, 3, 0, 1, 2, 1]]
    raw, size = made.tobytes(), RECTANGLE.itemsize
    return [raw[k : k + size] for k in range(0, len(raw), size)]


def package_per_image(detections: DataFrame, layer: str = "detections", srs_id: int = 0, crs: str = "undefined", stem: str = "detections_merged") -> DataFrame:
    """``(name, content)``: one GeoPackage per image of georeferenced detections (with minx..maxy)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"name": [f"{stem}_{pdf['image_id'].iloc[0]}.gpkg"], "content": [package_bytes(pdf, layer, srs_id, crs)]})

    return detections.groupBy("image_id").applyInPandas(run, "name string, content binary")


def write_packages(detections: DataFrame, folder: str, layer: str = "detections", srs_id: int = 0, crs: str = "undefined", stem: str = "detections_merged") -> int:
    """Write the files of ``package_per_image`` and count them, holding a batch of rows at a time and no file.

    One task writes an image's file, as the format is one file: it grows on the task's own disk and is
    then copied. ``folder`` must be mounted at the same place on all executors.
    """
    kinds = {f.name: "INTEGER" if isinstance(f.dataType, T.IntegralType) else "REAL" if isinstance(f.dataType, T.FractionalType) else "TEXT" for f in detections.schema if f.name not in BOX}

    def save(batches):
        n, image, package = 0, None, None
        with tempfile.TemporaryDirectory() as own:
            file = os.path.join(own, "out.gpkg")

            def finish() -> None:
                package.close()
                whole = os.path.join(folder, f"{stem}_{image[0]}.gpkg".lstrip("/"))
                os.makedirs(os.path.dirname(whole), exist_ok=True)
                part = f"{whole}.{os.getpid()}.part"
                shutil.copyfile(file, part)
                os.replace(part, whole)  # a retried task leaves one whole file
                os.remove(file)

            for pdf in batches:
                # Rows come by image, so a file is whole when the next image begins.
                for key, rows in pdf.groupby("image_id", sort=False, dropna=False):
                    key = (None if pd.isna(key) else key,)
                    if package is None or key != image:
                        if package is not None:
                            finish()
                        n, image, package = n + 1, key, _Package(file, layer, kinds, srs_id, crs)
                    package.add(rows)
            if package is not None:
                finish()
        yield pd.DataFrame({"n": [n]})

    # A number of partitions that is given is kept, so images are not gathered in one task.
    dealt = detections.repartition(dealt_out(detections.sparkSession), "image_id").sortWithinPartitions("image_id")
    return dealt.mapInPandas(save, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_files(files: DataFrame, folder: str) -> int:
    """Write ``(name, content)`` rows as files, names with folders among them, and count them; ``folder``
    must be mounted at the same place on all executors."""

    def save(batches):
        for pdf in batches:
            for name, content in zip(pdf["name"], pdf["content"], strict=True):
                whole = os.path.join(folder, name.lstrip("/"))  # never outside the folder
                os.makedirs(os.path.dirname(whole), exist_ok=True)
                part = f"{whole}.{os.getpid()}.part"
                with open(part, "wb") as f:
                    f.write(content)
                os.replace(part, whole)  # a retried task leaves one whole file
            yield pd.DataFrame({"n": [len(pdf)]})

    return files.select("name", "content").mapInPandas(save, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
