"""Queries of what reads and writes files, of polygons and of settings, with the SQL that must give the same rows.

Files go to a new folder in the shared folder and are read back from there.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as fx
from .functions import boxes as bx
from .functions import crs, georef
from .operators import evaluate as ev
from .operators import labels, stretch, tiling
from .plans import config, datasets, pipelines
from .queries import _AP, _LABELS, _MATCH, _SPLIT, _STRETCH, RATIOS, STRIDE, TILE, _curve, _hits, _valid, query, renamed
from .sources import geopackage, images, rasters, tables
from .storage import new_folder, write_through

# --- polygons --------------------------------------------------------------------------------------


def _point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def _ring(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.array(_point(x1, y1), _point(x2, y1), _point(x2, y2), _point(x1, y2), _point(x1, y1))


def _with_hole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features as polygons with a rectangular hole two pixels from every side."""
    c = [F.col(n) for n in ("x1", "y1", "x2", "y2")]
    return fx.features(spark, sf_dir).withColumn("rings", F.array(_ring(*c), _ring(c[0] + 2, c[1] + 2, c[2] - 2, c[3] - 2)))


@query("geometry_null_filter", f"WITH {fx.FEATURES} SELECT feature_id FROM features WHERE feature_id%7<>0")
def geometry_null_filter(spark, sf_dir):
    parts = F.when(F.col("feature_id") % 7 != 0, F.array("rings"))
    return labels.explode_parts(_with_hole(spark, sf_dir).withColumn("parts", parts)).select("feature_id")


@query("polygon_validity", f"WITH {fx.FEATURES} SELECT feature_id, feature_id%4=0 AS valid FROM features")
def polygon_validity(spark, sf_dir):
    """Rectangles, and rings that cross themselves, stay open or have no area."""
    x1, y1, x2, y2 = (F.col(n) for n in ("x1", "y1", "x2", "y2"))
    crossed = F.array(_point(x1, y1), _point(x2, y2), _point(x2, y1), _point(x1, y2), _point(x1, y1))
    kind = F.col("feature_id") % 4
    ring = F.when(kind == 0, _ring(x1, y1, x2, y2)).when(kind == 1, crossed).when(kind == 2, F.slice(_ring(x1, y1, x2, y2), 1, 4)).otherwise(_ring(x1, y1, x2, y1))
    return fx.features(spark, sf_dir).select("feature_id", labels.valid_polygon(F.array(ring)).alias("valid"))


@query("geometry_parts", f"WITH {fx.FEATURES} SELECT feature_id//10 AS layer_row, count(*) AS n, sum((x2-x1)*(y2-y1)-(x2-x1-4)*(y2-y1-4)) AS area FROM features WHERE feature_id%11<>0 GROUP BY 1")
def geometry_parts(spark, sf_dir):
    """Geometries of up to ten parts, some of them null, part by part."""
    row = F.floor(F.col("feature_id") / 10).alias("layer_row")
    part = F.struct(F.when(F.col("feature_id") % 11 != 0, F.col("rings")).alias("p"))
    many = _with_hole(spark, sf_dir).groupBy(row).agg(F.transform(F.collect_list(part), lambda s: s["p"]).alias("parts"))
    return labels.explode_parts(many).groupBy("layer_row").agg(F.count("*").alias("n"), F.sum(labels.polygon_area(F.col("parts"))).alias("area"))


_WINDOW = "(SELECT *, floor(x1/64)*64 wx, floor(y1/64)*64 wy FROM features)"
_MEET = "greatest(0,least(x2-{h},wx+64)-(x1+{h}))*greatest(0,least(y2-{h},wy+64)-(y1+{h}))"


@query("polygon_clip", f"WITH {fx.FEATURES} SELECT feature_id, {_MEET.format(h=0)}-{_MEET.format(h=2)} AS area, x1 AS minx, y1 AS miny, least(x2,wx+64) AS maxx, least(y2,wy+64) AS maxy FROM {_WINDOW}")
def polygon_clip(spark, sf_dir):
    """Polygons with a hole, cut by the square of 64 pixels their corner lies in."""
    x, y = F.floor(F.col("x1") / 64) * 64.0, F.floor(F.col("y1") / 64) * 64.0
    return _with_hole(spark, sf_dir).select("feature_id", labels.clip_polygon(F.col("rings"), bx.Box(x, y, x + 64, y + 64)).alias("c")).select("feature_id", "c.*")


@query("reprojection", f"WITH {fx.FEATURES} SELECT feature_id, (300000+x1*100)::double AS east, (200000+y1*4000)::double AS north, 'UTM' AS grid FROM features")
def reprojection(spark, sf_dir):
    """Coordinates of a UTM zone, moved to longitude and latitude, to web Mercator, to the next zone and back."""
    f = fx.features(spark, sf_dir).select("feature_id", (F.col("x1") * 100 + 300000).alias("x"), (F.col("y1") * 4000 + 200000).alias("y"))
    for source, target in ((32633, 4326), (4326, 3857), (3857, 32634), (32634, 32633)):
        x, y = crs.reproject(F.col("x"), F.col("y"), source, target)
        f = write_through(f.select("feature_id", x.alias("x"), y.alias("y")), "moved")
    return f.select("feature_id", F.round("x", 2).alias("east"), F.round("y", 2).alias("north"), F.lit("UTM").alias("grid"))


# --- labels ------------------------------------------------------------------------------------------

_TEXTS = f"""{_LABELS}, {_SPLIT}, lines AS (
  SELECT split, tile_id, printf('0 %.6f %.6f %.6f %.6f', (px1+px2)/2/256, (py1+py2)/2/256, (px2-px1)/256, (py2-py1)/256) AS line
  FROM labels JOIN draws ON key=xor(cast(tile_r//6 AS bigint)*1000003, cast(tile_c//6 AS bigint)))"""


def _made_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipelines.build_labels(fx.features(spark, sf_dir), fx.rasters(spark, sf_dir), TILE, STRIDE, RATIOS, 42, 6)


@query("label_files", f"WITH {_TEXTS} SELECT split, 'tile_'||tile_id||'.txt' AS name, string_agg(line, chr(10) ORDER BY line)||chr(10) AS text FROM lines GROUP BY split, tile_id")
def label_files(spark, sf_dir):
    return tables.label_files(_made_labels(spark, sf_dir)).select("split", "name", F.col("content").cast("string").alias("text"))


@query("unlabelled_tiles", f"WITH {_LABELS} SELECT (SELECT count(DISTINCT tile_id) FROM hits)-(SELECT count(DISTINCT tile_id) FROM labels) AS tiles")
def unlabelled_tiles(spark, sf_dir):
    hits = write_through(_hits(spark, sf_dir), "hits")
    n = labels.tiles_without_labels(hits, labels.pixel_labels(labels.clip_boxes(hits, TILE), TILE))
    return spark.createDataFrame([(n,)], "tiles long")


@query("uniform_tiling", f"WITH {fx.RASTERS} SELECT DISTINCT greatest(32, cast(round(2560/((abs(a)+abs(e))/2)/32)*32 AS int)) AS tile_size, 64 AS stride FROM rasters")
def uniform_tiling(spark, sf_dir):
    size = tiling.tile_size_from_ground(2560, georef.pixel_size(georef.Affine.of()))
    measured = fx.rasters(spark, sf_dir).withColumn("tile_size", size).withColumn("stride", tiling.stride_of(F.col("tile_size"), 0.25))
    return spark.createDataFrame([tiling.uniform_tiling(measured)], "tile_size int, stride int")


@query("dataset_metadata", f"WITH {_LABELS}, {_SPLIT} SELECT split, count(DISTINCT tile_id) AS tiles_written, count(*) AS labels_written FROM labels JOIN draws ON key=xor(cast(tile_r//6 AS bigint)*1000003, cast(tile_c//6 AS bigint)) GROUP BY split UNION ALL SELECT 'test', 0, 0")
def dataset_metadata(spark, sf_dir):
    """The metadata file of a dataset, written and read back."""
    folder = new_folder(spark, "dataset")
    meta = tables.dataset_meta("run", [], [1, 2], [1], TILE, STRIDE, 0.25, 4, RATIOS, 42, 6, labels.split_counts(_made_labels(spark, sf_dir)), 0)
    tables.write_json(meta, f"{folder}/dataset_meta.json")
    counts = "struct<train: long, val: long, test: long>"
    stats = spark.read.schema(f"stats struct<tiles_written: {counts}, labels_written: {counts}>").json(f"{folder}/dataset_meta.json", multiLine=True).select("stats.*")
    rows = F.array(*(F.struct(F.lit(s).alias("split"), F.col(f"tiles_written.{s}").alias("tiles_written"), F.col(f"labels_written.{s}").alias("labels_written")) for s in ("train", "val", "test")))
    return stats.select(F.explode(rows).alias("r")).select("r.*")


# --- evaluation --------------------------------------------------------------------------------------


def _class_sql(classes: tuple[int, ...]) -> str:
    """Each class's predictions against all ground truth: the matching walk once a class, under names of its own."""
    base, walk = (_MATCH + _AP).split(", preds AS", 1)
    parts = [renamed("preds AS" + walk.replace("WHERE conf>=0.25)", f"WHERE conf>=0.25 AND class_id={k})", 1), ("preds", "cand", "ord", "walk", "matched", "curve", "best", "ap", "fin"), k) for k in classes]
    rows = " UNION ALL ".join(f"SELECT {k} AS class_id, ap{k}.ap{k} AS ap, p AS precision, r AS recall FROM ap{k}, fin{k}" for k in classes)
    return f"WITH RECURSIVE {base}, {', '.join(parts)} {rows}"


@query("class_metrics", _class_sql((0, 1, 2)))
def class_metrics(spark, sf_dir):
    d, t = fx.detections(spark, sf_dir).filter(bx.confident(F.col("conf"), 0.25)), fx.truth(spark, sf_dir)
    return ev.evaluate_classes(d, t, (0, 1, 2), 0.5).select("class_id", F.round("ap", 9).alias("ap"), "precision", "recall")


@query("metrics_file", f"WITH RECURSIVE {_MATCH}{_AP} SELECT 'm' AS model, ap, p AS precision, r AS recall FROM ap, fin")
def metrics_file(spark, sf_dir):
    """Metrics written as JSON and read back."""
    m = ev.average_precision(_curve(spark, sf_dir)).first()
    folder = new_folder(spark, "metrics")
    tables.write_json({"model": "m", "ap": round(m["ap"], 9), "precision": m["precision"], "recall": m["recall"]}, f"{folder}/metrics.json")
    return spark.read.schema("model string, ap double, precision double, recall double").json(f"{folder}/metrics.json", multiLine=True)


# --- detections on disk ------------------------------------------------------------------------------


@query("csv_detections", f"WITH {fx.TILED} SELECT tile, tile_r, tile_c, x1, y1, x2, y2, conf, class_id FROM tiled")
def csv_detections(spark, sf_dir):
    folder = f"{new_folder(spark, 'csv')}/d.csv"
    tables.write_detections(fx.tiled_detections(spark, sf_dir), folder, sort=True)
    return tables.read_detections(spark, folder)


def _packages(spark: SparkSession, sf_dir: str) -> str:
    """A folder of one GeoPackage an image, and a file that is none."""
    folder = new_folder(spark, "packages")
    placed = pipelines.georeference(fx.detections(spark, sf_dir), fx.rasters(spark, sf_dir)).select("image_id", "det_id", "class_id", "conf", "minx", "miny", "maxx", "maxy")
    geopackage.write_packages(placed, folder, "detections", 32633, "a CRS")
    tables.write_text("no package", f"{folder}/notes.txt")
    return folder


_PLACED = f"{fx.DETECTIONS}, {fx.RASTERS}, placed AS (SELECT det_id, image_id, conf, a*x1+c AS minx, e*(y2+1)+f AS miny, a*(x2+1)+c AS maxx, e*y1+f AS maxy FROM detections JOIN rasters USING (image_id))"


@query("geopackage_features", f"WITH {_PLACED} SELECT det_id, image_id, conf, minx, miny, maxx, maxy, 'Polygon' AS geom_type, 32633 AS srs_id FROM placed")
def geopackage_features(spark, sf_dir):
    a = F.col("attributes")
    return geopackage.read_layer(spark, _packages(spark, sf_dir), "detections").select(a["det_id"].cast("long").alias("det_id"), a["image_id"].alias("image_id"), a["conf"].cast("double").alias("conf"), "minx", "miny", "maxx", "maxy", "geom_type", F.col("srs_id").cast("int").alias("srs_id"))


@query("geopackage_layers", f"WITH {_PLACED} SELECT 'detections_merged_'||image_id||'.gpkg' AS file, 'detections' AS layer, 'features' AS data_type, count(*) AS n FROM placed GROUP BY image_id")
def geopackage_layers(spark, sf_dir):
    return geopackage.list_layers(spark, _packages(spark, sf_dir)).select(F.element_at(F.split("path", "/"), -1).alias("file"), "layer", "data_type", F.col("rows").alias("n"))


# --- pictures ------------------------------------------------------------------------------------------


def _tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of 8 by 8 pixels and up to four 8-bit bands, in map squares side by side."""
    p = stretch.stretch_bands(fx.pixels(spark, sf_dir))
    made = p.groupBy("tile_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("band", "bytes"))), lambda s: s["bytes"]).alias("bands"))
    zero = F.lit(0)
    return made.select(F.col("tile_id").cast("string").alias("tile_id"), "bands", zero.alias("x0"), zero.alias("y0"), F.lit(2.0).alias("a"), F.lit(-2.0).alias("e"), (F.col("tile_id") * 16.0).alias("c"), F.lit(100.0).alias("f"))


def _pictures(spark: SparkSession, sf_dir: str, kind: str, extension: str, tiles: DataFrame | None = None) -> str:
    folder = new_folder(spark, "pictures")
    tiles = _tiles(spark, sf_dir) if tiles is None else tiles
    datasets.write_folders(datasets.encoded(tiles, "bands", kind, 8, extension, "", georeferenced=kind == "geotiff"), folder)
    return folder


_VEC = _valid("false") + _STRETCH.split("\nSELECT", 1)[0]
_BYTES = "WITH " + _VEC + "\nSELECT vec_id, string_agg(cast(v AS varchar), ',' ORDER BY i) AS bytes FROM pixel {where} GROUP BY vec_id"


def _decoded(spark: SparkSession, folder: str) -> DataFrame:
    """Bands of the pictures in a folder, by the vector they came from."""

    def run(batches):
        for pdf in batches:
            out = []
            for name, data in zip(pdf["tile"], pdf["content"], strict=True):
                hwc = images.read_tile(name, bytes(data))
                out += [(4 * int(name[5:].split(".")[0]) + b, ",".join(map(str, hwc[:, :, b].ravel().tolist()))) for b in range(hwc.shape[2])]
            yield pd.DataFrame(out, columns=["vec_id", "bytes"]).astype({"vec_id": "int64"})

    return tables.read_tiles(spark, folder).mapInPandas(run, "vec_id long, bytes string")


@query("multipage_tiff", _BYTES.format(where=""))
def multipage_tiff(spark, sf_dir):
    return _decoded(spark, _pictures(spark, sf_dir, "pages", "tif"))


@query("geotiff_pixels", _BYTES.format(where=""))
def geotiff_pixels(spark, sf_dir):
    return _decoded(spark, _pictures(spark, sf_dir, "geotiff", "TIF"))


@query("png_pixels", _BYTES.format(where="WHERE vec_id%4<3 AND vec_id//4 IN (SELECT vec_id//4 FROM pixels GROUP BY 1 HAVING count(*)>=3)"))
def png_pixels(spark, sf_dir):
    tiles = _tiles(spark, sf_dir).filter(F.size("bands") >= 3).withColumn("bands", F.slice("bands", 1, 3))
    return _decoded(spark, _pictures(spark, sf_dir, "png", "png", tiles))


@query("tile_listing", f"WITH {fx.PIXELS} SELECT DISTINCT 'tile_'||tile_id||'.tif' AS tile FROM pixels")
def tile_listing(spark, sf_dir):
    folder = _pictures(spark, sf_dir, "pages", "tif")
    tables.write_text("no picture", f"{folder}/notes.txt")
    return tables.list_tiles(spark, folder).select("tile")


@query("raster_metadata", f"WITH {fx.PIXELS} SELECT 'tile_'||tile_id AS image_id, 8 AS w, 8 AS h, cast(count(*) AS int) AS bands, 2::double AS a, (tile_id*16)::double AS c, (-2)::double AS e, 100::double AS f FROM pixels GROUP BY tile_id")
def raster_metadata(spark, sf_dir):
    return rasters.read_rasters(spark, _pictures(spark, sf_dir, "geotiff", "tif")).select("image_id", "w", "h", "bands", "a", "c", "e", "f")


def _windows(spark: SparkSession, sf_dir: str, boundless: bool) -> DataFrame:
    """The first band in a window of 5 by 5 pixels that reaches over the raster's upper and right edges."""
    files = tables.list_tiles(spark, _pictures(spark, sf_dir, "geotiff", "tif"))
    tile = F.regexp_extract("tile", r"(\d+)\.tif", 1).cast("long")
    windows = files.select(tile.alias("tile_id"), "path", (F.lit(3) + tile % 3).alias("x0"), F.lit(-2).alias("y0"))
    return rasters.read_windows(windows, [1], 5, boundless)


_IN = "WITH " + _VEC + """, side AS (SELECT vec_id, vec_id//4 AS tile_id, 3+(vec_id//4)%3 AS x0 FROM pixels WHERE band=0),
window_ AS (SELECT side.*, k, x0+k%5 AS x, k//5-2 AS y FROM side, (SELECT unnest(range(25)) AS k))"""


@query("window_read", _IN + " SELECT tile_id, string_agg(cast(v AS varchar), ',' ORDER BY k) AS bytes FROM window_ w JOIN pixel p ON w.vec_id=p.vec_id AND i=8*y+x WHERE x<8 AND y>=0 GROUP BY tile_id")
def window_read(spark, sf_dir):
    whole = F.transform(F.element_at("bands", 1), lambda v: v.cast("int").cast("string"))
    return _windows(spark, sf_dir, False).select("tile_id", F.array_join(whole, ",").alias("bytes"))


@query("boundless_read", _IN + " SELECT tile_id, string_agg(cast(coalesce(v, 0) AS varchar), ',' ORDER BY k) AS bytes FROM window_ w LEFT JOIN pixel p ON w.vec_id=p.vec_id AND i=8*y+x AND x<8 AND y>=0 GROUP BY tile_id")
def boundless_read(spark, sf_dir):
    whole = F.transform(F.element_at("bands", 1), lambda v: v.cast("int").cast("string"))
    return _windows(spark, sf_dir, True).select("tile_id", F.array_join(whole, ",").alias("bytes"))


@query("tile_pictures", f"WITH {fx.TILED} SELECT DISTINCT tile, 'p/'||replace(tile,'.tif','.png') AS path FROM tiled WHERE (tile_r+tile_c)%3=0")
def tile_pictures(spark, sf_dir):
    tiles = fx.tiled_detections(spark, sf_dir).select("tile", "tile_r", "tile_c").distinct()
    files = tiles.filter((F.col("tile_r") + F.col("tile_c")) % 3 == 0).select(F.concat(F.lit("p/"), F.replace("tile", F.lit(".tif"), F.lit(".png"))).alias("path"))
    return datasets.tile_pictures(files, tiles).select("tile", "path")


@query("overlay_pixels", "SELECT 'tile_'||(vec_id//4)||'.png' AS name, 5*4-3*2 AS drawn FROM embeddings GROUP BY vec_id//4 HAVING count(*)>=3")
def overlay_pixels(spark, sf_dir):
    """Pixels of each tile that a box of one pixel's thickness, from (1, 2) to (5, 5), turns green; its caption is above the tile."""
    tiles = _tiles(spark, sf_dir).filter(F.size("bands") >= 3).withColumn("bands", F.transform(F.slice("bands", 1, 3), lambda b: F.transform(b, lambda v: F.lit(0))))
    files = tables.list_tiles(spark, _pictures(spark, sf_dir, "png", "png", tiles)).select("path")
    box = [F.lit(v).alias(n) for n, v in (("tile_r", 0), ("tile_c", 0), ("x1", 1.0), ("y1", 2.0), ("x2", 5.0), ("y2", 5.0), ("conf", 0.5))]
    found = tiles.select(F.concat(F.lit("tile_"), "tile_id", F.lit(".tif")).alias("tile"), *box)

    def run(batches):
        for pdf in batches:
            green = [int((images.read_png(bytes(c)) == (0, 255, 0)).all(axis=2).sum()) for c in pdf["content"]]
            yield pd.DataFrame({"name": pdf["name"], "drawn": np.array(green, np.int32)})

    return datasets.overlays(found, files, STRIDE, 0.25, 1, caption=False).select("name", "content").mapInPandas(run, "name string, drawn int")


# --- settings and metadata -----------------------------------------------------------------------------


@query("tiles_metadata", f"WITH {fx.TILES.format(way='ceil')} SELECT image_id AS id, w, h, cast(max(tile_r)+1 AS int) AS n_rows, cast(max(tile_c)+1 AS int) AS n_cols, count(*) AS tiles_written FROM tiles JOIN rasters USING (image_id) GROUP BY ALL")
def tiles_metadata(spark, sf_dir):
    """The metadata file of inference tiles, written and read back."""
    g = tiling.grid_counts(fx.rasters(spark, sf_dir), TILE, STRIDE, True)
    none = F.lit("")
    shape, pixel = F.array("w", "h").alias("raster_size_px"), F.array(F.lit(10.0), F.lit(10.0)).alias("pixel_size")
    inputs = g.select(F.col("image_id").alias("id"), none.alias("raster"), none.alias("crs"), shape, pixel, "n_rows", "n_cols", F.col("tiles").alias("tiles_written"), F.lit(0).cast("long").alias("tiles_skipped_all_nodata"))
    folder = new_folder(spark, "tiles")
    tables.write_tiles_meta(inputs, f"{folder}/tiles_meta.json", TILE, STRIDE, [1], [1], False)
    i = tables.read_tiles_inputs(spark, f"{folder}/tiles_meta.json")
    return i.select("id", F.get("raster_size_px", 0).alias("w"), F.get("raster_size_px", 1).alias("h"), "n_rows", "n_cols", "tiles_written")


_BASE = {"run_id": "r", "inputs": [{"id": "a", "raster": "a.tif", "masks_gpkg": "a.gpkg"}]}
_CASES = {
    "plain": (_BASE, "ok"), "no run": (_BASE | {"run_id": None}, "error"), "no input": (_BASE | {"inputs": []}, "error"), "odd tile": (_BASE | {"tiling": {"tile_size_px": 500}}, "error"),
    "tile": (_BASE | {"tiling": {"tile_size_px": 256}}, "ok"), "overlap": (_BASE | {"tiling": {"overlap_fraction": 1.5}}, "error"), "negative overlap": (_BASE | {"tiling": {"overlap_fraction": -0.1}}, "error"),
    "ratios": (_BASE | {"split": {"train": 0.5, "val": 0.3, "test": 0.3}}, "error"), "named ratios": (_BASE | {"split": {"ratios": {"train": 0.7, "val": 0.3, "test": 0.0}}}, "ok"),
    "no blocks": (_BASE | {"split": {"block_tiles": 0}}, "error"), "narrow": (_BASE | {"labels": {"min_width_m": -1}}, "error"), "unknown key": (_BASE | {"other": 1}, "ok"),
}


@query("config_rules", "SELECT * FROM (VALUES " + ", ".join(f"('{n}', '{want}')" for n, (_, want) in _CASES.items()) + ") v(name, outcome)")
def config_rules(spark, sf_dir):
    """Configuration files that keep or break a rule, written as YAML and read back with checks."""
    folder = new_folder(spark, "config")
    out = []
    for name, (document, _) in _CASES.items():
        tables.write_text(json.dumps(document), f"{folder}/{name}.yaml")
        try:
            config.load_config(f"{folder}/{name}.yaml", validate=True)
            out.append((name, "ok"))
        except ValueError:
            out.append((name, "error"))
    return spark.createDataFrame(out, "name string, outcome string")


@query("config_inputs", "SELECT * FROM (VALUES ('a', '/d/x/a.tif', 256, 0.7::double), ('b', '/abs/b.tif', 256, 0.7::double)) v(id, raster, tile_size, train)")
def config_inputs(spark, sf_dir):
    """A configuration's inputs with their paths resolved."""
    inputs = [{"id": i, "raster": r, "masks_gpkg": "g"} for i, r in (("a", "x/./a.tif"), ("b", "/abs/b.tif"))]
    cfg = config.validate_config(_BASE | {"inputs": inputs, "tiling": {"tile_size_px": 256}})
    rows = [(i.id, str(config.resolve_path("/d", i.raster)), cfg.tiling.tile_size_px, cfg.split.train) for i in cfg.chosen(None)]
    return spark.createDataFrame(rows, "id string, raster string, tile_size int, train double")


@query("setting_values", "SELECT * FROM (VALUES ('tile 512', '512'), ('tile none', '512'), ('tile 32', 'error'), ('model', 'n'), ('input b', 'b'), ('input z', 'error')) v(name, outcome)")
def setting_values(spark, sf_dir):
    """Checked metadata, a model's size by its file's name, inputs by id."""
    cfg = config.validate_config(_BASE | {"inputs": [{"id": i, "raster": "r", "masks_gpkg": "g"} for i in "ab"]})
    asked = {
        "tile 512": lambda: config.checked_tile_size({"tile_size": 512}), "tile none": lambda: config.checked_tile_size({}), "tile 32": lambda: config.checked_tile_size({"tile_size": 32}),
        "model": lambda: config.model_size("weights/net11n.pt"), "input b": lambda: cfg.chosen("b")[0].id, "input z": lambda: cfg.chosen("z"),
    }
    out = []
    for name, ask in asked.items():
        try:
            out.append((name, str(ask())))
        except ValueError:
            out.append((name, "error"))
    return spark.createDataFrame(out, "name string, outcome string")


@query("data_yaml", "SELECT * FROM (VALUES ('path', 'd'), ('train', 'images/train'), ('val', 'images/val'), ('test', 'images/test'), ('channels', '4'), ('0', 'circle')) v(name, value)")
def data_yaml(spark, sf_dir):
    """The dataset description that trainers read, as its lines say it."""
    folder = new_folder(spark, "yaml")
    tables.write_text(tables.data_yaml("d", 4, "circle"), f"{folder}/data.yaml")
    parts = F.split("value", ": ")
    return spark.read.text(f"{folder}/data.yaml").filter(F.size(parts) == 2).select(F.trim(F.get(parts, 0)).alias("name"), F.get(parts, 1).alias("value"))
