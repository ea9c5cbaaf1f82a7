"""Files from rasters and back: training tiles with labels, inference tiles, drawn overlays."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import boxes as bx
from ..functions import crs, georef
from ..operators import labels, split, stretch, tiling
from ..sources import geopackage, images, rasters, tables
from .config import PipelineConfig
from .pipelines import draw_list

FILE = "folder string, name string, content binary"


def open_inputs(spark: SparkSession, inputs: Sequence, resolve) -> DataFrame:
    """Metadata of each input's raster under the input's id."""
    files = spark.createDataFrame([(i.id, str(resolve(i.raster))) for i in inputs], "id string, path string")
    return rasters.raster_headers(files, F.col("id"))


def sized(headers: DataFrame, cfg: PipelineConfig) -> tuple[DataFrame, int, int]:
    """``headers``, and the tile side and stride that all of them share (else an error)."""
    if cfg.tiling.use_ground_size:
        side = tiling.tile_size_from_ground(cfg.tiling.tile_size_m, georef.pixel_size(georef.Affine.of()))
    else:
        side = F.lit(tiling.checked_tile_size(cfg.tiling.tile_size_px))
    measured = headers.withColumn("tile_size", side).withColumn("stride", tiling.stride_of(F.col("tile_size"), cfg.tiling.stride_frac))
    return headers, *tiling.uniform_tiling(measured)


def encoded(tiles: DataFrame, bands: str, kind: str, side: int, extension: str, folder: Column | str, georeferenced: bool = False) -> DataFrame:
    """``(folder, name, content)``: pictures of the 8-bit ``bands`` of tiles (with ``tile_id``, x0, y0, a, c, e, f).

    ``kind``: "pages" (a TIFF page a band), "geotiff" or "png" (three bands).
    """

    def run(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                chw = np.array([np.asarray(b, np.uint8) for b in r.bands]).reshape(len(r.bands), side, side)
                if kind == "png":
                    data = images.png(np.ascontiguousarray(chw.transpose(1, 2, 0)))
                elif georeferenced:
                    data = images.geotiff(chw, (r.a, 0.0, r.a * r.x0 + r.c, 0.0, r.e, r.e * r.y0 + r.f))
                else:
                    data = images.multipage_tiff(chw)
                out.append((r.folder, f"tile_{r.tile_id}.{extension}", data))
            yield pd.DataFrame(out, columns=["folder", "name", "content"])

    where = F.lit(folder) if isinstance(folder, str) else folder
    zero = F.lit(0.0)
    place = [F.col(n).cast("double").alias(n) if georeferenced else zero.alias(n) for n in ("a", "c", "e", "f")]
    return tiles.select(where.alias("folder"), "tile_id", "x0", "y0", *place, F.col(bands).alias("bands")).mapInPandas(run, FILE)


def pixel_features(spark: SparkSession, cfg: PipelineConfig, headers: DataFrame, inputs: Sequence, resolve) -> DataFrame:
    """Parts of the inputs' valid polygons as rings and boxes in pixels of their raster."""
    made = None
    for i, raster in _by_id(inputs, headers):
        layer = geopackage.read_layer(spark, str(resolve(i.masks_gpkg)), i.masks_layer).filter(F.col("geom_type").isNotNull())
        layer = layer.withColumn("parts", _in_system(layer, crs.code_of(raster["crs"])))
        rows = labels.explode_parts(layer).select(F.lit(i.id).alias("image_id"), F.col("parts").alias("rings"))
        made = rows if made is None else made.unionByName(rows)
    made = made.filter(labels.valid_polygon(F.col("rings"))).join(headers.select("image_id", "a", "c", "e", "f"), "image_id")
    # Rasters without rotation: each coordinate moves by itself.
    px, py = lambda p: (p["x"] - F.col("c")) / F.col("a"), lambda p: (p["y"] - F.col("f")) / F.col("e")
    moved = F.transform("rings", lambda ring: F.transform(ring, lambda p: F.struct(px(p).alias("x"), py(p).alias("y"))))
    made = made.select("image_id", moved.alias("rings"))
    along = lambda axis: F.transform(F.element_at("rings", 1), lambda p: p[axis])
    ends = {"x1": F.array_min(along("x")), "y1": F.array_min(along("y")), "x2": F.array_max(along("x")), "y2": F.array_max(along("y"))}
    return made.withColumns(ends).withColumn("orig_area", labels.polygon_area(F.col("rings")))


def _in_system(layer: DataFrame, target: int | None) -> Column:
    """The parts of a layer's geometries in the raster's system; as they are where either system is unknown."""
    moved = F.col("parts")
    # Systems that stand in the layer: one, as a rule.
    for (code,) in layer.select("srs_id").distinct().collect() if target else ():
        if code and code > 0 and code != target:
            point = lambda p, code=code: F.struct(*(c.alias(n) for c, n in zip(crs.reproject(p["x"], p["y"], code, target), "xy", strict=True)))
            place = lambda p: point(p)  # noqa: B023, E731
            other = F.transform("parts", lambda part: F.transform(part, lambda ring: F.transform(ring, lambda p: place(p))))  # noqa: B023
            moved = F.when(F.col("srs_id") == code, other).otherwise(moved)
    return moved


def polygon_labels(features: DataFrame, headers: DataFrame, side: int, stride: int, cfg: PipelineConfig) -> tuple[DataFrame, DataFrame]:
    """Hits (polygon parts and the tiles they touch, with their split), and the labels that hold."""
    along = [tiling.tile_count(F.col(n), F.lit(side), F.lit(stride), False) for n in ("h", "w")]
    shape = headers.select("image_id", F.greatest(F.lit(1), F.least(F.lit(cfg.split.block_tiles), *along)).alias("block"))
    hits = labels.join_raster_tiles(features, headers, side, stride, touching=True).join(shape, "image_id")
    hits = split.without_empty_splits(split.with_split(hits, cfg.split.ratios, cfg.split.seed, F.col("block")), cfg.split.ratios)
    x0, y0 = F.col("x0").cast("double"), F.col("y0").cast("double")
    cut = hits.withColumn("cut", labels.clip_polygon(F.col("rings"), bx.Box(x0, y0, x0 + float(side), y0 + float(side)))).filter("cut IS NOT NULL AND cut.area IS NOT NULL")
    share = F.col("cut.area") / F.when(F.col("orig_area") > 0, F.col("orig_area")).otherwise(F.col("cut.area"))
    cut = cut.withColumns({"area_fraction": share, "cx1": F.col("cut.minx") - x0, "cy1": F.col("cut.miny") - y0, "cx2": F.col("cut.maxx") - x0, "cy2": F.col("cut.maxy") - y0})
    return hits, labels.pixel_labels(cut, side, cfg.labels.min_area_fraction, cfg.labels.min_bbox_px, cfg.labels.class_id)


def build_dataset(spark: SparkSession, cfg: PipelineConfig, out: str, resolve=lambda p: p) -> dict:
    """Training tiles, previews, label files, data.yaml and dataset_meta.json under ``out``; the metadata."""
    from ..storage import write_through

    headers, side, stride = sized(write_through(open_inputs(spark, cfg.inputs, resolve), "headers"), cfg)
    features = write_through(pixel_features(spark, cfg, headers, cfg.inputs, resolve), "features")
    hits, made = polygon_labels(features, headers, side, stride, cfg)
    made = write_through(made.drop("rings", "cut"), "labels")
    key = ["image_id", "tile_r", "tile_c"]
    chosen = made.select(*key, "x0", "y0", "tile_id", "split").distinct().join(headers.select("image_id", "path"), "image_id")
    for bands, kind, extension, folder in ((cfg.bands.ms, "pages", "tif", "images"), (cfg.bands.rgb, "png", "png", "images_rgb")):
        pixels = rasters.read_windows(chosen.repartition("image_id", "tile_r"), bands, side)
        pixels = pixels.withColumn("bands", stretch.stretch_all(F.col("bands")))
        write_folders(encoded(pixels, "bands", kind, side, extension, F.concat(F.lit(f"{folder}/"), "split")), out)
    write_folders(tables.label_files(made).select(F.concat(F.lit("labels/"), "split").alias("folder"), "name", "content"), out)
    tables.write_text(tables.data_yaml(out, len(cfg.bands.ms), cfg.labels.class_name), f"{out}/data.yaml")
    shown = [{"id": i.id, "raster": str(resolve(i.raster)), "gpkg": str(resolve(i.masks_gpkg)), "gpkg_layer": i.masks_layer, **_shape(r)} for i, r in _by_id(cfg.inputs, headers)]
    meta = tables.dataset_meta(cfg.run_id, shown, cfg.bands.ms, cfg.bands.rgb, side, stride, cfg.labels.min_area_fraction, cfg.labels.min_bbox_px, cfg.split.ratios, cfg.split.seed, cfg.split.block_tiles, labels.split_counts(made), labels.tiles_without_labels(hits, made))
    tables.write_json(meta, f"{out}/dataset_meta.json")
    return meta


def make_tiles(spark: SparkSession, cfg: PipelineConfig, out: str, input_id: str = "", ms: Sequence[int] = (), rgb: Sequence[int] = (), skip_empty: bool = False, resolve=lambda p: p) -> dict:
    """Stretched tiles that cover the rasters to their edges, and tiles_meta.json, under ``out``; the metadata."""
    from ..storage import write_through

    inputs, ms, rgb = cfg.chosen(input_id), list(ms or cfg.bands.ms), list(rgb or cfg.bands.rgb)
    if not ms or not rgb:
        raise ValueError("bands for the tiles and for their previews must be given")
    headers, side, stride = sized(write_through(open_inputs(spark, inputs, resolve), "headers"), cfg)
    grid = tiling.tile_grid(headers, side, stride, cover_edges=True, carry=("path", "nodata", "a", "c", "e", "f"))
    pixels = rasters.read_windows(grid.repartition("image_id", "tile_r"), [*ms, *rgb], side, boundless=True)
    own = F.slice("bands", 1, len(ms))
    mask = F.when(F.col("nodata").isNull(), stretch.pixel_mask(own, None)).otherwise(stretch.pixel_mask(own, F.col("nodata")))
    pixels = pixels.withColumn("mask", mask).withColumn("empty", stretch.all_masked(F.col("mask")))
    counts = {r["image_id"]: r for r in pixels.groupBy("image_id").agg(F.count("*").alias("n"), F.count_if("empty").alias("empty"), F.max("tile_r").alias("r"), F.max("tile_c").alias("c")).collect()}
    kept = pixels.filter(~F.col("empty")) if skip_empty else pixels
    kept = kept.withColumn("bands", stretch.stretch_all(F.col("bands"), F.col("mask")))
    kept = kept.withColumns({"ms": F.slice("bands", 1, len(ms)), "rgb": F.slice("bands", len(ms) + 1, len(rgb))})
    write_folders(encoded(kept, "ms", "geotiff", side, "tif", "images_ms", georeferenced=True), out)
    write_folders(encoded(kept, "rgb", "png", side, "png", "images_rgb"), out)
    shown = []
    for i, r in _by_id(inputs, headers):
        c = counts.get(i.id)
        skipped = int(c["empty"]) if c and skip_empty else 0
        shown.append({"id": i.id, "raster": str(resolve(i.raster)), **_shape(r), "n_rows": c["r"] + 1 if c else 0, "n_cols": c["c"] + 1 if c else 0, "tiles_written": (c["n"] if c else 0) - skipped, "tiles_skipped_all_nodata": skipped})
        shown[-1].pop("bands_count")
    meta = tables.tiles_meta(shown, side, stride, ms, rgb, skip_empty) | {"out_images_ms_dir": f"{out}/images_ms", "out_images_rgb_dir": f"{out}/images_rgb"}
    tables.write_json(meta, f"{out}/tiles_meta.json")
    return meta


def _by_id(inputs: Sequence, headers: DataFrame) -> list[tuple]:
    """Inputs with their metadata: as many rows as the configuration names."""
    rows = {r["image_id"]: r for r in headers.collect()}
    return [(i, rows[i.id]) for i in inputs]


def _shape(r) -> dict:
    return {"crs": r["crs"], "raster_size_px": [r["w"], r["h"]], "bands_count": r["bands"], "pixel_size": [abs(r["a"]), abs(r["e"])]}


def write_folders(files: DataFrame, out: str) -> int:
    """Write ``(folder, name, content)`` rows under ``out``; the number written."""
    return geopackage.write_files(files.select(F.concat_ws("/", F.nullif("folder", F.lit("")), "name").alias("name"), "content"), out)


def tile_pictures(files: DataFrame, tiles: DataFrame) -> DataFrame:
    """``tiles`` (column tile) with the ``path`` of the picture of the same name but for the extension; those without one are left out."""
    stem = lambda c: F.regexp_replace(F.element_at(F.split(c, "/"), -1), r"\.[^.]*$", "")
    return tiles.join(files.select(stem(F.col("path")).alias("_stem"), "path"), stem(F.col("tile")) == F.col("_stem")).drop("_stem")


def overlays(detections: DataFrame, files: DataFrame, stride: int, min_conf: float = 0.25, thickness: int = 2, write_empty: bool = False, caption: bool = True) -> DataFrame:
    """``(folder, name, content)``: pictures (column path) with the boxes and confidences of their tile drawn in.

    Tiles without a picture are skipped, and pictures without a box unless ``write_empty``.
    """
    # Boxes are held inside the picture once its size is known; here only inside any picture.
    drawn = draw_list(detections.select("tile", "tile_r", "tile_c", "x1", "y1", "x2", "y2", "conf"), stride, 1 << 30, 1 << 30, min_conf)
    boxes = drawn.groupBy("tile").agg(F.sort_array(F.collect_list(F.struct("dx1", "dy1", "dx2", "dy2", "caption"))).alias("boxes"))
    if write_empty:
        stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
        placed = files.select("path", stem.alias("_stem")).join(boxes.withColumn("_stem", F.regexp_replace("tile", r"\.[^.]*$", "")), "_stem", "left")
    else:
        placed = tile_pictures(files, boxes)

    def run(batches):
        for pdf in batches:
            out = []
            for path, found in zip(pdf["path"], pdf["boxes"], strict=True):
                with rasters.Ranges(path) as source:
                    rgb = images.read_png(source.file.read())
                h, w, _ = rgb.shape
                fit = [(min(b["dx1"], w - 1), min(b["dy1"], h - 1), min(b["dx2"], w - 1), min(b["dy2"], h - 1), b["caption"]) for b in (found if found is not None else ())]
                rgb = images.draw_boxes(rgb, [b[:4] for b in fit], thickness=thickness)
                for x1, y1, _, _, text in fit if caption else ():
                    images.draw_text(rgb, text, x1, max(0, y1 - 5))
                out.append(("", path.rsplit("/", 1)[-1].rsplit(".", 1)[0] + ".png", images.png(np.ascontiguousarray(rgb))))
            yield pd.DataFrame(out, columns=["folder", "name", "content"])

    return placed.select("path", "boxes").mapInPandas(run, FILE)
