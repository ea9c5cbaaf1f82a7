"""Command-line entries of the stages: ``python -m tessella.cli STAGE --help``."""

from __future__ import annotations

import argparse
import importlib
import json
import sys
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import boxes as bx
from .functions import naming
from .log import setup_logger
from .operators import evaluate as ev
from .operators import profile, score
from .plans import config, datasets, pipelines
from .schema import require
from .sources import geopackage, rasters, tables
from .storage import write_through

log = setup_logger("tessella")


def session() -> SparkSession:
    """The running session, or a local one where the command was not submitted to a cluster."""
    return SparkSession.getActiveSession() or SparkSession.builder.appName("tessella").getOrCreate()


def _bands(text: str) -> list[int]:
    return [int(x) for x in text.split(",") if x.strip()]


def _loaded(path: str) -> tuple[config.PipelineConfig, Callable[[str], Path]]:
    """The checked configuration; its paths are relative to the folder the command runs in."""
    return config.load_config(path, validate=True), lambda p: config.resolve_path(Path.cwd(), p)


def inspect(args: argparse.Namespace) -> int:
    """Profile every layer of GeoPackage files."""
    spark = session()
    found = [p for given in (args.paths or ["data/external/active"]) for p in (sorted(Path(given).glob("*.gpkg")) if Path(given).is_dir() else [Path(given)])]
    for p in [p for p in found if p.suffix != ".gpkg"]:
        log.warning("not a GeoPackage, skipped: %s", p)
    found = [p for p in found if p.suffix == ".gpkg" and p.exists()]
    if not found:
        log.error("no GeoPackage found")
        return 1
    for p in found:
        layers = geopackage.list_layers(spark, str(p)).collect()
        for layer in layers:
            rows = geopackage.read_layer(spark, str(p), layer["layer"])
            kinds = rows.groupBy("geom_type").count().collect()
            empty = rows.filter("empty").count()
            print(json.dumps({"file": str(p), "layer": layer["layer"], "rows": layer["rows"], "srs_id": layer["srs_id"], "geom_types": {str(k["geom_type"]): k["count"] for k in kinds}, "empty_geoms": empty}))
            if not args.quiet:
                rows.show(5)
    return 0


def build(args: argparse.Namespace) -> int:
    """Training tiles, labels and metadata from a configuration."""
    cfg, resolve = _loaded(args.config)
    meta = datasets.build_dataset(session(), cfg, args.out or str(resolve(f"data/processed/{cfg.run_id}")), resolve)
    log.info("tiles %s, labels %s", meta["stats"]["tiles_written"], meta["stats"]["labels_written"])
    return 0


def tiles(args: argparse.Namespace) -> int:
    """Inference tiles from a configuration."""
    cfg, resolve = _loaded(args.config)
    meta = datasets.make_tiles(session(), cfg, args.out, args.input_id, _bands(args.ms_bands), _bands(args.rgb_bands), args.skip_empty, resolve)
    log.info("tiles %s", {i["id"]: i["tiles_written"] for i in meta["inputs"]})
    return 0


def infer(args: argparse.Namespace) -> int:
    """Score tiles by a model of the user's: ``--model`` names a factory as module:function, called with the options."""
    spark = session()
    module, _, name = args.model.partition(":")
    factory = getattr(importlib.import_module(module), name or "factory")
    stride = json.loads(Path(args.meta).read_text(encoding="utf-8"))["stride"]
    scored = score.score_tiles(tables.read_tiles(spark, args.source), lambda: factory(conf=args.conf, iou=args.iou, max_det=args.max_det, device=args.device), stride, args.conf, args.max_det)
    scored = write_through(scored, "scored")
    tables.write_detections(scored.filter("status = 'ok' AND x1 IS NOT NULL"), args.out)
    log.info("tiles by status: %s", {r["status"]: r["tiles"] for r in profile.status_counts(scored).collect()})
    return 0


def _located(spark: SparkSession, detections: DataFrame, meta: dict, input_id: str) -> tuple[DataFrame, DataFrame]:
    """Detections with ``image_id``, and the rasters of the images that ``meta`` knows."""
    inputs = [{"id": "", "raster": meta["raster"]}] if "raster" in meta and not meta.get("inputs") else meta.get("inputs", [])
    if not inputs:
        raise ValueError("the metadata name no raster")
    if input_id and input_id not in {i["id"] for i in inputs}:
        raise ValueError(f"no input with id {input_id} in the metadata")
    rows = detections.filter(naming.has_prefix(F.col("tile"), input_id)) if input_id else detections
    only = F.lit(inputs[0]["id"]) if len(inputs) == 1 else naming.image_prefix(F.col("tile"))
    rows = rows.withColumn("image_id", F.lit(input_id) if input_id else F.coalesce(only, F.lit("")))
    files = spark.createDataFrame([(i["id"], str(config.resolve_path(Path.cwd(), i["raster"]))) for i in inputs], "id string, path string")
    return rows.withColumn("det_id", F.monotonically_increasing_id()), rasters.raster_headers(files, F.col("id"))


def _read_predictions(spark: SparkSession, path: str, meta: str) -> tuple[DataFrame, dict]:
    return tables.read_detections(spark, path), json.loads(Path(meta).read_text(encoding="utf-8"))


def _write_results(kept: DataFrame, placed: DataFrame, out: str, layer: str, stem: str, crs: str) -> None:
    tables.write_detections(kept, f"{out}/{stem}.csv", sort=True)
    columns = ["image_id", *(c for c in kept.columns if c not in ("image_id", "det_id")), "minx", "miny", "maxx", "maxy"]
    log.info("%d GeoPackages", geopackage.write_packages(placed.select(*columns), out, layer, crs=crs, stem=stem))


def merge(args: argparse.Namespace) -> int:
    """Suppress overlapping and nested detections per image and class; write CSV and GeoPackages."""
    spark = session()
    found, meta = _read_predictions(spark, args.pred_csv, args.meta)
    rows, headers = _located(spark, found, meta, args.input_id)
    rows = write_through(rows, "detections")
    missing = pipelines.images_without_raster(rows, headers).collect()
    for r in missing:
        log.warning("no raster for %s: %d detections left out", r["image_id"], r["n"])
    kept = write_through(pipelines.merge_detections(rows, args.min_conf, args.nms_iou, args.coverage_thresh, args.contain_tol_px, args.score_margin), "merged")
    before, after = rows.count(), kept.count()
    log.info("%d of %d detections stay", after, before)
    _write_results(kept, pipelines.georeference(kept, headers), args.out, "detections", "detections_merged", "undefined")
    return 0


def export(args: argparse.Namespace) -> int:
    """Filter, optionally deduplicate, and write detections as GeoPackages."""
    spark = session()
    found, meta = _read_predictions(spark, args.pred, args.tiles_meta)
    rows, headers = _located(spark, require(found, ["tile", "x1", "y1", "x2", "y2", "conf"]), meta, args.input_id)
    kept = write_through(pipelines.export_detections(write_through(rows, "detections"), args.min_conf, args.dedup, args.dedup_by_class, args.contain_thr, args.contain_tol_px, args.dup_iou), "exported")
    target = Path(args.out_gpkg)
    placed = pipelines.georeference(kept, headers).drop("det_id")
    log.info("%d GeoPackages", geopackage.write_packages(placed, str(target.parent), args.layer, crs=args.crs_override or "undefined", stem=target.stem))
    return 0


def render(args: argparse.Namespace) -> int:
    """Draw detections into the RGB previews of their tiles."""
    spark = session()
    found = require(tables.read_detections(spark, args.pred), ["tile", "tile_r", "tile_c", "x1", "y1", "x2", "y2", "conf"])
    pictures = tables.list_tiles(spark, args.rgb_dir).filter(F.lower("path").endswith(".png")).select("path")
    made = datasets.overlays(found, pictures, args.stride, args.min_conf, args.thickness, args.write_empty)
    log.info("%d overlays", datasets.write_folders(made, args.out))
    return 0


def evaluate(args: argparse.Namespace) -> int:
    """Measure stored detections (CSV or Parquet) against stored ground truth (Parquet with image_id, class_id, gt_id, x1..y2)."""
    spark = session()
    truth = spark.read.parquet(args.data)
    found = spark.read.parquet(args.pred) if Path(args.pred).is_dir() and any(Path(args.pred).glob("*.parquet")) else tables.read_detections(spark, args.pred)
    if "image_id" not in found.columns:
        found = found.withColumn("image_id", F.coalesce(naming.image_prefix(F.col("tile")), F.lit("")))
    if "det_id" not in found.columns:
        found = found.withColumn("det_id", F.monotonically_increasing_id())
    found = write_through(found.filter(bx.confident(F.col("conf"), args.conf_threshold)), "predictions")
    scores = ev.evaluate(found, truth, None, args.iou_threshold).first()
    means = ev.mean_average_precision(found, truth).first()
    metrics = {"mAP@0.5": means["map50"], "mAP@0.5:0.95": means["map50_95"], "precision": scores["precision"], "recall": scores["recall"]}
    tables.write_json({"model": args.model, "data": args.data, "conf_threshold": args.conf_threshold, "iou_threshold": args.iou_threshold} | metrics, f"{args.output_dir}/metrics.json")
    report = tables.metrics_report(args.model, args.data, args.conf_threshold, args.iou_threshold, metrics)
    tables.write_text(report, f"{args.output_dir}/report.txt")
    print(report)
    return 0


def parser() -> argparse.ArgumentParser:
    # The options' names and what they are if not given.
    top = argparse.ArgumentParser(prog="tessella", description=__doc__)
    stages = top.add_subparsers(dest="stage", required=True)

    def stage(run: Callable[[argparse.Namespace], int], needed: Sequence[str] = (), **options) -> argparse.ArgumentParser:
        p = stages.add_parser(run.__name__, help=(run.__doc__ or "").splitlines()[0])
        for name in needed:
            p.add_argument(f"--{name}", required=True)
        for name, value in options.items():
            if value is False:
                p.add_argument(f"--{name}", action="store_true")
            else:
                p.add_argument(f"--{name}", default=value, type=type(value))
        p.set_defaults(run=run)
        return p

    stage(inspect, quiet=False).add_argument("paths", nargs="*")
    stage(build, config="configs/pipeline.yaml", out="")
    stage(tiles, ["out"], config="configs/pipeline.yaml", input_id="", ms_bands="", rgb_bands="", skip_empty=False)
    stage(infer, ["model", "source", "meta", "out"], conf=0.25, iou=0.6, max_det=300, device="auto")
    stage(merge, ["pred_csv", "out"], meta="dataset_meta.json", input_id="", min_conf=0.0, nms_iou=0.30, coverage_thresh=0.85, contain_tol_px=3.0, score_margin=0.0)
    stage(export, ["pred", "tiles_meta", "out_gpkg", "layer"], input_id="", min_conf=0.25, dedup=False, dedup_by_class=False, contain_thr=0.9, contain_tol_px=3.0, dup_iou=0.9, crs_override="")
    stage(render, ["pred", "rgb_dir", "out"], tile_size=512, min_conf=0.25, thickness=2, write_empty=False).add_argument("--stride", type=int, required=True)
    stage(evaluate, ["model", "pred", "data"], conf_threshold=0.25, iou_threshold=0.5, split="val", output_dir="outputs/evaluation")
    return top


def main(argv: Sequence[str] | None = None) -> int:
    """Run one stage; 1 where its input is missing or wrong, 130 where it was interrupted."""
    args = parser().parse_args(argv)
    try:
        return args.run(args)
    except KeyboardInterrupt:
        return 130
    except (ValueError, FileNotFoundError) as fault:
        log.error("%s", fault)
        return 1


if __name__ == "__main__":
    sys.exit(main())
