"""Operators that the SQL check does not reach: draws, clips, files, configuration, scoring, streaming."""

import json
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.functions import boxes as bx
from tessella.functions import georef
from tessella.log import enable_debug_mode, setup_logger
from tessella.operators import evaluate as ev
from tessella.operators import labels, score, split, stretch, tiling
from tessella.plans import config
from tessella.plans.pipelines import draw_list
from tessella.sources import geopackage, images, tables
from tessella.streaming import ingest


def test_split_draws_are_pythons(spark):
    assert [split.split_of(random.Random(split.block_key(6 * k, 0, 6) + 42).random(), {"train": 0.7, "val": 0.2}) for k in range(3)] == ["train", "test", "train"]
    grid = spark.range(400).select((F.col("id") % 20).alias("tile_r"), F.floor(F.col("id") / 20).alias("tile_c"))
    ratios = {"train": 0.7, "val": 0.3, "test": 0.0}
    for r in split.with_split(grid, ratios, 42, 6).collect():
        assert r.split == split.split_of(random.Random(split.block_key(r.tile_r, r.tile_c, 6) + 42).random(), ratios)
    assert {r.split for r in split.without_empty_splits(split.with_split(grid, {"train": 0.5, "val": 0.0, "test": 0.5}, 1, 2), {"train": 0.5, "val": 0.0, "test": 0.5}).collect()} <= {"train", "test"}


def test_tile_grid_edges(spark):
    sizes = spark.createDataFrame([("a", 300, 256), ("b", 200, 256), ("c", 100, 256)], "image_id string, w int, h int")
    count = lambda cover: {r.image_id: r["count"] for r in tiling.tile_grid(sizes, 256, 64, cover).groupBy("image_id").count().collect()}
    assert count(False) == {"a": 1}
    assert count(True) == {"a": 2, "b": 1}
    with pytest.raises(ValueError):
        tiling.checked_tile_size(500)
    with pytest.raises(ValueError):
        tiling.stride_of(256, 1.5)
    two = spark.createDataFrame([(256, 64), (512, 64)], "tile_size int, stride int")
    with pytest.raises(ValueError):
        tiling.uniform_tiling(two)


def test_clip_of_concave_ring():
    # A "U" whose notch spans the window's lower half: the window's bottom edge is outside.
    ring = np.array([(0, 0), (10, 0), (10, 10), (8, 10), (8, 2), (2, 2), (2, 10), (0, 10), (0, 0)], float)
    area, *bounds = labels.clip_rings([ring], (1, 1, 9, 9))
    assert area == pytest.approx(8 * 1 + 2 * 1 * 7)
    assert bounds == [1, 1, 9, 9]
    area, *bounds = labels.clip_rings([ring], (0, 5, 10, 20))
    assert area == pytest.approx(2 * 2 * 5) and bounds == [0, 5, 10, 10]
    assert labels.clip_rings([ring], (3, 3, 7, 7)) is None


def test_polygon_expressions(spark):
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
    hole = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0), (1.0, 1.0)]
    bow = [(0.0, 0.0), (4.0, 4.0), (4.0, 0.0), (0.0, 4.0), (0.0, 0.0)]
    df = spark.createDataFrame([(1, [square, hole]), (2, [bow]), (3, [square[:3]])], "id int, rings array<array<struct<x double, y double>>>")
    w = bx.Box(F.lit(1.5), F.lit(1.5), F.lit(3.0), F.lit(3.0))
    rows = {r.id: r for r in df.select("id", labels.valid_polygon(F.col("rings")).alias("ok"), labels.polygon_area(F.col("rings")).alias("area"), labels.clip_polygon(F.col("rings"), w).alias("c")).collect()}
    assert [rows[i].ok for i in (1, 2, 3)] == [True, False, False]
    assert rows[1].area == 15 and rows[1].c.area == pytest.approx(2.25 - 0.25)


def test_stretch_equals_numpy(spark):
    rng = np.random.default_rng(0)
    bands = [rng.normal(0, 9, 70).tolist(), [1.0] * 60, [float("nan")] * 30 + rng.random(60).tolist(), rng.random(20).tolist(), []]
    df = spark.createDataFrame(list(enumerate(bands)), "id int, pixels array<double>")
    for r in stretch.stretch_bands(df).collect():
        v = np.array(bands[r.id])
        ok = np.isfinite(v)
        want = np.zeros(len(v), int)
        if ok.sum() >= 50:
            lo, hi = np.percentile(v[ok], [2, 98])
            if hi - lo >= 1e-6:
                want[ok] = (np.clip((v[ok] - lo) / (hi - lo), 0, 1) * 255).astype(int)
        assert r.bytes == want.tolist()


def test_matching_and_precision(spark):
    box = "image_id string, class_id int, det_id long, x1 double, y1 double, x2 double, y2 double, conf double"
    p = spark.createDataFrame([("i", 0, 1, 0.0, 0.0, 10.0, 10.0, 0.5), ("i", 0, 2, 0.0, 0.0, 10.0, 9.0, 0.9), ("i", 0, 3, 50.0, 50.0, 60.0, 60.0, 0.8), ("i", 0, 4, 20.0, 0.0, 30.0, 10.0, 0.7)], box)
    g = spark.createDataFrame([("i", 0, 1, 0.0, 0.0, 10.0, 10.0), ("i", 0, 2, 21.0, 0.0, 31.0, 10.0)], "image_id string, class_id int, gt_id long, x1 double, y1 double, x2 double, y2 double")
    m = ev.greedy_match(p, g, 0.5)
    assert {r.det_id: r.matched_gt for r in m.collect()} == {1: 1, 2: None, 3: None, 4: 2}
    curve = {r.seq: (r.det_id, r.precision) for r in ev.pr_curve(m, 2).collect()}
    assert curve == {1: (2, 0.0), 2: (3, 0.0), 3: (4, 1 / 3), 4: (1, 0.5)}
    out = ev.evaluate(p, g, 0).first()
    assert out.ap == pytest.approx(10 * 0.5 / 11) and out.precision == 0.5
    none = ev.evaluate(p.limit(0), g).first()
    assert (none.ap, none.precision, none.recall) == (0, 0, 0)
    best = ev.mean_average_precision(p, g, (0.5, 0.95)).first()
    assert best.map50 == pytest.approx(10 * 0.5 / 11) and best.map50_95 < best.map50
    assert {(r.true_class, r.pred_class): r.n for r in ev.confusion_matrix(m, g).collect()} == {(0, 0): 2, (-1, 0): 2}


def test_rectangles_as_wkb_and_wkt(spark):
    df = spark.createDataFrame([(1.5, -2.25, 1e6 + 0.1, 0.0)], "x1 double, y1 double, x2 double, y2 double")
    r = df.select(georef.wkb(bx.Box.of()).alias("b"), georef.wkt(bx.Box.of()).alias("t")).first()
    x = struct.unpack(">BIII10d", bytes(r.b))
    assert x[:4] == (0, 3, 1, 5)
    assert x[4:] == (1e6 + 0.1, -2.25, 1e6 + 0.1, 0.0, 1.5, 0.0, 1.5, -2.25, 1e6 + 0.1, -2.25)
    assert r.t.startswith("POLYGON ((1000000.1 -2.25, ")


def test_pictures_round_trip():
    rng = np.random.default_rng(1)
    chw = rng.integers(0, 256, (4, 20, 30)).astype(np.uint8)
    assert (images.read_tiff(images.multipage_tiff(chw)) == chw).all()
    data = images.geotiff(chw, (10.0, 0.0, 500.0, 0.0, -10.0, 900.0), nodata=7)
    assert (images.read_tiff(data) == chw).all()
    assert images.tiff_header(data) == {"w": 30, "h": 20, "bands": 4, "transform": (10.0, 0.0, 500.0, 0.0, -10.0, 900.0), "nodata": 7.0}
    rgb = chw[:3].transpose(1, 2, 0)
    assert (images.read_png(images.png(rgb)) == rgb).all()
    assert images.draw_boxes(rgb, [(2, 2, 10, 10)])[2, 5].tolist() == [0, 255, 0]
    with pytest.raises(ValueError):
        images.multipage_tiff(chw.astype(float))


def test_geopackage_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, 0.5, 0.0, 0.0, 2.0, 3.0), ("b", 2, 0.7, 1.0, 1.0, 2.0, 2.0)], "image_id string, det_id long, conf double, minx double, miny double, maxx double, maxy double")
    assert geopackage.write_files(geopackage.package_per_image(rows, srs_id=32633, crs="x"), str(tmp_path / "g")) == 2
    assert [(r.layer, r.rows, r.srs_id) for r in geopackage.list_layers(spark, str(tmp_path / "g")).collect()] == [("detections", 1, 32633)] * 2
    f = {r.attributes["det_id"]: r for r in geopackage.read_layer(spark, str(tmp_path / "g")).collect()}
    assert f["1"].geom_type == "Polygon" and (f["1"].minx, f["1"].maxy) == (0.0, 3.0) and len(f["1"].parts[0][0]) == 5
    parts = labels.explode_parts(geopackage.read_layer(spark, str(tmp_path / "g"), "detections"))
    assert sorted(r.area for r in parts.select(labels.polygon_area(F.col("parts")).alias("area")).collect()) == [1.0, 6.0]


def test_detections_csv(spark, tmp_path):
    row = ("tile_a_r0001_c0002.tif", 1, 2, 0.0, 1.0, 2.0, 3.0, 0.5, 0)
    df = spark.createDataFrame([row], tables.DETECTION)
    tables.write_detections(df, str(tmp_path / "d"))
    assert [tuple(r) for r in tables.read_detections(spark, str(tmp_path / "d")).collect()] == [row]
    tables.write_detections(df.limit(0), str(tmp_path / "e"))
    assert tables.read_detections(spark, str(tmp_path / "e")).count() == 0
    d = draw_list(df.withColumn("x1", F.lit(150.5)), 64, 256, 256).first()
    assert (d.dx1, d.dx2, d.caption) == (0, 22, "0.50")


def test_scoring_keeps_errors_as_rows(spark):
    rows = [("tile_a_r0001_c0002.tif", b"x"), ("bad.tif", b"x"), ("tile_a_r0000_c0000.png", None), ("tile_a_r0000_c0001.png", b"boom"), ("tile_a_r0000_c0003.png", b"none")]

    def factory():
        def scorer(data):
            if data == b"boom":
                raise RuntimeError
            return [] if data == b"none" else [(1, 2, 3, 4, 0.9, 1), (0, 0, 1, 1, 0.1, 0)]

        return scorer

    out = {r.tile: r for r in score.score_tiles(spark.createDataFrame(rows, "tile string, content binary"), factory, 64).collect()}
    assert [out[t].status for t, _ in rows] == ["ok", "bad_name", "failed_read", "failed_infer", "ok"]
    assert (out[rows[0][0]].x1, out[rows[0][0]].y1) == (129.0, 66.0) and out[rows[4][0]].x1 is None


def test_configuration(tmp_path):
    good = {"run_id": "r", "inputs": [{"id": "a", "raster": "a.tif", "masks_gpkg": "a.gpkg"}], "split": {"ratios": {"train": 0.7, "val": 0.3, "test": 0.0}}}
    cfg = config.validate_config(good)
    assert cfg.split.test == 0 and cfg.tiling.tile_size_px == 512
    flat = config.validate_config(good | {"split": {}})
    assert (flat.split.train, flat.split.val, flat.split.test) == (0.7, 0.2, 0.1)
    for bad in ({"tiling": {"tile_size_px": 500}}, {"tiling": {"overlap_fraction": 1.5}}, {"tiling": {"stride_frac": 0}}, {"split": {"train": 0.5, "val": 0.3, "test": 0.3}}, {"inputs": []}, {"run_id": None}, {"inputs": [{"id": "a"}]}, {"bands": {"ms": "1"}}, {"labels": {"buffer_m": -1}}, {"split": {"ratios": {"dev": 1.0}}}, {"tiling": {"tile_size_px": True}}):
        with pytest.raises(ValueError):
            config.validate_config(good | bad)
    with pytest.raises(FileNotFoundError):
        config.load_config(tmp_path / "no.yaml")
    (tmp_path / "bad.yaml").write_text("run_id: \"open\ninputs: {{")
    with pytest.raises(ValueError, match="no YAML"):
        config.load_config(tmp_path / "bad.yaml")
    (tmp_path / "c.yaml").write_text(json.dumps(good))
    assert config.load_config(tmp_path / "c.yaml", validate=True).run_id == "r"
    assert config.resolve_path("/x", "/y/z").as_posix() == "/y/z" and config.resolve_path("/x", "./y").as_posix() == "/x/y"
    assert config.checked_tile_size({}) == 512 and config.model_size("w/net11s.pt") == "s"
    assert cfg.labels.object_class == "circle" and cfg.split.strategy == "block" and cfg.chosen("a")[0].masks_layer == ""
    with pytest.raises(ValueError):
        config.checked_tile_size({"tile_size": 32})


def test_logger(tmp_path):
    log = setup_logger("t", log_file=tmp_path / "x" / "t.log", console=False)
    log.info("hello")
    enable_debug_mode(log)
    assert "hello" in (tmp_path / "x" / "t.log").read_text()


def test_stream_of_detections(spark, tmp_path):
    for k, conf in enumerate((0.5, 0.9)):
        df = spark.createDataFrame([("tile_a_r0000_c0000.tif", 0, 0, 0.0, 0.0, 10.0, 10.0 + k, conf, 0)], tables.DETECTION)
        df.write.mode("append").option("header", True).csv(str(tmp_path / "in"))
    stream = ingest.arriving_detections(spark, str(tmp_path / "in"), 1)
    ingest.merge_arriving(stream, str(tmp_path / "s"), str(tmp_path / "c")).awaitTermination()
    assert [r.conf for r in spark.read.parquet(str(tmp_path / "s-merged")).collect()] == [0.9]


def test_coordinate_systems(spark):
    """A published place, corners of the grid, and the way there and back."""
    from tessella.functions import crs

    def at(x, y, source, target):
        a, b = crs.reproject(F.lit(x), F.lit(y), source, target)
        return tuple(spark.range(1).select(a, b).first())

    # The CN Tower: 43 38 33.24 N, 79 23 13.7 W is 17 T 630084 4833438.
    assert at(-(79 + 23 / 60 + 13.7 / 3600), 43 + 38 / 60 + 33.24 / 3600, 4326, 32617) == pytest.approx((630084, 4833438), abs=1)
    assert at(15.0, 0.0, 4326, 32633) == pytest.approx((500000, 0), abs=1e-6) and at(15.0, 0.0, 4326, 32733) == pytest.approx((500000, 1e7), abs=1e-6)
    assert at(180.0, 0.0, 4326, 3857) == pytest.approx((20037508.342789, 0), abs=1e-5)
    assert at(*at(611234.5, 4321987.25, 32633, 4326), 4326, 32633) == pytest.approx((611234.5, 4321987.25), abs=1e-3)
    assert crs.code_of("EPSG:32633") == 32633 and crs.code_of("local") is None
    with pytest.raises(ValueError):
        crs.reproject(F.lit(0.0), F.lit(0.0), 2154, 4326)
