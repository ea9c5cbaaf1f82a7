"""Every stage from the command line, on one small made-up raster with known objects."""

import json

import numpy as np
import pandas as pd
import pytest

from tessella import cli
from tessella.sources import geopackage, images, rasters

SIDE, STRIDE = 96, 48
SCORER = '''
import numpy as np

from tessella.sources import images


def factory(conf, iou, max_det, device):
    """Finds the bright square of the first tile and nothing else."""

    def scorer(data):
        chw = images.read_tiff(bytes(data)).astype(int)
        square = min(chw[:, 30:34, 20:60].mean(), chw[:, 66:70, 20:60].mean())
        around = np.concatenate([chw[:, :30].ravel(), chw[:, 70:].ravel()]).mean()
        beside = chw[:, 30:70, 60:].mean()
        return [(20, 30, 60, 70, 0.875, 0)] if square > 1.8 * around and square > 1.8 * beside else []

    return scorer
'''
OBJECTS = [(20, 30, 60, 70), (110, 100, 160, 150), (200, 20, 240, 60), (300, 260, 340, 300)]


@pytest.fixture(scope="module")
def place(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("cli")
    rng = np.random.default_rng(0)
    chw = rng.integers(1, 120, (4, 300, 350)).astype(np.uint8)
    for x1, y1, x2, y2 in OBJECTS:
        chw[:, y1:y2, x1:x2] += 100
    chw[:, 250:, :100] = 0
    (root / "a.tif").write_bytes(images.geotiff(chw, (10.0, 0.0, 5000.0, 0.0, -10.0, 9000.0), nodata=0))
    boxes = pd.DataFrame([(5000 + 10.0 * x1, 9000 - 10.0 * y2, 5000 + 10.0 * x2, 9000 - 10.0 * y1, k) for k, (x1, y1, x2, y2) in enumerate(OBJECTS)], columns=["minx", "miny", "maxx", "maxy", "object"])
    (root / "a.gpkg").write_bytes(geopackage.package_bytes(boxes, "things"))
    cfg = {"run_id": "r", "inputs": [{"id": "a", "raster": str(root / "a.tif"), "masks_gpkg": str(root / "a.gpkg")}], "bands": {"ms": [1, 2, 3, 4], "rgb": [4, 3, 2]}, "tiling": {"tile_size_px": SIDE, "stride_frac": 0.5}, "split": {"ratios": {"train": 0.7, "val": 0.3}, "block_tiles": 2}}
    (root / "c.yaml").write_text(json.dumps(cfg))
    return root, chw


def test_ranged_reads_equal_the_picture(spark, place):
    root, chw = place
    with rasters.Ranges(str(root / "a.tif")) as source:
        r = rasters.open_raster(source)
        assert (r.width, r.height, r.bands, r.nodata, r.transform) == (350, 300, 4, 0.0, (10.0, 0.0, 5000.0, 0.0, -10.0, 9000.0))
        assert (r.window(source, 3, 40, 50, 7, 9) == chw[2, 50:59, 40:47]).all()
        assert (r.window(source, 1, 0, 0, 350, 300) == chw[0]).all()
        beyond = r.window(source, 2, 340, -5, 20, 10, 7)
        assert (beyond[5:, :10] == chw[1, :5, 340:]).all() and (beyond[:5] == 7).all() and (beyond[:, 10:] == 7).all()
        assert (r.window(source, 1, 900, 900, 3, 3) == 0).all()
        with pytest.raises(ValueError):
            r.window(source, 5, 0, 0, 1, 1)
    (root / "pages.tiff").write_bytes(images.multipage_tiff(chw))
    with rasters.Ranges(str(root / "pages.tiff")) as source:
        r = rasters.open_raster(source)
        assert r.bands == 4 and r.transform is None and (r.window(source, 4, 3, 2, 11, 5) == chw[3, 2:7, 3:14]).all()


def test_windows_of_a_table(spark, place):
    root, chw = place
    rows = [(str(root / "a.tif"), x, y) for x, y in ((0, 0), (300, 250), (120, 33))] + [(None, 0, 0)]
    df = spark.createDataFrame(rows, "path string, x0 int, y0 int")
    got = {(r.x0, r.y0, r.path is None): r.bands for r in rasters.read_windows(df, [2, 4], 64, boundless=True).collect()}
    assert got[0, 0, True] is None
    assert got[120, 33, False] == [chw[b, 33:97, 120:184].ravel().astype(float).tolist() for b in (1, 3)]
    padded = np.zeros((64, 64))
    padded[:50, :50] = chw[1, 250:, 300:]
    assert got[300, 250, False][0] == padded.ravel().tolist()
    cut = {(r.x0, r.y0): r.bands for r in rasters.read_windows(df.filter("path IS NOT NULL"), [1], 64).collect()}
    assert len(cut[300, 250][0]) == 50 * 50


def test_stages(spark, place, capsys):
    root, chw = place
    run = lambda *args: cli.main([str(a) for a in args])
    assert run("inspect", root, "--quiet") == 0 and '"rows": 4' in capsys.readouterr().out
    assert run("inspect", root / "nothing") == 1
    assert run("build", "--config", root / "c.yaml", "--out", root / "data") == 0
    meta = json.loads((root / "data/dataset_meta.json").read_text())
    labels = sorted((root / "data/labels").rglob("*.txt"))
    assert meta["tile_size"] == SIDE and sum(meta["stats"]["tiles_written"].values()) == len(labels) > 8
    assert sum(meta["stats"]["labels_written"].values()) == sum(len(p.read_text().splitlines()) for p in labels)
    for p in labels:
        picture = root / "data/images" / p.parent.name / f"{p.stem}.tif"
        assert images.read_tiff(picture.read_bytes()).shape == (4, SIDE, SIDE)
        assert (root / "data/images_rgb" / p.parent.name / f"{p.stem}.png").exists()
    # The first tile holds the first object whole.
    first = next(p for p in labels if p.stem == "tile_a_r0000_c0000").read_text().splitlines()
    assert f"0 {40 / SIDE:.6f} {50 / SIDE:.6f} {40 / SIDE:.6f} {40 / SIDE:.6f}" in first
    assert "channels: 4" in (root / "data/data.yaml").read_text()

    assert run("tiles", "--config", root / "c.yaml", "--out", root / "t", "--skip_empty") == 0
    meta = json.loads((root / "t/tiles_meta.json").read_text())
    assert meta["inputs"][0]["n_rows"] == 6 and meta["inputs"][0]["n_cols"] == 7 and meta["raster"] == str(root / "a.tif")
    assert meta["inputs"][0]["tiles_written"] + meta["inputs"][0]["tiles_skipped_all_nodata"] == 42
    assert len(list((root / "t/images_ms").glob("*.tif"))) == meta["inputs"][0]["tiles_written"] == len(list((root / "t/images_rgb").glob("*.png")))

    (root / "a_scorer_for_tests.py").write_text(SCORER)
    spark.sparkContext.addPyFile(str(root / "a_scorer_for_tests.py"))
    assert run("infer", "--model", "a_scorer_for_tests:factory", "--source", root / "t/images_ms", "--meta", root / "t/tiles_meta.json", "--out", root / "p") == 0
    assert run("merge", "--pred_csv", root / "p", "--meta", root / "t/tiles_meta.json", "--out", root / "m") == 0
    merged = pd.concat(pd.read_csv(p) for p in (root / "m/detections_merged.csv").glob("*.csv"))
    assert sorted(map(tuple, merged[["x1", "y1", "x2", "y2"]].astype(int).values.tolist())) == sorted(OBJECTS[:1])
    layers = geopackage.read_layer(spark, str(root / "m")).collect()
    assert [(r.layer, r.minx, r.maxy) for r in layers] == [("detections", 5200.0, 8700.0)]
    assert run("export", "--pred", root / "p", "--tiles_meta", root / "t/tiles_meta.json", "--out_gpkg", root / "e/out.gpkg", "--layer", "found", "--dedup") == 0
    assert [r.layer for r in geopackage.read_layer(spark, str(root / "e")).collect()] == ["found"]
    assert run("render", "--pred", root / "p", "--rgb_dir", root / "t/images_rgb", "--out", root / "o", "--stride", STRIDE) == 0
    drawn = sorted(p.name for p in (root / "o").glob("*.png"))
    assert drawn == ["tile_a_r0000_c0000.png"]
    rgb = images.read_png((root / "o" / drawn[0]).read_bytes())
    assert rgb[30, 40].tolist() == [0, 255, 0] and (rgb[15:30, 20:50] == [0, 255, 0]).all(axis=2).sum() > 20
    truth = spark.createDataFrame([("a", 0, k, *map(float, b)) for k, b in enumerate(OBJECTS)], "image_id string, class_id int, gt_id long, x1 double, y1 double, x2 double, y2 double")
    truth.write.parquet(str(root / "truth"))
    assert run("evaluate", "--model", "m", "--pred", root / "p", "--data", root / "truth", "--output_dir", root / "v") == 0
    scores = json.loads((root / "v/metrics.json").read_text())
    assert scores["precision"] == 1.0 and scores["recall"] == pytest.approx(0.25, abs=1e-6)
    assert run("merge", "--pred_csv", root / "p", "--meta", root / "t/tiles_meta.json", "--out", root / "m2", "--input_id", "zz") == 1


def test_layers_in_another_system(spark, tmp_path):
    """A raster of a UTM zone and a layer in degrees: labels are those of the same boxes in the raster's system."""
    from pyspark.sql import functions as F

    from tessella.functions import crs
    from tessella.plans import config, datasets

    chw = np.random.default_rng(1).integers(1, 200, (3, 200, 200)).astype(np.uint8)
    (tmp_path / "a.tif").write_bytes(images.geotiff(chw, (10.0, 0.0, 500000.0, 0.0, -10.0, 5000000.0), epsg=32633))
    found = [(20.5, 30.5, 60.5, 70.5), (110.5, 100.5, 160.5, 150.5)]
    corners = spark.createDataFrame([(k, 500000 + 10 * x, 5000000 - 10 * y) for k, b in enumerate(found) for x, y in (b[:2], b[2:])], "k int, x double, y double")
    lon, lat = crs.reproject(F.col("x"), F.col("y"), 32633, 4326)
    degrees = corners.select("k", lon.alias("lon"), lat.alias("lat")).groupBy("k").agg(F.min("lon").alias("minx"), F.min("lat").alias("miny"), F.max("lon").alias("maxx"), F.max("lat").alias("maxy")).toPandas()
    (tmp_path / "a.gpkg").write_bytes(geopackage.package_bytes(degrees[["minx", "miny", "maxx", "maxy", "k"]], "things", 4326, "WGS 84"))
    cfg = config.validate_config({"run_id": "r", "inputs": [{"id": "a", "raster": str(tmp_path / "a.tif"), "masks_gpkg": str(tmp_path / "a.gpkg")}], "bands": {"ms": [1], "rgb": [1, 2, 3]}, "tiling": {"tile_size_px": 96, "stride_frac": 1.0}, "split": {"ratios": {"train": 1.0}}})
    meta = datasets.build_dataset(spark, cfg, str(tmp_path / "out"))
    assert meta["inputs"][0]["crs"] == "EPSG:32633" and meta["stats"]["labels_written"]["train"] == 2
    first = (tmp_path / "out/labels/train/tile_a_r0000_c0000.txt").read_text()
    assert first == f"0 {40 / 96:.6f} {50 / 96:.6f} {40 / 96:.6f} {40 / 96:.6f}\n"


def _packed(data):
    """LZW by the format's description: the table's code 511 makes codes ten bits long, and so on."""
    out, bits = 0, 0

    def put(code, width):
        nonlocal out, bits
        out, bits = out << width | code, bits + width

    fresh = lambda: {bytes([k]): k for k in range(256)}
    table, nxt, width, run = fresh(), 258, 9, b""
    put(256, 9)
    for k in range(len(data)):
        c = data[k : k + 1]
        if run + c in table:
            run += c
            continue
        put(table[run], width)
        table[run + c] = nxt
        nxt += 1
        if nxt == 4094:
            put(256, width)
            table, nxt, width = fresh(), 258, 9
        else:
            width = 9 + (nxt > 511) + (nxt > 1023) + (nxt > 2047)
        run = c
    if run:
        put(table[run], width)
        nxt += 1
        width = 9 + (nxt > 511) + (nxt > 1023) + (nxt > 2047)
    put(257, width)
    return (out << -bits % 8).to_bytes(-(-bits // 8), "big")


@pytest.mark.parametrize("code, predictor", [(1, 1), (8, 1), (8, 2), (5, 1), (5, 2)])
@pytest.mark.parametrize("tiled", [False, True])
@pytest.mark.parametrize("apart", [False, True])
def test_compressed_and_tiled(tmp_path, code, predictor, tiled, apart):
    """16-bit samples in strips or tiles, plain, deflated or by LZW, as differences or not, by band or by pixel."""
    import struct
    import zlib

    rng = np.random.default_rng(2)
    hwc = (rng.integers(0, 40, (70, 90, 2)).cumsum(axis=1) * 13).astype("<u2")
    th, tw = (32, 48) if tiled else (16, 90)
    blocks = []
    for planes in ([hwc[:, :, :1], hwc[:, :, 1:]] if apart else [hwc]):
        for r in range(0, 70, th):
            for c in range(0, 90, tw):
                part = planes[r : r + th, c : c + tw]
                if tiled:
                    part = np.pad(part, ((0, th - part.shape[0]), (0, tw - part.shape[1]), (0, 0)))
                if predictor == 2:
                    part = np.diff(part, axis=1, prepend=np.zeros_like(part[:, :1]))
                raw = np.ascontiguousarray(part, "<u2").tobytes()
                blocks.append(zlib.compress(raw) if code == 8 else _packed(raw) if code == 5 else raw)
    starts = np.cumsum([8] + [len(b) for b in blocks])
    entries = [images._long(256, 90), images._long(257, 70), images._short(258, 16, 16), images._short(259, code), images._short(277, 2), images._short(284, 2 if apart else 1), images._short(317, predictor)]
    if tiled:
        entries += [images._long(322, tw), images._long(323, th), images._long(324, *starts[:-1].tolist()), images._long(325, *(len(b) for b in blocks))]
    else:
        entries += [images._long(278, th), images._long(273, *starts[:-1].tolist()), images._long(279, *(len(b) for b in blocks))]
    data = struct.pack("<2sHI", b"II", 42, int(starts[-1])) + b"".join(blocks) + images._directory(entries, int(starts[-1]), False)
    (tmp_path / "x.tif").write_bytes(data)
    with rasters.Ranges(str(tmp_path / "x.tif")) as source:
        r = rasters.open_raster(source)
        for b in (1, 2):
            assert (r.window(source, b, 0, 0, 90, 70) == hwc[:, :, b - 1]).all()
            assert (r.window(source, b, 37, 25, 30, 40) == hwc[25:65, 37:67, b - 1]).all()
    assert (images.read_tile("x.tif", data) == hwc.astype(np.uint8)).all()


def test_lzw_of_long_data():
    data = bytes(np.random.default_rng(3).integers(0, 9, 60_000).astype(np.uint8))
    assert rasters.unpacked(_packed(data)) == data and rasters.unpacked(_packed(b"")) == b""
