"""GeoPackages written and read a batch of rows at a time."""

import struct

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tessella.sources import geopackage


def test_packages_are_written_by_batches(spark, tmp_path, monkeypatch):
    """No image's rows, and no file, are in memory as a whole: a batch holds a hundredth of them here."""
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        x = F.col("id").cast("double")
        rows = spark.range(4000).select(F.concat(F.lit("i"), F.col("id") % 3).alias("image_id"), F.col("id").alias("det_id"), F.when(F.col("id") % 5 > 0, x / 7).alias("conf"), x.alias("minx"), (-x).alias("miny"), (x + 2).alias("maxx"), (1 - x).alias("maxy"))
        assert geopackage.write_packages(rows, str(tmp_path / "g"), "found", 32633, "x") == 3
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert {r.path.rsplit("/", 1)[-1]: r.rows for r in geopackage.list_layers(spark, str(tmp_path / "g")).collect()} == {"detections_merged_i0.gpkg": 1334, "detections_merged_i1.gpkg": 1333, "detections_merged_i2.gpkg": 1333}
    got = geopackage.read_layer(spark, str(tmp_path / "g"), "found")
    a = F.col("attributes")
    back = got.select(a["image_id"].alias("image_id"), a["det_id"].cast("long").alias("det_id"), a["conf"].cast("double").alias("conf"), "minx", "miny", "maxx", "maxy")
    assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()
    assert geopackage.write_packages(rows.limit(0), str(tmp_path / "none")) == 0


def test_spans_go_to_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(geopackage, "SPAN", 50)
    boxes = pd.DataFrame({"minx": np.arange(2000.0), "miny": 0.0, "maxx": np.arange(2000.0) + 1, "maxy": 1.0})
    (tmp_path / "a.gpkg").write_bytes(geopackage.package_bytes(boxes, "l"))
    got = geopackage.read_layer(spark, str(tmp_path)).select("fid", F.spark_partition_id().alias("p")).collect()
    assert len(got) == 2000 and len({r.p for r in got}) > 2


def test_rectangles_and_other_shapes_read_alike():
    box = np.array([[0.5, 1.0, 2.0, 3.0], [-1.0, -2.0, 5.0, 0.0]])
    blobs = geopackage._rectangles(box, 32633)
    point = struct.pack("<2sBBi", b"GP", 0, 1, 7) + struct.pack("<BI2d", 1, 1, 4.0, 5.0)
    fast, plain = geopackage._rectangle_columns(blobs), geopackage._shape_columns(blobs)
    assert [c.to_pylist() for c in fast] == [c.to_pylist() for c in plain]
    assert geopackage._rectangle_columns([*blobs, point]) is None
    mixed = [c.to_pylist() for c in geopackage._shape_columns([None, point, blobs[0]])]
    assert mixed[0] == [None, 7, 32633] and mixed[3][:2] == [None, [[[{"x": 4.0, "y": 5.0}]]]] and mixed[4] == [None, 4.0, 0.5]
