"""Grids whose tiles are many more than their rasters, and metadata too large for the driver."""

import io
import json
import random

import pytest
from pyspark.sql import functions as F

from tessella.functions import naming
from tessella.operators import split, tiling
from tessella.sources import tables


def test_one_raster_is_cut_by_several_tasks(spark):
    one = spark.createDataFrame([("a", 6400, 6400, 2.5)], "image_id string, w int, h int, a double").coalesce(1)
    grid = tiling.tile_grid(one, 64, 64, True, carry=("a",)).withColumn("p", F.spark_partition_id()).collect()
    assert {(r.tile_r, r.tile_c, r.tile_id, r.a) for r in grid} == {(y, x, f"a_r{y:04d}_c{x:04d}", 2.5) for y in range(100) for x in range(100)}
    assert len(grid) == 10_000 and len({r.p for r in grid}) > 2


def test_names_are_those_of_the_format(spark):
    df = spark.createDataFrame([("i", 0, 9999), ("i", 10_000, 123_456), (None, -7, 12), ("i", None, 3)], "i string, r int, c int")
    both = df.select(naming.tile_id(F.col("i"), F.col("r"), F.col("c")).alias("a"), F.format_string("%s_r%04d_c%04d", "i", "r", "c").alias("b")).collect()
    assert all(r.a == r.b for r in both)


def test_splits_are_drawn_once_a_block(spark):
    r = spark.createDataFrame([("a", 900, 400), ("b", 300, 1500), ("c", 100, 100)], "image_id string, w int, h int")
    ratios = {"train": 0.4, "val": 0.3, "test": 0.3}
    got = split.with_split(tiling.tile_grid(r, 128, 32, True), ratios, 7, 3, places=tiling.grid_places(r, 128, 32, True))
    assert "ArrowEvalPython" not in got._jdf.queryExecution().toString()
    rows = got.collect()
    assert len(rows) == tiling.tile_grid(r, 128, 32, True).count() == sum(x.tiles for x in tiling.grid_counts(r, 128, 32, True).collect())
    for x in rows:
        assert x.split == split.split_of(random.Random(split.block_key(x.tile_r, x.tile_c, 3) + 7).random(), ratios)


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_inputs_of_tiles_go_to_a_file_and_back(spark, tmp_path, n):
    inputs = spark.range(n).select(F.concat(F.lit('i"'), "id").alias("id"), F.lit("r").alias("raster"), F.lit("").alias("crs"), F.array(F.col("id").cast("int"), F.lit(2)).alias("raster_size_px"), F.array(F.lit(0.5)).alias("pixel_size"), F.lit(1).alias("n_rows"), F.lit(2).alias("n_cols"), F.col("id").alias("tiles_written"), F.lit(None).cast("long").alias("tiles_skipped_all_nodata"))
    path = str(tmp_path / "m/t.json")
    tables.write_tiles_meta(inputs, path, 256, 64, [1], [2], True)
    meta = json.loads((tmp_path / "m/t.json").read_text())
    assert meta == tables.tiles_meta([r.asDict() for r in sorted(inputs.collect(), key=lambda r: r.tiles_written)], 256, 64, [1], [2], True)
    assert sorted(tables.read_tiles_inputs(spark, path).collect()) == sorted(inputs.collect()) if n < 2 else {r.id for r in tables.read_tiles_inputs(spark, path).collect()} == {r.id for r in inputs.collect()}


@pytest.mark.parametrize("chunk", [1, 2, 7, 1000])
def test_items_of_json_in_any_layout(chunk):
    items = [{"a": "ü]},\\"}, 12, -3.5e2, "x", [1, {"b": None}], True]
    for indent in (None, 1):
        data = json.dumps({"n": 12, "o": {"inputs": [0]}, "inputs": items, "z": 1}, indent=indent, ensure_ascii=False).encode()
        assert [json.loads(t) for t in tables.json_items(io.BytesIO(data), "inputs", chunk)] == items
    assert list(tables.json_items(io.BytesIO(b' { } '), "inputs", chunk)) == list(tables.json_items(io.BytesIO(b'{"inputs": [ ]}'), "inputs", chunk)) == []
    with pytest.raises(ValueError):
        list(tables.json_items(io.BytesIO(b'{"inputs": [1, 2'), "inputs", chunk))
