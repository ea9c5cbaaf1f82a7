"""Detections, labels, tiles and metadata on disk."""

from __future__ import annotations

import codecs
import json
import shutil
from collections.abc import Iterator
from itertools import islice
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.naming import label_line
from ..schema import DETECTION, RASTER_META, TILES_META, require
from ..storage import new_folder
from .rasters import Ranges

#: File names that count as tiles.
TILE_FILES = r"(?i)\.(tif|tiff|png|jpg|jpeg)$"


def read_detections(spark: SparkSession, path: str) -> DataFrame:
    """Detections from CSV with a header; columns by name, never inferred types. An empty file gives no rows."""
    return require(spark.read.schema(DETECTION).option("header", True).option("enforceSchema", False).csv(path), DETECTION.names)


def write_detections(df: DataFrame, path: str, sort: bool = False) -> None:
    """Detections as CSV; the header is written even without rows. ``sort``: most confident first."""
    out = df.select(*DETECTION.names)
    out = out.orderBy(F.desc("conf"), "tile", "x1", "y1") if sort else out
    if out.isEmpty():
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", True).csv(path)


def list_tiles(spark: SparkSession, path: str) -> DataFrame:
    """``(path, tile, length)`` of the picture files in a folder; contents are not read."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    return files.filter(F.col("path").rlike(TILE_FILES)).withColumn("tile", F.element_at(F.split("path", "/"), -1))


def read_tiles(spark: SparkSession, path: str) -> DataFrame:
    """``(tile, content)`` of the picture files in a folder."""
    files = spark.read.format("binaryFile").load(path).filter(F.col("path").rlike(TILE_FILES))
    return files.select(F.element_at(F.split("path", "/"), -1).alias("tile"), "content")


def label_files(labels: DataFrame) -> DataFrame:
    """``(split, name, content)``: one text per tile, a line per label, in a fixed order."""
    line = label_line(F.col("label_class"), F.col("cx"), F.col("cy"), F.col("bw"), F.col("bh"))
    texts = labels.groupBy("split", "tile_id").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("t"))
    return texts.select("split", F.concat(F.lit("tile_"), "tile_id", F.lit(".txt")).alias("name"), F.concat("t", F.lit("\n")).cast("binary").alias("content"))


def data_yaml(root: str, channels: int, class_name: str) -> str:
    """The dataset description that trainers read; the one class always has number 0."""
    return f"path: {root}\ntrain: images/train\nval: images/val\ntest: images/test\nchannels: {channels}\nnames:\n  0: {class_name}\n"


def write_text(text: str, path: str | Path) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(text, encoding="utf-8")


def write_json(document: dict, path: str | Path) -> None:
    write_text(json.dumps(document, indent=2) + "\n", path)


def tiles_meta(inputs: list[dict], tile_size: int, stride: int, ms_bands: list[int], rgb_bands: list[int], skip_empty: bool) -> dict:
    """Metadata of inference tiles; a single input is named at the top level too."""
    meta = {"inputs": inputs, "tile_size": tile_size, "stride": stride, "ms_bands_1_indexed": ms_bands, "rgb_bands_1_indexed": rgb_bands, "skip_empty": skip_empty}
    if len(inputs) == 1:
        meta |= {"input_id": inputs[0]["id"], "raster": inputs[0]["raster"]}
    return meta


def read_tiles_meta(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TILES_META).json(path, multiLine=True)


def write_tiles_meta(inputs: DataFrame, path: str, tile_size: int, stride: int, ms_bands: list[int], rgb_bands: list[int], skip_empty: bool) -> None:
    """The file of ``tiles_meta`` for a table of inputs (as RASTER_META), which may be too large for the driver.

    Tasks write the inputs as lines of text, one each; the driver only copies these into the one file.
    """
    parts = new_folder(inputs.sparkSession, "inputs")
    lines = F.to_json(F.struct(*inputs.columns), {"ignoreNullFields": "false"})
    inputs.select(lines).write.mode("overwrite").text(f"file://{parts}")
    files = sorted(f for f in Path(parts).glob("part-*") if f.stat().st_size)
    few = []
    for f in files:
        with f.open(encoding="utf-8") as source:
            few += [json.loads(line) for line in islice(source, 2 - len(few))]
    meta = tiles_meta(few, tile_size, stride, ms_bands, rgb_bands, skip_empty)
    before, after = json.dumps(meta | {"inputs": []}, indent=2).split("[]", 1)
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with Path(path).open("w", encoding="utf-8") as out:
        out.write(before + "[")
        comma = "\n"
        for f in files:
            with f.open(encoding="utf-8") as source:
                for line in source:
                    out.write(comma + line.rstrip("\n"))
                    comma = ",\n"
        out.write("]" + after + "\n")
    shutil.rmtree(parts)


def read_tiles_inputs(spark: SparkSession, path: str) -> DataFrame:
    """The inputs that a file of ``tiles_meta`` names, a row each (as RASTER_META); the file is never held as a whole."""

    def run(batches):
        for pdf in batches:
            for p in pdf["path"]:
                with Ranges(p) as source:
                    texts = json_items(source.file, "inputs")
                    while some := list(islice(texts, 5000)):
                        yield pd.DataFrame({"text": some})

    found = spark.createDataFrame([(str(path),)], "path string").mapInPandas(run, "text string")
    return found.select(F.from_json("text", RASTER_META).alias("i")).select("i.*")


def json_items(file, key: str, chunk: int = 1 << 20) -> Iterator[str]:
    """The texts of the items of the list that stands under ``key`` in the one object of a JSON file of UTF-8 bytes."""
    decode = codecs.getincrementaldecoder("utf-8")().decode
    parse = json.JSONDecoder().raw_decode
    text, at, over = "", 0, False

    def more() -> None:
        nonlocal text, at, over
        # Twice as much as is left, so an item longer than a chunk is not read anew for each chunk.
        data = file.read(max(chunk, len(text) - at))
        over = not data
        text, at = text[at:] + decode(data, over), 0

    def char() -> str:
        nonlocal at
        while True:
            while at < len(text) and text[at] in " \t\r\n":
                at += 1
            if at < len(text):
                return text[at]
            if over:
                raise ValueError("the JSON ends too early")
            more()

    def value() -> str:
        """The text of the next value, which is then behind."""
        nonlocal at
        char()
        while True:
            try:
                end = parse(text, at)[1]
                # A number may go on in what follows.
                if end < len(text) or over:
                    found, at = text[at:end], end
                    return found
            except json.JSONDecodeError:
                if over:
                    raise
            more()

    def step(*wanted: str) -> str:
        nonlocal at
        found = char()
        if found not in wanted:
            raise ValueError(f"{found} where one of {wanted} is due in JSON")
        at += 1
        return found

    step("{")
    if char() == "}":
        return
    while True:
        name = json.loads(value())
        step(":")
        if name == key and char() == "[":
            step("[")
            if char() == "]":
                return
            while True:
                yield value()
                if step(",", "]") == "]":
                    return
        value()
        if step(",", "}") == "}":
            return


def dataset_meta(run_id: str, inputs: list[dict], bands: list[int], rgb: list[int], tile_size: int, stride: int, min_area_fraction: float, min_bbox_px: int, ratios: dict[str, float], seed: int, block_tiles: int, counts: DataFrame, skipped: int) -> dict:
    """Metadata of a training dataset; ``counts``: a row per split, as ``split_counts`` makes it."""
    rows = {r["split"]: r for r in counts.collect()}
    of = lambda n: {s: int(rows[s][n]) if s in rows else 0 for s in ("train", "val", "test")}
    return {
        "run_id": run_id, "inputs": inputs, "export_bands_1_indexed": bands, "rgb_bands_1_indexed": rgb, "tile_size": tile_size, "stride": stride, "min_area_fraction": min_area_fraction,
        "min_bbox_px": min_bbox_px, "split": {"ratios": ratios, "seed": seed, "block_tiles": block_tiles},
        "stats": {"tiles_written": of("tiles_written"), "labels_written": of("labels_written"), "tiles_skipped_no_labels": skipped},
    }


def metrics_report(model: str, data: str, conf: float, iou: float, metrics: dict[str, float]) -> str:
    """Evaluation results as text, F1 computed on the way."""
    p, r = metrics["precision"], metrics["recall"]
    lines = [f"model: {model}", f"data: {data}", f"confidence >= {conf}, IoU >= {iou}", *(f"{k}: {v:.4f}" for k, v in metrics.items()), f"f1: {2 * p * r / (p + r + 1e-6):.4f}"]
    return "\n".join(lines) + "\n"
