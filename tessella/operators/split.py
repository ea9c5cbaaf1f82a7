"""Deterministic dataset splits by blocks of tiles."""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import write_through

SPLITS = ("train", "val", "test")


def block_key(row: int, col: int, block: int) -> int:
    # Fixed value: the factor that keeps rows of blocks apart.
    return ((row // block) * 1000003) ^ (col // block)


def block_side(block_tiles: int, n_rows: int, n_cols: int) -> int:
    """The side of a block in tiles: no longer than the grid, one at least."""
    return max(1, min(block_tiles, n_rows, n_cols))


def split_of(draw: float, ratios: dict[str, float]) -> str:
    train, val = ratios["train"], ratios["val"]
    return "train" if draw < train else "val" if draw < train + val else "test"


def with_split(tiles: DataFrame, ratios: dict[str, float], seed: int = 42, block_tiles: int | Column = 4, row: str = "tile_r", col: str = "tile_c", salted_by: str | None = None, places: DataFrame | None = None) -> DataFrame:
    """``tiles`` plus ``split``: all tiles of a block share one draw.

    The draw is the first of Python's generator seeded by the block's key plus ``seed``, so splits
    equal those of a plain Python run. Keys depend on the block only, not on the image: blocks in the
    same place of different images fall alike. A vectorized function draws once per distinct key
    and batch, so no list of blocks passes the driver. With ``salted_by`` (a column) a hash of that
    column and the key decides instead, image by image, inside the JVM. ``places``: fewer rows that hold
    all blocks of ``tiles``; then only their keys are drawn, and tiles look theirs up.
    """
    block = block_tiles.cast("long") if isinstance(block_tiles, Column) else F.lit(block_tiles).cast("long")
    key = (F.floor(F.col(row) / block) * F.lit(1000003).cast("long")).bitwiseXOR(F.floor(F.col(col) / block))
    if salted_by is not None:
        draw = F.pmod(F.xxhash64(F.lit(seed), F.col(salted_by), key), F.lit(1 << 52)) / F.lit(float(1 << 52))
    elif places is not None:
        drawn = write_through(places.select(key.alias("_key")).distinct().withColumn("_draw", _draws(seed)(F.col("_key"))), "draws")
        tiles = tiles.withColumn("_key", key).join(drawn, "_key", "left").drop("_key")
        draw = F.coalesce(F.col("_draw"), F.raise_error(F.lit("a tile's block is not among the places")).cast("double"))
    else:
        draw = _draws(seed)(key)
    return tiles.withColumn("_draw", draw).withColumn("split", _choice(F.col("_draw"), ratios)).drop("_draw")


def _draws(seed: int):
    def draw(keys: pd.Series) -> pd.Series:
        distinct = {k: random.Random(int(k) + seed).random() for k in keys.unique()}
        return keys.map(distinct).astype("float64")

    return F.pandas_udf(draw, T.DoubleType())


def _choice(draw: Column, ratios: dict[str, float]) -> Column:
    train, val = float(ratios["train"]), float(ratios["val"])
    return F.when(draw < train, "train").when(draw < train + val, "val").otherwise("test")


def without_empty_splits(tiles: DataFrame, ratios: dict[str, float]) -> DataFrame:
    """Only tiles whose split has a ratio above zero."""
    return tiles.filter(F.col("split").isin([s for s in SPLITS if ratios.get(s, 0.0) > 0]))
