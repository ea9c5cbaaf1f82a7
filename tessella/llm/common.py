"""Helpers that the training-data operators share: tables, shared storage, row keys."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import append_through, write_through


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of the data folder; the path may belong to any store Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Cut the lineage of ``df``: written as Parquet to the folder all executors share, and read again.

    Every executor can read the files, so a lost executor costs only its running tasks.
    """
    return write_through(df, tag)


def append(df: DataFrame, tag: str, path: str | None) -> str:
    """Add the rows of ``df`` to the table at ``path`` (None: a new one in the shared folder); its path."""
    return append_through(df, tag, path)


def slices(batches: Iterable, rows: int = 256):
    """Arrow batches a few rows at a time, so that what a task derives from texts stays small."""
    for batch in batches:
        for first in range(0, len(batch), rows):
            yield batch.slice(first, rows)


def text_key(column: str | Column) -> Column:
    """A 64-bit key of a whole text (null: that of the empty text)."""
    return F.xxhash64(F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")))


def fresh_name(taken: Iterable[str], wish: str) -> str:
    """``wish``, or with underscores in front until no column of ``taken`` has that name."""
    low = {x.lower() for x in taken}
    while wish.lower() in low:
        wish = f"_{wish}"
    return wish


def fold_of(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text, mod ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)
