"""Removal of repeated line runs: a suffix array over line ids by distributed prefix doubling, and its intervals."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh_name, materialize, text_key


def least_windows(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each line the number of lines, from it on and up to it, that hold ``least`` words first; 0: none do."""
    total = np.concatenate([[0], np.cumsum(words)])
    here = np.arange(len(words))
    ends = np.searchsorted(total, total[:-1] + least)  # first end whose words since the line suffice
    ahead = np.where(ends <= len(words), ends - here, 0)
    starts = np.searchsorted(total, total[1:] - least, side="right") - 1
    back = np.where(starts >= 0, here + 1 - starts, 0)
    return ahead, back


def line_table(docs: DataFrame, min_words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, key, i, a, b, ahead, back)``: each line's place, its 128-bit id and its least windows."""
    names = ["id", "key", "i", "a", "b", "ahead", "back"]

    def run(batches):
        import xxhash

        for batch in batches:
            take, place, ids, aheads, backs = [], [], [], [], []

            def out(batch=batch):
                pair = np.frombuffer(b"".join(ids), np.int64).reshape(-1, 2)
                rows = pa.array(np.concatenate(take) if take else np.zeros(0, np.int64))
                flat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
                cols = [batch.column(0).take(rows), batch.column(1).take(rows), *(pa.array(flat(x).astype(np.int32)) for x in (place,)), pa.array(pair[:, 0]), pa.array(pair[:, 1]), *(pa.array(flat(x).astype(np.int32)) for x in (aheads, backs))]
                for x in (take, place, ids, aheads, backs):
                    x.clear()
                return pa.RecordBatch.from_arrays(cols, names=names)

            held = 0
            for row, text in enumerate(batch.column(2)):
                if (text := text.as_py()) is None:
                    continue
                lines = text.encode("utf-8").split(b"\n")
                ahead, back = least_windows(np.fromiter((len(x.split()) for x in lines), np.int64, len(lines)), min_words)
                take.append(np.full(len(lines), row)), place.append(np.arange(len(lines))), aheads.append(ahead), backs.append(back)
                ids.extend(xxhash.xxh3_128_digest(x) for x in lines)
                held += len(lines)
                if held > 50_000:
                    yield out()
                    held = 0
            yield out()

    kinds = {"id": docs.schema[id_col].dataType, "key": T.LongType(), "a": T.LongType(), "b": T.LongType()}
    schema = T.StructType([T.StructField(n, kinds.get(n, T.IntegerType())) for n in names])
    return docs.select(F.col(id_col), text_key(text_col).alias("key"), F.col(text_col)).mapInArrow(run, schema)


def _ranked(named: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and ``r`` of the rows whose name (a, b) stands at two places or more: ``r`` is the name's rank.

    Ranks count the repeated names in ascending order from 1. Names are sorted in ranges, one task a
    range; only the ranges' sizes are added up in one place.
    """
    often = named.groupBy("a", "b").agg(F.count("*").alias("n")).filter("n > 1").select("a", "b")
    # Written, so that the join deals both sides anew and Spark can split the rows of a very common name.
    spread = materialize(often.repartitionByRange("a", "b").withColumn("part", F.spark_partition_id()), "names")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range.
    sizes = spread.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("a", "b"))
    ranks = spread.withColumn("own", inside).join(F.broadcast(sizes), "part").select("a", "b", (F.col("before") + F.col("own")).alias("r"))
    return named.join(materialize(ranks, "ranks"), ["a", "b"]).select(*keep, "r")


def _at(level: DataFrame, place: str, rank: str) -> DataFrame:
    return level.select(F.col("id").alias("_id"), F.col("key").alias("_key"), F.col("i").alias(place), F.col("r").alias(rank))


def _on(left: DataFrame, right: DataFrame, places: Column) -> DataFrame:
    """Rows of one document whose places meet."""
    return left.join(right, left["id"].eqNullSafe(right["_id"]) & (left["key"] == right["_key"]) & places).drop("_id", "_key")


def repeated_windows(lines: DataFrame) -> DataFrame:
    """``(id, key, start, size)``: least windows of whole lines that stand at an earlier place too.

    Level k of the doubling ranks the runs of 2^k lines that stand at two places or more: pairs of
    ranks of the halves, sorted, get ranks of their own. Rank order is that of the suffix array at
    depth 2^k (lines compare by id), and places of equal rank are its intervals of common prefixes
    of 2^k lines or longer. A place that is alone in its interval has its final place in the array
    and leaves, as no longer run at it repeats. The interval of depth m, 2^k <= m < 2^(k+1), at a
    place is that of equal ranks of the two runs of 2^k lines that begin and end the m lines, as
    they overlap and cover them; the first place of an interval stays as it is.
    """
    lines = materialize(lines, "lines")
    # Rows that repeat id and text list the same places: once is enough, and more would multiply.
    level = materialize(_ranked(lines, ["id", "key", "i", "ahead", "back"]).dropDuplicates(["id", "key", "i"]), "level0")
    windows = level.select("id", "key", F.col("i").alias("start"), F.col("ahead").alias("size")).unionByName(
        level.select("id", "key", (F.col("i") - F.col("back") + 1).alias("start"), F.col("back").alias("size"))
    ).filter("size > 0").distinct()
    windows = materialize(windows, "windows")
    longest = windows.agg(F.max("size")).first()[0] or 0
    level = level.select("id", "key", "i", "r")
    named = []
    k = 1
    while k <= longest:
        now = windows.filter((F.col("size") >= k) & (F.col("size") < 2 * k))
        both = _on(now, _at(level, "i", "first"), F.col("start") == F.col("i")).drop("i")
        both = _on(both, _at(level, "i", "last"), F.col("start") + F.col("size") - k == F.col("i")).drop("i")
        named.append(both)
        if 2 * k <= longest:
            pairs = _on(level, _at(level, "i2", "b"), F.col("i") + k == F.col("i2")).select("id", "key", "i", F.col("r").alias("a"), "b")
            level = materialize(_ranked(materialize(pairs, "doubled"), ["id", "key", "i"]), "level")
        k *= 2
    if not named:
        return windows.limit(0)
    every = named[0]
    for more in named[1:]:
        every = every.unionByName(more)
    every = materialize(every, "named")
    # Of equal size, so of one level, whose ranks these are.
    interval = ["size", "first", "last"]
    place = F.struct(F.col("id").alias("id"), F.col("key").alias("key"), F.col("start").alias("start"))
    heads = materialize(every.groupBy(*interval).agg(F.min(place).alias("head"), F.count("*").alias("n")).filter("n > 1").drop("n"), "heads")
    return every.join(heads, interval).filter(place > F.col("head")).select("id", "key", "start", "size")


def remove_repeated_runs(docs: DataFrame, min_words: int = 30, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with later copies of repeated line runs deleted, plus ``_lines`` and ``_removed``.

    Lines are what newlines separate; equal means equal bytes. A run of consecutive whole lines with
    ``min_words`` words or more in all (words: separated by ASCII white space) is deleted wherever it
    stands at an earlier place: places are ordered by id (null first), text key, line. Every such run
    is the union of least windows (the fewest lines from a line on, or up to a line, that hold
    ``min_words``), so those are searched; what they cover is deleted. The first copy of a line always
    stays somewhere. ``_lines``: lines before (0 for null); ``_removed``: numbers of deleted lines
    from 0, ascending (both names get underscores in front where ``docs`` has them). A null text stays null; if all lines go the text is empty; rows that repeat
    both id and text count as one document and get the same edit; other columns are untouched.
    """
    gone = repeated_windows(line_table(docs, min_words, id_col, text_col))
    gone = gone.groupBy("id", "key").agg(F.collect_list(F.struct("start", "size")).alias("gone"))
    gone = gone.select(F.col("id").alias("_gone_id"), F.col("key").alias("_gone_key"), F.col("gone").alias("_gone"))
    names = list(docs.columns)
    lines_name, removed_name, gone_name = (fresh_name(names, n) for n in ("_lines", "_removed", "_gone"))
    data = docs.select(F.col(id_col).alias("_doc"), text_key(text_col).alias("_key"), F.struct(*names).alias("_row"))
    joined = data.join(gone, F.col("_doc").eqNullSafe(F.col("_gone_id")) & (F.col("_key") == F.col("_gone_key")), "left").select("_row.*", F.col("_gone").alias(gone_name))
    at = names.index(text_col)

    def run(batches):
        for batch in batches:
            texts, counts, removed = [], [], []
            for text, gone in zip(batch.column(at), batch.column(len(batch.columns) - 1), strict=True):
                text = text.as_py()
                lines = [] if text is None else text.split("\n")
                counts.append(len(lines))
                if not gone.is_valid or text is None:
                    removed.append([])
                else:
                    edges = np.zeros(len(lines) + 1, np.int64)
                    for w in gone.as_py():
                        edges[w["start"]] += 1
                        edges[w["start"] + w["size"]] -= 1
                    cut = np.cumsum(edges)[:-1] > 0
                    removed.append(np.flatnonzero(cut).tolist())
                    text = "\n".join(x for x, c in zip(lines, cut.tolist(), strict=True) if not c)
                texts.append(text)
            columns = [*batch.columns[:-1], pa.array(counts, pa.int32()), pa.array(removed, pa.list_(pa.int32()))]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=[*names, lines_name, removed_name])

    schema = T.StructType([*docs.schema, T.StructField(lines_name, T.IntegerType()), T.StructField(removed_name, T.ArrayType(T.IntegerType()))])
    return joined.mapInArrow(run, schema)
