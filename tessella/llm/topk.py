"""Exact top-k search by distributed histogram selection."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import append, materialize

#: Cells of a query's histogram in each round.
CELLS = 1024
#: Most bytes of queries that are sent to all tasks at once, and of vectors a task holds at once.
QUERY_BYTES, CHUNK_BYTES = 1 << 26, 1 << 25
#: Queries and vectors scored at once.
QUERIES, VECTORS = 1024, 1024
#: What a score is held at where it has more bits.
LONGEST = 2**63 - 1


def fixed_point(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of each component: integers, as doubles."""
    return np.floor(np.clip(vectors, -1e300, 1e300) * float(scale))


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Integer inner products, exactly; one of more than 64 bits is held at the nearest long.

    In doubles where a pair's sums stay under 2^53, else in longs, else in Python's integers.
    """
    if not left.size or not right.size:
        return np.zeros((len(left), len(right)), np.int64)
    high_left, high_right = np.abs(left).max(axis=1), np.abs(right).max(axis=1)
    width = float(left.shape[1])
    if float(high_left.max()) * float(high_right.max()) * width < 2.0**53:
        return (left @ right.T).astype(np.int64)
    with np.errstate(invalid="ignore", over="ignore"):
        bound = high_left[:, None] * high_right[None, :] * width
        plain = bound < 2.0**53
        out = np.where(plain, left @ right.T, 0).astype(np.int64)
    for i in np.flatnonzero(~plain.all(axis=1)):
        some = np.flatnonzero(~plain[i] & (bound[i] < 2.0**63))
        # No component passes 2^63 where the bound holds, unless its partners are all zero.
        fits = some[(high_right[some] < 2.0**63) & (high_left[i] < 2.0**63)]
        out[i, fits] = right[fits].astype(np.int64) @ left[i].astype(np.int64) if len(fits) else 0
        own = [int(x) for x in left[i]]
        for j in np.setdiff1d(np.flatnonzero(~plain[i]), fits):
            score = sum(x * int(y) for x, y in zip(own, right[j], strict=True))
            out[i, j] = min(max(score, -LONGEST), LONGEST)
    return out


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, v)`` of the vectors that take part: not null, no null or non-finite component, id not null."""
    v = F.col(vector_col).cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).filter(F.forall("v", lambda x: x.isNotNull())).filter(sound)


def common_length(vectors: DataFrame) -> int:
    """The length that most vectors ``v`` have (of equally common ones the smaller); 0 if there are none."""
    first = vectors.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").first()
    return first["n"] if first else 0


class QuerySet:
    """Queries sent to all tasks: QUERY_BYTES at most, but for the unevenness of a hash."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids = ids
        self.vectors = vectors


def _chunks(batches, scale: int):
    """Ids and whole vectors of a task's batches, CHUNK_BYTES (one batch at least) at a time."""
    held, size = [], 0
    for batch in batches:
        if not len(batch):
            continue
        flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
        held.append((batch.column(0).to_numpy(), flat.reshape(len(batch), -1)))
        size += flat.nbytes
        if size >= CHUNK_BYTES:
            yield np.concatenate([i for i, _ in held]), fixed_point(np.concatenate([v for _, v in held]), scale)
            held, size = [], 0
    if held:
        yield np.concatenate([i for i, _ in held]), fixed_point(np.concatenate([v for _, v in held]), scale)


def _blocks(queries: QuerySet, ids: np.ndarray, vectors: np.ndarray):
    """Scores block by block: first query, first vector, scores, which of them count (not the query's own row)."""
    for q in range(0, len(queries.ids), QUERIES):
        for c in range(0, len(ids), VECTORS):
            scores = exact_products(queries.vectors[q : q + QUERIES], vectors[c : c + VECTORS])
            yield q, c, scores, queries.ids[q : q + QUERIES, None] != ids[None, c : c + VECTORS]


def _unsigned(x: np.ndarray) -> np.ndarray:
    return x.astype(np.int64).view(np.uint64)


def _kth_cells(data: DataFrame, shared, lows: np.ndarray, step: int, k: int, scale: int) -> np.ndarray:
    """Each query's cell [low + c*step, low + (c+1)*step) of its k-th highest score (of the lowest, if it has fewer).

    A task counts its scores a chunk at a time and gives a chunk's highest cells until they hold
    ``k`` scores: the k-th of all cannot be lower. Counts are summed and read off in Spark.
    """

    def run(batches):
        queries = shared.value
        for ids, vectors in _chunks(batches, scale):
            counts = None
            for q, c, scores, counted in _blocks(queries, ids, vectors):
                if c == 0:
                    if counts is not None:
                        yield out(before, counts)
                    before, counts = q, np.zeros((len(scores), CELLS + 1), np.int64)
                low = lows[q : q + QUERIES, None]
                cell = np.minimum((_unsigned(scores) - _unsigned(low)) // np.uint64(step), np.uint64(CELLS)).astype(np.int64)
                flat = (cell + np.arange(len(scores))[:, None] * (CELLS + 1))[counted & (scores >= low)]
                counts += np.bincount(flat, minlength=counts.size).reshape(counts.shape)
            yield out(before, counts)

    def out(first, counts):
        above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
        q, c = np.nonzero((counts > 0) & (above < k))
        return pa.RecordBatch.from_arrays([pa.array((q + first).astype(np.int32)), pa.array(c.astype(np.int32)), pa.array(counts[q, c])], names=["q", "c", "n"])

    made = data.mapInArrow(run, "q int, c int, n long").groupBy("q", "c").agg(F.sum("n").alias("n"))
    above = F.sum("n").over(Window.partitionBy("q").orderBy(F.desc("c")))
    kth = made.withColumn("above", above).groupBy("q").agg(F.coalesce(F.max(F.when(F.col("above") >= k, F.col("c"))), F.min("c")).alias("c"))
    # One row for each query of the set.
    table = kth.toPandas()
    cells = np.zeros(len(lows), np.int64)
    cells[table["q"].to_numpy()] = table["c"].to_numpy()
    return cells


def _kth_scores(data: DataFrame, shared, queries: QuerySet, longest: float, k: int, scale: int) -> np.ndarray:
    """Each query's k-th highest score (the lowest, if it has fewer), by dividing its cell anew each round."""
    with np.errstate(over="ignore"):
        bounds = np.sqrt((queries.vectors**2).sum(axis=1)) * longest * (1 + 1e-9) + 2
    bounds = [min(int(b), LONGEST) if b < 2.0**63 else LONGEST for b in bounds.tolist()]
    lows = np.array([-b for b in bounds], np.int64)
    width = 2 * max(bounds) + 1
    while width > 1:
        step = -(-width // CELLS)
        lows = lows + _kth_cells(data, shared, lows, step, k, scale) * step
        width = step
    return lows


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` highest scores among all other rows.

    Score: inner product of floor(scale * x) of both vectors, an integer; one of more than 64 bits is
    held at the nearest long. Ties go to the smaller id. ``queries``: rows of the same form; all of
    them that fit QUERY_BYTES are sent to all tasks together (more go in several turns), and each
    round counts all their scores in one job. Scores are counted into a histogram per query, the cell
    of the k-th is divided again until it is one score wide, and one last job keeps the scores above
    it and, of those equal to it, the smallest ids that may still be needed. No scores are stored; a
    task holds the queries, CHUNK_BYTES of vectors and one block of scores.

    Vectors null, empty or with a null or non-finite component take no part, nor do null ids and
    vectors of another length than most have; rows that share an id are no candidates of that id's
    queries and rank one behind the other. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    data = usable(vectors, id_col, vector_col)
    length = common_length(data)
    data = materialize(data.filter(F.size("v") == length), "vectors")
    asked = usable(queries, id_col, vector_col).filter(F.size("v") == length)
    # A hash deals the queries evenly; a third more turns than needed leave room for chance.
    turns = -(-4 * asked.count() * length * 8 // (3 * QUERY_BYTES))
    asked = materialize(asked.withColumn("turn", F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(max(1, turns)))), "queries")
    # |floor(s*x)| is at most s*|x| + sqrt(length), and no product passes that of the lengths.
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    longest = data.agg(F.max(F.sqrt(square) * float(scale) + F.sqrt(F.size("v")))).first()[0] or 0.0
    path = None
    for turn in range(turns):
        rows = asked.filter(F.col("turn") == turn).orderBy("id").select("id", "v").toArrow()
        if not len(rows):
            continue
        flat = rows.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        some = QuerySet(rows.column("id").to_numpy(), fixed_point(flat.reshape(len(rows), -1), scale))
        shared = spark.sparkContext.broadcast(some)
        kth = _kth_scores(data, shared, some, longest, k, scale)

        def run(batches, shared=shared, kth=kth):
            queries = shared.value
            for ids, vectors in _chunks(batches, scale):
                for first, start, scores, counted in _blocks(queries, ids, vectors):
                    q, c = np.nonzero(counted & (scores >= kth[first : first + QUERIES, None]))
                    own, found = ids[start : start + VECTORS][c], scores[q, c]
                    # Of a query's scores here no more than its k first can count.
                    order = np.lexsort((own, -found, q))
                    order = order[np.arange(len(q)) - np.searchsorted(q, q) < k]
                    yield pa.RecordBatch.from_arrays([pa.array(queries.ids[first + q[order]]), pa.array(own[order]), pa.array(found[order])], names=["query_id", "vec_id", "score"])

        # All turns go to one table, so the plan does not grow with them.
        path = append(data.mapInArrow(run, "query_id long, vec_id long, score long"), "found", path)
        shared.unpersist()
    if path is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = spark.read.schema("query_id long, vec_id long, score long").parquet(path)
    return found.withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
