"""Approximate nearest neighbours over balanced posting lists."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize
from .topk import common_length, usable

#: Vectors routed at once, neighbours of a centroid in the graph, candidates opened in a step.
ROUTED, DEGREE, OPENED = 1024, 24, 4
#: Most vectors and most queries of a list that one task compares at once.
SHARD, QUERY_SHARD = 4096, 1024
#: Sample vectors for each centroid, most centroids (all tasks hold them), numbers in one block of distances.
PER_CENTROID, MAX_LISTS, BLOCK = 16, 1 << 18, 1 << 24
#: One vector in so many, and so many vectors at least, may be called long: see ``usual_length``.
LONG_SHARE, LONG_LEAST = 1000, 16


def lift(vectors: np.ndarray, top_square: float) -> np.ndarray:
    """One more coordinate makes all lengths equal, so the nearest by distance is the largest by inner product."""
    rest = np.sqrt(np.maximum(top_square - (vectors**2).sum(axis=1), 0))
    return np.hstack([vectors, rest[:, None]]).astype(np.float32)


def balanced_centroids(sample: np.ndarray, count: int, rounds: int = 10, seed: int = 5) -> np.ndarray:
    """k-means whose clusters pay for their size, so that lists come out of like length."""
    rng = np.random.default_rng(seed)
    centroids = sample[rng.permutation(len(sample))[:count]].copy()
    fair = len(sample) / len(centroids)
    fee = np.zeros(len(centroids))
    for _ in range(rounds):
        cost = (centroids**2).sum(axis=1)[None] - 2 * sample @ centroids.T
        spread = float(np.mean(cost.std(axis=1))) or 1.0
        owner = (cost + fee[None]).argmin(axis=1)
        size = np.bincount(owner, minlength=len(centroids))
        fee = 0.7 * fee + 0.3 * spread * (size / fair - 1)
        total = np.zeros_like(centroids)
        np.add.at(total, owner, sample)
        centroids = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centroids).astype(np.float32)
    return centroids


def _squares(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of all pairs."""
    return np.maximum((points**2).sum(axis=1)[:, None] + (centroids**2).sum(axis=1)[None] - 2 * points @ centroids.T, 0)


def nearest_centroids(centroids: np.ndarray, rows: np.ndarray, degree: int) -> np.ndarray:
    """The ``degree`` nearest other centroids of each centroid in ``rows``."""
    out = []
    block = max(1, BLOCK // len(centroids))
    for first in range(0, len(rows), block):
        some = rows[first : first + block]
        d = _squares(centroids[some], centroids)
        d[np.arange(len(some)), some] = np.inf
        out.append(np.argpartition(d, degree - 1, axis=1)[:, :degree])
    return np.concatenate(out) if out else np.zeros((0, degree), np.int64)


def with_bridges(near: np.ndarray) -> np.ndarray:
    """The graph with some edges to centroids far apart, which keep it in one piece."""
    lists = len(near)
    far = np.random.default_rng(11).integers(0, lists, (lists, 4))
    return np.hstack([near, far, ((np.arange(lists) + 1) % lists)[:, None]]).astype(np.int32)


@dataclass
class ListRouter:
    """Centroids and their neighbour graph; finds the lists of a vector by walking the graph.

    The lists of the centroids come first; those from ``len(centroids)`` on hold long vectors.
    """

    centroids: np.ndarray
    graph: np.ndarray
    top_square: float
    store_ratio: float
    store_lists: int
    probe_ratio: float = 1.0
    width: int = 0
    long_lists: int = 0

    def nearest(self, points: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest centroids found for each lifted point, nearest first, and their distances.

        A best-first walk of the graph; where ``width`` is a quarter of all centroids or more, the
        walk would meet all of them, so all distances are computed at once.
        """
        width = min(width, len(self.centroids))
        found, d = (self._walk if 4 * width < len(self.centroids) else self._all)(points, width)
        order = np.lexsort((found, d), axis=1)
        return np.take_along_axis(found, order, 1), np.sqrt(np.take_along_axis(d, order, 1))

    def _all(self, points: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        d = _squares(points, self.centroids)
        best = np.argpartition(d, width - 1, axis=1)[:, :width]
        return best, np.take_along_axis(d, best, 1)

    def _walk(self, points: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Each step opens the OPENED nearest unopened of the ``width`` best so far, until all of those are open."""
        norms = (self.centroids**2).sum(axis=1)
        square = (points**2).sum(axis=1)
        entries = np.unique(np.linspace(0, len(self.centroids) - 1, max(8, width)).astype(np.int32))

        def distance(rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
            return np.maximum(square[rows, None] + norms[cols] - 2 * np.einsum("ij,ikj->ik", points[rows], self.centroids[cols]), 0)

        active = np.arange(len(points))
        ids = np.tile(entries, (len(points), 1))
        d = distance(active, ids)
        keep = np.argpartition(d, width - 1, axis=1)[:, :width]
        ids, d = np.take_along_axis(ids, keep, 1), np.take_along_axis(d, keep, 1)
        opened = np.zeros(ids.shape, bool)
        few = min(OPENED, width)
        while len(active):
            own, dist, seen = ids[active], d[active], opened[active]
            waiting = np.where(seen, np.inf, dist)
            picks = np.argpartition(waiting, few - 1, axis=1)[:, :few]
            ok = ~np.isinf(np.take_along_axis(waiting, picks, 1))
            np.put_along_axis(seen, picks, True, 1)
            near = self.graph[np.take_along_axis(own, picks, 1)].reshape(len(active), -1)
            other = np.where(np.repeat(ok, self.graph.shape[1], axis=1), distance(active, near), np.inf)
            own, dist, seen = np.hstack([own, near]), np.hstack([dist, other]), np.hstack([seen, np.zeros(near.shape, bool)])
            # Of centroids met again, those held already stay.
            turn = np.argsort(own, axis=1, kind="stable")
            line = np.take_along_axis(own, turn, 1)
            again = np.zeros(line.shape, bool)
            again[:, 1:] = line[:, 1:] == line[:, :-1]
            np.put_along_axis(dist, turn, np.where(again, np.inf, np.take_along_axis(dist, turn, 1)), 1)
            keep = np.argpartition(dist, width - 1, axis=1)[:, :width]
            ids[active], d[active], opened[active] = (np.take_along_axis(x, keep, 1) for x in (own, dist, seen))
            active = active[ok.any(axis=1)]
        return ids, d

    def lists_of(self, vectors: np.ndarray, query: bool) -> tuple[np.ndarray, np.ndarray]:
        """Rows and lists: for a stored vector its nearest lists up to ``store_lists`` within ``store_ratio``
        of the nearest's distance; for a query all lists found within ``probe_ratio``, and those of long vectors."""
        points = np.hstack([vectors, np.zeros((len(vectors), 1))]).astype(np.float32) if query else lift(vectors, self.top_square)
        best, d = self.nearest(points, self.width if query else max(16, 2 * self.store_lists))
        keep = d <= (self.probe_ratio if query else self.store_ratio) * d[:, :1] + 1e-6
        if not query:
            keep[:, self.store_lists :] = False
        rows, cols = np.nonzero(keep & ~np.isinf(d))
        lists = best[rows, cols].astype(np.int64)
        if query and self.long_lists:
            every = len(self.centroids) + np.arange(self.long_lists)
            rows = np.concatenate([rows, np.repeat(np.arange(len(vectors)), self.long_lists)])
            lists = np.concatenate([lists, np.tile(every, len(vectors))])
        elif not query and self.long_lists:
            square = (vectors**2).sum(axis=1)
            long = np.flatnonzero(square > self.top_square)
            short = square[rows] <= self.top_square
            rows, lists = np.concatenate([rows[short], long]), np.concatenate([lists[short], len(self.centroids) + long % self.long_lists])
        return rows, lists


def set_probing(router: ListRouter, sample: np.ndarray, k: int, share: float, target: float = 0.96) -> None:
    """The smallest probing ratio that finds ``target`` of the true neighbours inside the sample, and the walk's width.

    Of a sample that is ``share`` of the table, the first ``share * k`` neighbours (one at least) lie
    as far off as the table's first ``k``; rounded up, so the table's are as near or nearer.
    """
    lists = len(router.centroids)
    asked = sample[:: max(1, len(sample) // 256)][:256].astype(np.float64)
    k = min(max(1, int(np.ceil(share * k))), len(sample))
    true = np.argpartition(-(asked @ sample.T.astype(np.float64)), k - 1, axis=1)[:, :k]
    members = np.full((len(sample), router.store_lists), -1, np.int64)
    for first in range(0, len(sample), ROUTED):
        rows, cols = router.lists_of(sample[first : first + ROUTED], query=False)
        order = np.argsort(rows, kind="stable")
        rows, cols = rows[order], cols[order]
        members[first + rows, np.arange(len(rows)) - np.searchsorted(rows, rows)] = cols
    points = np.hstack([asked, np.zeros((len(asked), 1))]).astype(np.float32)
    needed, ratios = [], []
    block = max(1, BLOCK // lists)
    for first in range(0, len(points), block):
        d = np.sqrt(_squares(points[first : first + block], router.centroids))
        ratio = d / np.maximum(d.min(axis=1, keepdims=True), 1e-9)
        homes = members[true[first : first + block]]
        # A true neighbour is found once the ratio reaches that of the nearest list that holds it.
        at = np.where((homes >= 0) & (homes < lists), ratio[np.arange(len(ratio))[:, None, None], np.clip(homes, 0, lists - 1)], np.inf)
        own = np.where((homes >= lists).any(axis=2), 1.0, at.min(axis=2))
        needed.append(own.ravel()), ratios.append(ratio)
    router.probe_ratio = float(np.quantile(np.concatenate(needed), target, method="higher")) * (1 + 1e-6)
    width = max(int((r <= router.probe_ratio).sum(axis=1).max()) for r in ratios)
    router.width = min(lists, width + max(8, width // 4))


def usual_length(data: DataFrame, count: int) -> tuple[float, int]:
    """``(square, long)``: the largest squared length but for long vectors, and how many of those there are.

    Long is what has twice the length that all but one in LONG_SHARE vectors (all but LONG_LEAST, if
    that is more) stay under: a few vectors of great length would blur the distances of all others.
    """
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    share = 1 - min(0.5, max(LONG_LEAST / count, 1 / LONG_SHARE))
    usual = data.agg(F.percentile_approx(square, share, 100_000)).first()[0]
    row = data.select(square.alias("s")).agg(F.max(F.when(F.col("s") <= 4 * usual, F.col("s"))), F.count_if(F.col("s") > 4 * usual)).first()
    return float(row[0]), int(row[1])


def _drawn(data: DataFrame, count: int, most: int) -> DataFrame:
    """``(h, v)``: about 4 * ``most`` rows by hash, equal vectors once."""
    share = F.lit(min(1.0, 4 * most / count))
    drawn = data.select(F.xxhash64("v").alias("h"), "v").filter(F.col("h") / F.lit(2.0**64) + 0.5 <= share)
    # Equal vectors have equal hashes, so those first by hash may be few kinds of vector many times.
    return drawn.groupBy("h").agg(F.first("v").alias("v"))


def _fine_centroids(data: DataFrame, count: int, coarse: ListRouter, lists: int) -> np.ndarray:
    """``lists`` centroids, in proportion to the sample of each coarse list; each list's are found in a task of its own.

    PER_CENTROID sample vectors make one centroid, so a task sees about PER_CENTROID * lists / (coarse
    centroids) vectors, which have no copies among them.
    """
    shared = data.sparkSession.sparkContext.broadcast(coarse)
    sample = _drawn(data, count, -(-lists * PER_CENTROID // 4))

    def assign(batches):
        router = shared.value
        for batch in batches:
            vectors = _wide(batch.column(0))
            for first in range(0, len(vectors), ROUTED):
                points = lift(vectors[first : first + ROUTED], router.top_square)
                yield pa.RecordBatch.from_arrays([batch.column(0)[first : first + ROUTED], pa.array(router.nearest(points, 1)[0][:, 0].astype(np.int32))], names=["v", "list"])

    def split(table: pa.Table) -> pa.Table:
        points = lift(_wide(table.column("v").combine_chunks()), shared.value.top_square)
        made = balanced_centroids(points, max(1, round(len(points) / PER_CENTROID)), rounds=6)
        return pa.table({"c": pa.array(made.tolist(), pa.list_(pa.float32()))})

    usual = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x) <= F.lit(coarse.top_square)
    dealt = sample.filter(usual).select("v").mapInArrow(assign, "v array<double>, list int")
    # At most about MAX_LISTS rows.
    found = dealt.groupBy("list").applyInArrow(split, "c array<float>").toArrow()
    return _wide(found.column("c").combine_chunks()).astype(np.float32)


def _wide(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _graph(spark: SparkSession, centroids: np.ndarray) -> np.ndarray:
    """The neighbour graph; of many centroids each task finds the neighbours of some."""
    lists = len(centroids)
    degree = min(DEGREE, lists - 1)
    if lists == 1:
        return np.zeros((1, 1), np.int32)
    if lists <= 4096:
        return with_bridges(nearest_centroids(centroids, np.arange(lists), degree))
    shared = spark.sparkContext.broadcast(centroids)

    def run(batches):
        for batch in batches:
            rows = batch.column(0).to_numpy()
            near = nearest_centroids(shared.value, rows, degree)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(near.tolist(), pa.list_(pa.int32()))], names=["id", "near"])

    made = spark.range(0, lists, 1, -(-lists // 1024)).mapInArrow(run, "id long, near array<int>").toArrow()
    near = np.zeros((lists, degree), np.int64)
    near[made.column("id").to_numpy()] = _wide(made.column("near").combine_chunks())
    return with_bridges(near)


def build_router(data: DataFrame, count: int, lists: int, k: int, fit_rows: int, store_lists: int = 4, store_ratio: float = 1.3) -> ListRouter:
    """Centroids, their graph and the probing ratio for ``data (id, v)`` of ``count`` rows.

    As many centroids as ``fit_rows`` vectors can give are found from those at once; more in two
    levels, from a sample that grows with their number: see ``_fine_centroids``.
    """
    spark = data.sparkSession
    top_square, long = usual_length(data, count)
    first = _drawn(data, count, fit_rows).orderBy("h").limit(fit_rows).select("v").toArrow()
    sample = _wide(first.column("v").combine_chunks())
    usual = sample[(sample**2).sum(axis=1) <= top_square]
    points = lift(usual, top_square)
    lists = max(1, min(lists, MAX_LISTS))
    most = max(1, fit_rows // PER_CENTROID)
    start = balanced_centroids(points, min(len(points), lists if lists <= most else min(most, int(np.ceil(np.sqrt(lists))))))
    router = ListRouter(start, _graph(spark, start), top_square, store_ratio, store_lists)
    if lists > most:
        centroids = _fine_centroids(data, count, router, lists)
        router = ListRouter(centroids, _graph(spark, centroids), top_square, store_ratio, store_lists)
    router.long_lists = -(-long // SHARD)
    set_probing(router, sample, k, min(1.0, len(sample) / count))
    return router


def _routed(rows: DataFrame, router, query: bool) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(router)

    def run(batches):
        for batch in batches:
            vectors = _wide(batch.column(1)) if len(batch) else np.zeros((0, 1))
            # Fewer at once where all distances to many centroids are computed.
            block = max(1, min(ROUTED, BLOCK // len(shared.value.centroids)))
            for first in range(0, len(batch), block):
                r, lists = shared.value.lists_of(vectors[first : first + block], query)
                take = pa.array(r + first)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(lists.astype(np.int32))], names=["id", "v", "list"])

    return rows.mapInArrow(run, "id long, v array<double>, list int")


def _ranked(found: str, k: int) -> F.Column:
    """The first ``k`` of many lists of (minus score, id), each pair once."""
    return F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list(found)))), 1, k)


def _nearest(stored: DataFrame, opened: DataFrame, k: int) -> DataFrame:
    """``(query_id, found)``: the best ``k`` of the stored vectors in each query's opened lists, as (minus score, id)."""
    opened = materialize(opened, "probes")
    # One row for each list, of which there are MAX_LISTS at most and those of long vectors.
    sizes = stored.groupBy("list").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("shards"))
    sizes = sizes.join(opened.groupBy("list").agg(F.ceil(F.count("*") / QUERY_SHARD).cast("int").alias("turns")), "list")
    sizes = F.broadcast(materialize(sizes, "sizes"))
    left = stored.join(sizes, "list").select("list", F.pmod(F.xxhash64("id"), F.col("shards")).cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"), "id", "v")
    right = opened.join(sizes, "list").select("list", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.pmod(F.xxhash64("id"), F.col("turns")).cast("int").alias("turn"), "id", "v")

    def compare(stored: pa.Table, asked: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("found", pa.list_(pa.struct([("m", pa.float64()), ("id", pa.int64())])))])
        if not len(stored) or not len(asked):
            return schema.empty_table()
        vec, ids, ask, own = _wide(stored.column("v").combine_chunks()), stored.column("id").to_numpy(), _wide(asked.column("v").combine_chunks()), asked.column("id").to_numpy()
        minus, names, ends = [], [], [0]
        # What a sum of products can be off by, at most, whatever the order of its terms.
        slack = np.sqrt((vec**2).sum(axis=1)) * (vec.shape[1] + 2) * 2.0**-52
        for first in range(0, len(ask), 256):
            some = ask[first : first + 256]
            near = some @ vec.T
            off = np.sqrt((some**2).sum(axis=1))[:, None] * slack[None]
            low = near - off
            low[own[first : first + 256, None] == ids[None, :]] = -np.inf
            bar = np.partition(low, -k, axis=1)[:, -k] if k < len(ids) else np.full(len(some), -np.inf)
            # All that may be among the k first; then in double precision, summed in one order everywhere,
            # so that copies of a vector get equal scores.
            may = (near + off >= bar[:, None]) & (low > -np.inf)
            for row in range(len(some)):
                cols = np.flatnonzero(may[row])
                score = (vec[cols] * some[row]).sum(axis=1)
                best = np.lexsort((ids[cols], -score))[:k]
                minus.append(-score[best]), names.append(ids[cols[best]]), ends.append(ends[-1] + len(best))
        pairs = pa.StructArray.from_arrays([pa.array(np.concatenate(minus)), pa.array(np.concatenate(names))], names=["m", "id"])
        return pa.Table.from_arrays([pa.array(own), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)], schema=schema)

    key = ["list", "shard", "turn"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(compare, "query_id long, found array<struct<m: double, id: long>>")
    # A query's lists and shards are merged in two steps, each over a bounded number of short lists.
    part = F.pmod(F.xxhash64("found"), F.lit(16)).alias("part")
    return found.groupBy("query_id", part).agg(_ranked("found", k).alias("found")).groupBy("query_id").agg(_ranked("found", k).alias("found"))


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, vectors_per_list: int = 400, fit_rows: int = 20_000, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found for each query by inner product.

    There is a list for each ``vectors_per_list`` vectors (MAX_LISTS at most). Centroids come from at
    most ``fit_rows`` distinct vectors (the smallest by hash); where there are more lists than that
    sample can give, from PER_CENTROID sample vectors a list, in two levels. All vectors are indexed. A
    vector near the border of lists is stored in several; queries open the lists whose distance is
    within a ratio of the nearest's, the ratio that finds 96 in 100 true neighbours inside the fit
    sample. The few vectors far longer than others have lists of their own, which all queries open.
    A list longer than SHARD, or asked by more than QUERY_SHARD queries, is split, so equal
    vectors however many make no large task. Scores are double-precision inner products of the
    vectors themselves; ties go to the smaller id; rows that repeat id and vector count once.

    Null, zero or empty vectors, vectors with a null or non-finite component, of another length than
    most have, and null ids take no part. Queries never find rows of their own id. An empty table
    gives an empty result.
    """
    spark = vectors.sparkSession
    sound = F.exists("v", lambda x: x != 0)
    data = usable(vectors, id_col, vector_col).filter(sound)
    length = common_length(data)
    data = materialize(data.filter(F.size("v") == length), "vectors")
    asked = usable(queries, id_col, vector_col).filter(sound & (F.size("v") == length))
    count = data.count()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    router = build_router(data, count, -(-count // vectors_per_list), k, fit_rows)

    stored = materialize(_routed(data, router, query=False), "postings")
    merged = materialize(_nearest(stored, _routed(asked, router, query=True), k), "nearest")
    # Queries whose lists hold fewer than k others look through all lists: an exact search for them.
    full = merged.filter(F.size("found") >= k).select(F.col("query_id").alias("id"))
    short = materialize(asked.join(full, "id", "left_anti"), "short")
    if not short.isEmpty():
        every = short.withColumn("list", F.explode(F.sequence(F.lit(0), F.lit(len(router.centroids) + router.long_lists - 1))))
        merged = merged.filter(F.size("found") >= k).unionByName(_nearest(stored, every, k))
    out = merged.select("query_id", F.posexplode("found").alias("at", "hit"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"), (-F.col("hit.m")).alias("score"))
