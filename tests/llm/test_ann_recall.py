"""Recall of the registered search and of two-level centroids against brute force."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.llm import ann
from tessella.llm.queries import QUERIES

DATA = "/root/testdata"


def recall(got, ids, v, asked, k):
    hits = []
    for q in np.flatnonzero(asked):
        s = (v * v[q]).sum(axis=1)
        s[q] = -np.inf
        hits.append(len(got[ids[q]] & set(ids[np.lexsort((ids, -s))[:k]].tolist())) / k)
    return np.mean(hits)


def by_query(rows):
    got = {}
    for r in rows:
        got.setdefault(r.query_id, set()).add(r.vec_id)
    return got


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")
@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_registered_query(spark, sf):
    p = spark.read.parquet(f"{DATA}/{sf}/embeddings.parquet").toPandas()
    v, ids = np.array(p.embedding.tolist(), float), p.vec_id.to_numpy()
    got = by_query(QUERIES["op4_ann_search"](spark, f"{DATA}/{sf}").collect())
    assert recall(got, ids, v, ids % 20 == 0, 20) >= 0.9


@pytest.mark.parametrize("factor", [1e3, 1e12, 1e18])
def test_one_long_vector(spark, factor):
    rng = np.random.default_rng(0)
    v = rng.normal(size=(3000, 16))
    v[17] *= factor
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    ids = np.arange(3000)
    rows = ann.search(df, df.filter("vec_id % 20 = 0"), k=20, vectors_per_list=60).collect()
    assert recall(by_query(rows), ids, v, ids % 20 == 0, 20) >= 0.9
    exact = {(r.query_id, r.vec_id): r.score for r in rows}
    assert all(s == (v[j] * v[q]).sum() for (q, j), s in exact.items())


def test_two_levels_of_centroids(spark):
    """More lists than the sample can give: the second level's sample grows with them, and queries read few lists."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(150, 24)) * 3
    v = centres[rng.integers(0, 150, 12_000)] + rng.normal(size=(12_000, 24)) * 0.6
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    ids = np.arange(len(v))
    data = df.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    router = ann.build_router(data, len(v), 400, 20, fit_rows=800)
    assert 300 <= len(router.centroids) <= 500 and router.width < len(router.centroids) // 4
    got = by_query(ann.search(df, df.filter("vec_id % 100 = 0"), k=20, vectors_per_list=30, fit_rows=800).collect())
    assert recall(got, ids, v, ids % 100 == 0, 20) >= 0.9


def test_walk_finds_the_nearest_centroids():
    rng = np.random.default_rng(2)
    centroids = rng.normal(size=(600, 8)).astype(np.float32)
    graph = ann.with_bridges(ann.nearest_centroids(centroids, np.arange(600), ann.DEGREE))
    router = ann.ListRouter(centroids, graph, 1.0, 1.3, 4)
    points = rng.normal(size=(300, 8)).astype(np.float32)
    walked, d = router.nearest(points, 16)
    true = np.argsort(ann._squares(points, centroids), axis=1)[:, :16]
    assert np.mean([len(set(a) & set(b)) / 16 for a, b in zip(walked.tolist(), true.tolist(), strict=True)]) > 0.97
    assert (np.diff(d, axis=1) >= 0).all() and all(len(set(r)) == 16 for r in walked.tolist())
