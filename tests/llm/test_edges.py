"""Every operator and stage on odd rows and on empty tables: defined results, no crash."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessella.llm import ann, langid, licenses, linededup, mixing, packing, quality, simhash, topk, toxicity
from tessella.llm.queries import tokenizer_path


def test_license_scan(odd):
    assert licenses.scan_licenses(odd).count() == 0
    assert licenses.scan_licenses(odd.limit(0)).count() == 0


def test_language(odd):
    model = langid.fit_languages(odd)
    out = {(r.doc_id, r.lang_pred) for r in langid.predict_languages(odd, model).collect()}
    assert (3, "und") in out and (4, "und") in out and (5, "und") in out and (None, "und") in out
    assert all(lang in ("und", "en", "de", "fr") for _, lang in out)
    none = langid.fit_languages(odd.limit(0))
    assert none.languages == [] and langid.predict_languages(odd, none).filter("lang_pred <> 'und'").count() == 0


def test_mixing(odd):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r.copies <= 2 for r in rows)
    assert {r.source_size for r in rows if r.source is None} == {17}
    assert mixing.mix(odd.limit(0)).count() == 0
    empty = odd.withColumn("text", F.lit(None).cast("string"))
    assert {(r.target, r.copies) for r in mixing.mix(empty).collect()} == {(0.0, 0)}


def test_toxicity_and_quality(odd, labels):
    model = toxicity.fit_toxicity(odd, labels)
    scores = [r.score for r in toxicity.toxicity_scores(odd, model).collect()]
    assert len(scores) == odd.count() and all(0 <= s <= 1 for s in scores)
    net = quality.fit_quality(odd, labels)
    scores = [r.score for r in quality.quality_scores(odd, net).collect()]
    assert len(scores) == odd.count() and all(0 <= s <= 1 for s in scores)
    for fit, run in ((toxicity.fit_toxicity, toxicity.toxicity_scores), (quality.fit_quality, quality.quality_scores)):
        assert run(odd.limit(0), fit(odd.limit(0), labels.limit(0))).count() == 0


def test_line_dedup(odd):
    out = linededup.remove_repeated_runs(odd, min_words=3)
    assert out.columns[: len(odd.columns)] == odd.columns and out.count() == odd.count()
    texts = {(r.doc_id, r.text) for r in out.collect()}
    assert (3, None) in texts and (2, "") in texts
    assert {t for i, t in texts if i == 1} == {"the quick brown fox jumps over the lazy dog and runs away into the deep dark wood", "other text"}
    assert linededup.remove_repeated_runs(odd.limit(0)).count() == 0


def test_near_duplicates(odd):
    classes = simhash.near_duplicate_classes(odd)
    assert classes.count() == odd.count()
    zero = {r.component_id for r in classes.filter("fp = 0").collect()}
    assert zero == {3}
    kept = simhash.keep_one_of_each(odd)
    assert kept.columns == odd.columns
    # Id 1 stands for two texts, which are two classes; the null text stands for those without words.
    assert sorted((r.doc_id or 0, (r.text or "")[:5]) for r in kept.collect()) == [(0, ""), (0, "no id"), (1, "other"), (1, "the q"), (6, "word "), (7, "xxxxx"), (8, "Ünïcö"), (9, "one")]
    assert simhash.keep_one_of_each(odd.limit(0)).count() == 0


def test_packing(odd):
    out = packing.pack(packing.cut_pieces(odd, tokenizer_path()), part_rows=3).toPandas()
    assert out.groupby("sequence_id").length.sum().max() <= 2048
    assert (out[out.piece == 0].shape[0]) == odd.count()
    assert packing.pack(packing.cut_pieces(odd.limit(0), tokenizer_path())).count() == 0


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(60)] + [(100, [1.0, 0.0, 0.0, 0.0])] * 30 + [(200 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(30)]
    rows += [(300, None), (301, [0.0] * 4), (302, [None, 1.0, 0.0, 0.0]), (303, [float("nan"), 0.0, 0.0, 1.0]), (304, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0, 1.0]), (305, [])]
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, score int")


def test_exact_search(vectors):
    queries = vectors.filter("vec_id % 10 = 0")
    out = topk.top_k(vectors, queries, k=7).collect()
    seen = {}
    for r in out:
        seen.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    rows = [(r.vec_id, np.floor(1024 * np.array(r.embedding, float)).astype(int)) for r in vectors.collect() if r.vec_id is not None and r.embedding and None not in r.embedding and np.isfinite(r.embedding).all()]
    for q, v in {i: v for i, v in rows if i % 10 == 0 and i != 100}.items():
        want = sorted(((-int(v @ w), i) for i, w in rows if i != q))[:7]
        assert sorted(seen[q])[:7] == [(k + 1, i, -s) for k, (s, i) in enumerate(want)]
    assert not {300, 302, 303, 304, 305} & {r.vec_id for r in out} and 301 not in [r.query_id for r in out if r.query_id == 300]
    assert topk.top_k(vectors.limit(0), queries.limit(0)).count() == 0


def test_approximate_search(vectors):
    queries = vectors.filter("vec_id % 10 = 0")
    out = ann.search(vectors, queries, k=5, vectors_per_list=20).collect()
    by = {}
    for r in out:
        by.setdefault(r.query_id, []).append(r)
    assert all(len({r.vec_id for r in v}) == 5 and q not in {r.vec_id for r in v} for q, v in by.items())
    assert not {300, 301, 302, 303, 304, 305} & ({r.vec_id for r in out} | set(by))
    assert ann.search(vectors.limit(0), queries.limit(0)).count() == 0
    few = vectors.filter("vec_id < 3")
    assert ann.search(few, few, k=5).count() == 6


def test_stages(spark, odd, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, str(tmp_path)).columns == odd.columns
        assert stage(spark, odd.limit(0), str(tmp_path)).count() == 0
    assert corpus_pipeline.pack_sequences(spark, odd.limit(0), str(tmp_path)).count() == 0
