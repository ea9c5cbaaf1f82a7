"""The pipeline's near-copy stage gets pairs by SimHash links too, and compares them exactly."""

import random

import numpy as np

from tessella.llm import jaccard, simhash


def test_fingerprints_of_one_text_are_those_of_many():
    for text in ("", "one", "a b c d e f", " ".join(map(str, range(500)))):
        hashes, total = simhash.shingle_hashes(text, 3)
        own = simhash.majority_of(np.fromiter(hashes, np.uint64, total))
        assert own == simhash.majority_bits([text], 3).view(np.int64)[0]


def test_simhash_links_give_pairs_of_near_copies(spark, monkeypatch):
    rng = random.Random(3)
    base = " ".join(f"w{rng.randrange(10**6)}" for _ in range(3000))
    texts = [base, f"{base} end", " ".join(f"v{rng.randrange(10**6)}" for _ in range(3000)), None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = jaccard.signatures(docs, "doc_id", "text", 5)
    sig = {r.doc_id: r.sig for r in rows.collect()}
    pairs = {(r.a, r.b) for r in jaccard._pairs_by_simhash(rows, 0.8).collect()}
    assert pairs == {tuple(sorted((sig[0], sig[1])))}
    used, links = [], jaccard.near_links
    monkeypatch.setattr(jaccard, "near_links", lambda *a: used.append(a) or links(*a))
    root = {r.doc_id: r.root for r in jaccard.similar_classes(docs).collect()}
    assert used and root[0] == root[1] != root[2] and root[3] == root[4]
