"""The pipeline's near-duplicate stage against Jaccard similarities of all pairs."""

import os
import random

import pytest

import corpus_pipeline

DATA = "/root/testdata/sf0.01"


def brute_force(rows, threshold=0.8):
    """Ids that stay: the least of each component of pairs at the similarity."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({b" ".join(w[k : k + 5]) for k in range(len(w) - 4)} or {b" ".join(w)})
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared / (len(sets[i]) + len(sets[j]) - shared) >= threshold:
                a, b = sorted((find(i), find(j)), key=lambda k: rows[k][0])
                root[b] = a
    return sorted(rows[k][0] for k in range(len(rows)) if find(k) == k)


def stage(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(r.doc_id for r in dict(corpus_pipeline.STAGES)["simhash_neardup"](spark, df, DATA).collect())


def test_planted_copies(spark):
    """Chains and families of copies on either side of the threshold, and texts too short for a shingle."""
    dice = random.Random(7)
    rows, word = [(0, None), (1, ""), (2, " \n"), (3, "one two"), (4, "One  two"), (5, "one three")], lambda: f"w{dice.randrange(5000)}"
    for _ in range(25):
        base = [word() for _ in range(dice.choice([12, 40, 150, 600]))]
        for k in range(10):
            rows.append((len(rows), " ".join(base)))
            base = list(base)
            for _ in range(max(1, len(base) // dice.choice([40, 60, 90, 200]))):
                base[dice.randrange(len(base))] = word()
    got, want = stage(spark, rows), brute_force(rows)
    assert got == want and len(want) < len(rows) - 60


def test_one_large_family(spark):
    """Hundreds of copies of one text, some of them far from others: one bucket holds them all."""
    dice = random.Random(3)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(300):
        own = list(base)
        for _ in range(dice.randrange(5)):
            own[dice.randrange(len(own))] = f"x{dice.randrange(10**6)}"
        rows.append((k, " ".join(own)))
    assert stage(spark, rows) == brute_force(rows)


def test_exact_threshold(spark):
    """Jaccard 0.8 itself is near: 4 shingles of 5. 3 of 4 are not."""
    assert stage(spark, [(1, "a b c d e f g h i"), (2, "a b c d e f g h"), (3, "k l m n o p q r"), (4, "k l m n o p q")]) == [1, 3, 4]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")
def test_raw_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    assert stage(spark, rows) == brute_force(rows)


def test_pairs_grow_with_the_members(spark, monkeypatch):
    """A family of which one pair in four is near: far fewer pairs than all are compared, and no link is lost."""
    from tessella.llm import jaccard

    dice = random.Random(9)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for k in range(700):
        own = list(base)
        for _ in range(dice.randrange(7)):
            own[dice.randrange(len(own))] = f"x{dice.randrange(10**6)}"
        rows.append((k, " ".join(own)))
    counts, inner = [], jaccard._alike
    monkeypatch.setattr(jaccard, "_alike", lambda pairs, *rest: (counts.append(pairs.count()), inner(pairs, *rest))[1])
    assert stage(spark, rows) == brute_force(rows)
    assert sum(counts) < 40 * len(rows), counts
