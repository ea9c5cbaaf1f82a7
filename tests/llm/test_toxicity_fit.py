"""The grammar against a plain reading of its rules; weights and accuracy of trained models."""

import os
import random

import pytest

from tessella.llm import toxicity
from tessella.llm.queries import QUERIES
from tessella.llm.sampling import labelled_sample

DATA = "/root/testdata/sf0.1"
I, TH, T, N, R, G, W = range(7)


def plainly(tags):
    """Outputs at each word, read off the words around it."""
    out = []
    for k, tag in enumerate(tags):
        now, before = [], tags[:k]
        trigger = tag in (I, TH)
        if tag == I:
            now.append("insult")
        if tag == TH:
            now.append("meant" if G in before else "threat")
        if (trigger and T in before) or (tag == T and T not in before and {I, TH} & set(before)):
            now.append("aimed")
        if trigger and N in before[-toxicity.SCOPE :]:
            now.append("negated")
        if trigger and R in before:
            now.append("reported")
        if now:
            out.append("+".join(now))
    return out


def test_composed_grammar_equals_its_rules():
    dice, grammar = random.Random(4), toxicity.Grammar()
    for _ in range(3000):
        tags = [dice.choice((I, TH, T, N, R, G, W, W, W)) for _ in range(dice.randint(0, 12))]
        assert grammar.patterns(tags) == plainly(tags), tags


def test_weights_within_bounds_are_the_best():
    import numpy as np

    rng = np.random.default_rng(1)
    a, prior = rng.normal(size=(200, 3)), np.array([1.0, -1.0, 0.0])
    y = (a @ [2.0, 1.0, -1.0] + rng.normal(size=200) > 0).astype(float)
    low, high = np.array([0.5, -9.0, -0.3]), np.array([9.0, -0.2, 9.0])
    loss = lambda w: -(y * np.log(p := 1 / (1 + np.exp(-a @ w))) + (1 - y) * np.log(1 - p)).sum() + 0.05 * ((w - prior) ** 2).sum()
    w = toxicity._bounded_logistic(a, y, np.ones(200), prior, 0.1, low, high)
    assert (w >= low).all() and (w <= high).all()
    for _ in range(500):
        assert loss(np.clip(w + rng.normal(size=3) * 0.05, low, high)) >= loss(w) - 1e-9


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")
def test_trained_weights(spark):
    """A negated or reported insult scores less than a plain one, an aimed one more, on either side."""
    docs, labels = (spark.read.parquet(f"{DATA}/{n}.parquet") for n in ("documents", "labels"))
    model = toxicity.train(*labelled_sample(docs, labels, "toxic", 4, 2, 1500, 12_000))
    word = max(model.lexicon.words)
    plain, aimed, behind, negated, reported, clean = model.score([f"the {word} goes", f"you {word}", f"{word} you", f"the not {word} goes", f"wrote the {word} goes", "the dog goes"])
    assert negated < plain < aimed == behind and reported < plain and clean < 0.3
    assert all(w < 0 for w in model.weights[4:]) and all(w > 0 for w in model.weights[:4])


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")
def test_held_out_recall(spark):
    """Each language's held-out toxic texts, but for the labelled ones that no insult is left in."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rows = QUERIES["op5_toxicity"](spark, DATA).filter("held_out").join(docs, "doc_id").join(labels, "doc_id").filter("toxic IS NOT NULL").collect()
    for lang in ("en", "de", "fr", "es"):
        toxic = [r.predicted for r in rows if r.lang == lang and r.toxic == 1]
        assert sum(toxic) >= 0.85 * len(toxic), (lang, sum(toxic), len(toxic))
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert sum(clean) <= 0.03 * len(clean)
