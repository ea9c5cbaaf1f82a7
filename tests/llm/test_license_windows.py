"""License scans against every window of plain word lists."""

import random
import re

import pytest

from tessella.llm import licenses


def plainly(text, threshold=0.8, shingle=5):
    """License to containment and first word of the best window, over all windows on the grid."""
    w = re.findall(r"[^\W_]+", text.lower())
    sh = [tuple(w[i : i + shingle]) for i in range(len(w) - shingle + 1)]
    out = {}
    for name, template in licenses.TEMPLATES.items():
        t = licenses.template_words(template)
        own = {tuple(t[i : i + shingle]) for i in range(len(t) - shingle + 1)}
        n, step = len(own), max(1, len(own) // 8)
        best = max(((len(own & set(sh[max(s - step, 0) : max(s - step, 0) + n + 2 * step])) / n, -s) for s in range(0, len(sh), step)), default=(0, 0))
        if best[0] >= threshold:
            out[name] = best[0], -best[1]
    return out


@pytest.fixture(scope="module")
def texts():
    dice = random.Random(8)
    common = ["software", "license", "lorem", "ipsum", "conditions", "without", "distributed", "warranty", "this"]
    out = [None, "", "license", "x" * 9000]
    for _ in range(60):
        parts = []
        for _ in range(dice.randint(1, 4)):
            parts.append(dice.choices(common, k=dice.randint(0, 60)))
            w = licenses.TEMPLATES[dice.choice(list(licenses.TEMPLATES))].split()
            for _ in range(dice.choice((0, 0, 1, 2, len(w) // 30))):
                w[dice.randrange(len(w))] = "altered"
            parts.append(w[: len(w) if dice.random() < 0.8 else len(w) // 2])
        out.append(" ".join(x for p in parts for x in p))
    return out


@pytest.mark.parametrize("block", [4096, 30])
def test_scan_equals_plain_windows(spark, texts, monkeypatch, block):
    """Also where blocks are far shorter than windows, so that texts are cut at every place."""
    monkeypatch.setattr(licenses, "BLOCK", block)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in licenses.scan_licenses(df).collect():
        got.setdefault(r.doc_id, {})[r.license] = r.containment
    want = {k: {n: c for n, (c, _) in plainly(t or "").items()} for k, t in enumerate(texts)}
    assert got == {k: v for k, v in want.items() if v} and sum(map(len, got.values())) > 60


def test_notice_at_the_end_of_a_long_text(spark):
    filler = "some plain words that stand for a long text " * 30_000
    df = spark.createDataFrame([(1, filler + licenses.TEMPLATES["zlib"])], "doc_id long, text string")
    (row,) = licenses.scan_licenses(df).collect()
    assert (row.license, row.containment) == ("zlib", 1.0) and row.word > 260_000
