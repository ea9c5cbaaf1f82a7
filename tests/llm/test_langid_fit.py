"""No language drops out of the fit, and held-out texts get their language."""

import os

import pytest

from tessella.llm import langid
from tessella.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def test_long_texts_only(spark):
    rows = [(k, f"short words of one language {k} " * 5, "aa") for k in range(20)] + [(k, f"langer tekst van een andere taal {k} " * 600, "bb") for k in range(20, 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_languages(df)
    assert model.languages == ["aa", "bb"]
    assert {r.doc_id: r.lang_pred for r in langid.predict_languages(df, model).collect()} == {i: lang for i, _, lang in rows}


@pytest.mark.parametrize("known", [8, 9, 11])
def test_repeated_rows(spark, known):
    """A language of one text in very many rows is learned like any other."""
    rows = [(known, "ein Satz, der sich immer wiederholt", "de")] * 2000 + [(k, f"some plain words {k}", "en") for k in range(400)]
    model = langid.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["de", "en"] and model.predict(["ein Satz"])[0] == ["de"]


def test_many_languages(spark):
    """More languages than any table here has; a small sample bound takes texts, not languages."""
    rows = [(k, f"{chr(97 + k // 10)}{chr(97 + k % 10)} " * 30 + f"{j}", f"l{k:03}") for k in range(100) for j in range(6)]
    df = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows)], "doc_id long, text string, lang string")
    model = langid.fit_languages(df, sample_chars=100 * 12_000)
    assert model.languages == sorted({r[2] for r in rows})
    assert model.predict(["dc dc dc"])[0] == ["l032"]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang", "text")
    out = QUERIES["op2_language_id"](spark, DATA).filter("held_out").join(docs, "doc_id").filter("lang IS NOT NULL AND lang_pred <> 'und'").collect()
    assert len(out) > 150 and sum(r.lang_pred == r.lang for r in out) >= 0.97 * len(out)
