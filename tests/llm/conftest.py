import pytest

TEXT = "the quick brown fox jumps over the lazy dog and runs away into the deep dark wood"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, empty and long texts, repeated rows, ties, extra columns whose names operators use."""
    rows = [
        (1, TEXT, "en", "a"), (1, TEXT, "en", "a"), (2, TEXT, "en", None), (3, None, "en", "a"), (4, "", None, "b"), (None, "no id here at all", "en", "b"), (None, None, None, None),
        (5, " \t\n ", "en", "a"), (6, "word " * 30_000, "en", "a"), (7, "x" * 50_000, "de", "c"), (8, "Ünïcödé ß Ελληνικά 漢字 ́ \x1c", "de", "c"), (9, "one", "fr", "c"), (1, "other text", "en", "a"),
    ]
    extra = "size, score, fp, text_key, part, _id, _key, _row, _doc, _copies, _lines, _removed, _gone, _text_key, key, id, u, held_out".split(", ")
    df = spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), *range(len(extra))) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in extra))
    return df.cache()


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(1, 10)] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
