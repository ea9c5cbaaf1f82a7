"""Very many equal rows, or one hub, make no large task."""

import numpy as np
from pyspark.sql import functions as F

from tessella.llm import mixing, packing
from tessella.llm.components import connected_components
from tessella.llm.queries import tokenizer_path


def test_equal_rows_spread_over_all_parts(spark):
    rows = spark.range(100_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    pieces = packing.cut_pieces(rows, tokenizer_path())
    sizes = [r["count"] for r in packing._dealt(pieces, 0, 20).groupBy("part").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 6000
    out = packing.pack(pieces, part_rows=5000).groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count_distinct("offset").alias("places"), F.count("*").alias("rows")).toPandas()
    assert out.n.max() <= 2048 and (out.places == out.rows).all() and out.n.sum() == 100_000 and len(out) <= 100_000 // 2048 + 30


def test_star_and_chain(spark):
    star = spark.range(1, 100_001).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    chain = spark.range(200_000, 200_300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = connected_components(star.unionByName(chain)).groupBy("root").count().collect()
    assert {r.root: r["count"] for r in got} == {0: 100_001, 200_000: 301}


def test_other_tokenizers_encode_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    words = packing._word_ids(path)
    text = "Two  words, and more\n of them"
    assert not words.by_word and packing._word_ids(tokenizer_path()).by_word
    assert np.frombuffer(packing.token_bytes(text, words), "<u4").tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_mix_of_equal_rows(spark):
    """A third of all rows are one text under one id, and the cut of its source falls among them."""
    some = spark.range(200_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w "), F.col("id").cast("string")).alias("text"), F.lit("b").alias("source"))
    same = spark.range(100_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("some words here").alias("text"), F.lit("a").alias("source"))
    empty = spark.range(1000).select(F.lit(7).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), F.lit("a").alias("source"))
    mixed = mixing.mix(some.unionByName(same).unionByName(empty), (5, 2, 1), share=0.5)
    out = {r.source: r for r in mixed.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("target").alias("target"), F.max("copies").alias("most"), F.count("*").alias("n")).collect()}
    assert out["a"].n == 101_000 and out["b"].n == 200_000
    assert abs(out["a"].taken - out["a"].target) <= 1.5 and abs(out["b"].taken - out["b"].target) <= 1 and max(r.most for r in out.values()) <= 2
    assert 0 < out["a"].target < 300_000
