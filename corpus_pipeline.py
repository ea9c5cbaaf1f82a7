"""The corpus pipeline: stages in order, each over all rows that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import jaccard, linededup, mixing, packing, quality
from tessella.llm.common import materialize, text_key
from tessella.llm.queries import CAPACITY, WEIGHTS, tokenizer_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier gives less than one half go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), 0.5)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs of 30 words or more go; so do documents of which no line is left."""
    cleaned = linededup.remove_repeated_runs(docs, min_words=30)
    lines, removed = (F.col(n) for n in cleaned.columns[-2:])
    cleaned = cleaned.filter((lines == 0) | (F.size(removed) < lines))
    columns = [F.col(c) for c in docs.columns]
    if "n_chars" in docs.columns:
        length = F.when(F.size(removed) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        columns[docs.columns.index("n_chars")] = length.alias("n_chars")
    return cleaned.select(*columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays: Jaccard similarity of 5-word shingles of 0.8 or more."""
    return jaccard.keep_one_of_each(docs, threshold=0.8, words=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes, none of some: the rows that follow are the mix."""
    mixed = mixing.mix(docs, WEIGHTS, share=1.5, limit=2.0).filter("copies > 0")
    # One row stands for each id and text here, as one of each class of copies stayed; were there more, each
    # would get the most copies that one of them gets.
    copies = mixed.groupBy("doc_id", "text_key").agg(F.max("copies").alias("_copies"))
    copies = copies.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "_copies")
    # The whole row travels as one column, so no name of its own can clash.
    data = docs.select(F.col("doc_id").alias("_doc"), text_key("text").alias("_text_key"), F.struct(*docs.columns).alias("_row"))
    taken = data.join(copies, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key")))
    return taken.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("_copy")).select("_row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces with the sequence and the offset each is packed at."""
    return packing.pack(packing.cut_pieces(docs, tokenizer_path(), CAPACITY), CAPACITY).drop("text_key")


STAGES = [
    ("quality_filter", quality_filter),
    ("line_dedup", line_dedup),
    ("simhash_neardup", near_duplicates),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Tokenization is beyond SQL; a test holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
