"""The queries of the training-data operators, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, langid, licenses, linededup, mixing, packing, quality, simhash, topk, toxicity
from .common import fold_of, read_table

WEIGHTS = (5, 2, 1)
CAPACITY = 2048


def tokenizer_path() -> str:
    """Where the public vocabulary file is installed."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(read_table(spark, sf_dir, "documents"), threshold=0.8, shingle=5)
    return found.select("doc_id", "license", "containment", "word")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = langid.predict_languages(docs, langid.fit_languages(docs, modulus=4, held_out=2))
    return found.select("doc_id", (fold_of("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"), WEIGHTS, share=1.5, limit=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP3_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(text, '')) AS text_md5
  FROM documents),
drawn AS (
  SELECT *, (CAST('0x' || substr(md5(':' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || text_md5), 1, 13) AS BIGINT) + CAST(0.5 AS DOUBLE))
            / CAST(4503599627370496 AS DOUBLE) AS u
  FROM docs),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT *, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS w,
         CAST(2 AS DOUBLE) * source_size AS cap
  FROM sizes),
levels AS (
  SELECT *, (CAST(1.5 AS DOUBLE) * sum(source_size) OVER ()
             - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS own_level
  FROM weighed WINDOW o AS (ORDER BY cap / w, source NULLS LAST)),
opened AS (SELECT arg_min(own_level, cap / w) AS level FROM levels WHERE own_level * w < cap),
targets AS (
  SELECT source, source_size, CASE WHEN level IS NULL THEN cap ELSE least(cap, level * w) END AS target FROM levels, opened),
expected AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS e FROM targets),
ranked AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, floor(e) AS whole, target - floor(e) * t.source_size AS room,
         coalesce(sum(d.size) OVER (PARTITION BY d.source
           ORDER BY (u / (1 - u)) / nullif((e - floor(e)) / (1 - (e - floor(e))), 0), d.doc_id, text_md5
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM drawn d JOIN expected t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN before + size / CAST(2 AS DOUBLE) <= room THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ranked
"""


def op4_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return ann.search(rows, rows.filter(F.col("vec_id") % 20 == 0), k=20)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels"), modulus=4, held_out=2)
    scored = toxicity.with_prediction(toxicity.toxicity_scores(docs, model), 0.3)
    return scored.select("doc_id", (fold_of("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = linededup.remove_repeated_runs(read_table(spark, sf_dir, "documents"), min_words=30)
    return cleaned.select("doc_id", "text", F.col("_lines").alias("n_lines"), F.array_join(F.col("_removed").cast("array<string>"), ",").alias("removed_lines"))


OP6_SQL = r"""
WITH docs AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
lines AS (
  SELECT doc_id, i, sum(len(regexp_extract_all(lines[i], '[^\x20\x09-\x0D]+'))) OVER (PARTITION BY doc_id ORDER BY i) AS total,
         len(regexp_extract_all(lines[i], '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM docs)),
windows AS (
  SELECT a.doc_id, a.i AS first, min(e.i) AS last FROM lines a JOIN lines e
    ON a.doc_id = e.doc_id AND e.i >= a.i AND e.total - a.total + a.words >= 30 GROUP BY ALL
  UNION
  SELECT e.doc_id, max(a.i) AS first, e.i AS last FROM lines a JOIN lines e
    ON a.doc_id = e.doc_id AND e.i >= a.i AND e.total - a.total + a.words >= 30 GROUP BY ALL),
named AS (SELECT w.*, list_slice(d.lines, first, last) AS run FROM windows w JOIN docs d USING (doc_id)),
later AS (
  SELECT doc_id, first, last FROM (
    SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, first) AS copy FROM named) WHERE copy > 1),
gone AS (SELECT doc_id, list(DISTINCT i ORDER BY i) AS removed FROM (SELECT doc_id, unnest(range(first, last + 1)) AS i FROM later) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(lines), 0) AS INTEGER) AS n_lines,
       CASE WHEN removed IS NULL THEN text
            ELSE array_to_string(list_filter(lines, lambda x, i: NOT list_contains(removed, i)), chr(10)) END AS text,
       CASE WHEN removed IS NULL THEN '' ELSE array_to_string(list_transform(removed, lambda i: i - 1), ',') END AS removed_lines
FROM docs d LEFT JOIN gone USING (doc_id)
"""


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    net = quality.fit_quality(docs, read_table(spark, sf_dir, "labels"), modulus=3, held_out=1)
    scored = toxicity.with_prediction(quality.quality_scores(docs, net), 0.5)
    return scored.select("doc_id", (fold_of("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return topk.top_k(rows, rows.filter(F.col("vec_id") % 100 == 0), k=10, scale=1024)


OP8_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def op9_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.near_duplicate_classes(read_table(spark, sf_dir, "documents"), words=3, radius=2)
    return classes.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.cut_pieces(read_table(spark, sf_dir, "documents"), tokenizer_path(), CAPACITY, remembered_words=600_000)
    return packing.pack(pieces, CAPACITY).drop("text_key")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_language_id": op2_language_id,
    "op3_mix_sources": op3_mix_sources,
    "op4_ann_search": op4_ann_search,
    "op5_toxicity": op5_toxicity,
    "op6_line_dedup": op6_line_dedup,
    "op7_quality": op7_quality,
    "op8_exact_topk": op8_exact_topk,
    "op9_simhash_neardup": op9_simhash_neardup,
    "op10_best_fit_packing": op10_best_fit_packing,
}

#: DuckDB SQL of the queries that SQL can express; the tests hold the others against brute force.
ORACLE_SQL: dict[str, str] = {"op3_mix_sources": OP3_SQL, "op6_line_dedup": OP6_SQL, "op8_exact_topk": OP8_SQL}
