"""Bounded labelled samples for fitting classifiers on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_of


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, modulus: int, held_out: int, rows_per_class: int, max_chars: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[list[tuple[str, int]], dict[int, int]]:
    """At most ``2 * rows_per_class`` pairs (text, label), and the number of labelled rows per class.

    Only rows with a 0/1 label whose crc32(id) mod ``modulus`` is not ``held_out`` count. The sample is
    the same on every run: the ids smallest by hash, whole texts of ``max_chars`` at most (null: empty),
    equal texts once per label. It holds ``2 * rows_per_class * max_chars`` characters at most.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).filter(F.col("_y").isin(0, 1)).filter(fold_of("_id", modulus) != held_out)
    counts = {int(y): int(n) for y, n in known.groupBy("_y").count().collect()}
    order = (F.xxhash64("_id"), F.col("_id"))
    # Twice the rows, as some of their texts may be too long, repeated or missing.
    picked = [known.filter(F.col("_y") == y).orderBy(*order).limit(2 * rows_per_class) for y in (0, 1)]
    chosen = picked[0].unionByName(picked[1])
    texts = docs.select(F.col(id_col).alias("_doc"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).filter(F.length("_text") <= max_chars)
    found = texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id"))
    out: list[tuple[str, int]] = []
    for y in (0, 1):
        best = found.filter(F.col("_y") == y).orderBy(*order, F.xxhash64("_text")).select("_text").limit(rows_per_class).collect()
        out += [(t, y) for t in dict.fromkeys(r[0] for r in best)]
    return out, counts
