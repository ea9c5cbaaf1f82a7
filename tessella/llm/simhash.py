"""SimHash near-duplicates linked by covering locality-sensitive hashing."""

from __future__ import annotations

from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, slices, text_key
from .components import connected_components

BITS = 64
SEED = 42
#: Shingle hashes held at once by a task: 64 bytes each while bits are counted.
HASHES_AT_ONCE = 1 << 17


def shingle_hashes(text: str | None, words: int = 3):
    """Iterator over the XXH64 values of a text's word shingles, and how many there are."""
    import xxhash

    tokens = (text or "").encode("utf-8").lower().split()
    if not tokens:
        return iter(()), 0
    if len(tokens) < words:
        return iter((xxhash.xxh64_intdigest(b" ".join(tokens), SEED),)), 1
    shingles = map(b" ".join, zip(*(islice(tokens, k, None) for k in range(words))))
    return map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), len(tokens) - words + 1


def majority_bits(texts: list[str | None], words: int = 3) -> np.ndarray:
    """One uint64 fingerprint per text: bit set where over half of the shingle hashes set it."""
    ones, totals = np.zeros((len(texts), BITS), np.int64), np.zeros(len(texts), np.int64)
    rows: list[int] = []
    starts: list[int] = []
    held: list[np.ndarray] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if size:
            bits = np.unpackbits(np.concatenate(held).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            np.add.at(ones, rows, np.add.reduceat(bits, starts, axis=0, dtype=np.int32))
        rows.clear(), starts.clear(), held.clear()
        size = 0

    for row, text in enumerate(texts):
        hashes, total = shingle_hashes(text, words)
        totals[row] = total
        for first in range(0, total, HASHES_AT_ONCE):
            part = np.fromiter(islice(hashes, HASHES_AT_ONCE), np.uint64, min(HASHES_AT_ONCE, total - first))
            rows.append(row), starts.append(size), held.append(part)
            size += len(part)
            if size >= HASHES_AT_ONCE:
                flush()
    flush()
    return np.packbits(2 * ones > totals[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def majority_of(hashes: np.ndarray) -> int:
    """The fingerprint of one text from its shingle hashes, as a signed long."""
    ones = np.zeros(BITS, np.int64)
    for first in range(0, len(hashes), HASHES_AT_ONCE):
        ones += np.unpackbits(hashes[first : first + HASHES_AT_ONCE].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """``(<id>, text_key, fp)`` for each row: its id, a 64-bit key of its text, its fingerprint as a signed long."""

    def run(batches):
        for batch in slices(batches):
            fps = majority_bits(batch.column(2).to_pylist(), words).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)], names=[id_col, "text_key", "fp"])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("text_key", T.LongType()), T.StructField("fp", T.LongType())])
    return docs.select(F.col(id_col), text_key(text_col).alias("text_key"), F.col(text_col)).mapInArrow(run, schema)


def covering_masks(radius: int) -> list[int]:
    """2^(radius+1)-1 masks; any ``radius`` positions are all outside one of them at least.

    Position i has a non-zero vector m(i) of radius+1 bits; the mask of a non-zero vector v keeps the
    positions with an odd number of common ones. ``radius`` equations leave some non-zero v.
    """
    top = (1 << (radius + 1)) - 1
    code = [1 + i % top for i in range(BITS)]
    return [sum(1 << i for i in range(BITS) if (code[i] & v).bit_count() % 2) for v in range(1, top + 1)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def near_links(fps: DataFrame, radius: int = 2, pair_limit: int = 16) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct ``fp`` at ``radius`` differing bits or fewer.

    The covering masks deal fingerprints into buckets. In a bucket of at most ``pair_limit`` members
    the pairs are compared. A larger bucket would give too many: there each member is listed under
    every point within radius/2 flips of the bits its mask drops, and linked to the smallest member
    listed at the same point. Two fingerprints within the radius share a point half way, and members
    at one point are within the radius, so nothing is lost and nothing false is linked; the rows
    made are a constant times the members. ``radius`` must be even.
    """
    if radius % 2 or radius < 0:
        raise ValueError("radius must be even")
    masks = [_signed(m) for m in covering_masks(radius)]
    slots = F.explode(F.array(*(F.struct(F.lit(k).alias("m"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(masks))))
    dealt = fps.select("fp").distinct().select("fp", slots.alias("s")).select("fp", "s.m", "s.key")
    sizes = dealt.groupBy("m", "key").agg(F.count("*").alias("n")).filter("n > 1")
    crowded = materialize(dealt.join(sizes, ["m", "key"]), "buckets")
    near = f"filter(fps, b -> b > a AND bit_count(a ^ b) <= {radius})"
    small = (
        crowded.filter(F.col("n") <= pair_limit).groupBy("m", "key").agg(F.collect_list("fp").alias("fps"))
        .select(F.explode(F.expr(f"flatten(transform(fps, a -> transform({near}, b -> struct(a AS a, b AS b))))")).alias("e")).select("e.a", "e.b")
    )
    flips = []
    for k, m in enumerate(masks):
        free = [1 << i for i in range(BITS) if not (m >> i) & 1]
        flips.append([0] + [_signed(sum(c)) for r in range(1, radius // 2 + 1) for c in combinations(free, r)])
    by_mask = F.array(*(F.array(*(F.lit(x).cast("long") for x in f)) for f in flips))
    listed = crowded.filter(F.col("n") > pair_limit).select("m", "key", "fp", F.explode(F.get(by_mask, F.col("m"))).alias("flip"))
    listed = listed.select("m", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    heads = listed.groupBy("m", "point").agg(F.min("fp").alias("b"), F.count("*").alias("n")).filter("n > 1").select("m", "point", "b")
    large = listed.join(heads, ["m", "point"]).filter("fp <> b").select(F.col("fp").alias("a"), "b")
    return small.unionByName(large).distinct()


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """``(<id>, text_key, fp, root, component_id)`` per row; component_id is the smallest id reachable by
    links, root the smallest fingerprint.

    A null text, or one without a word, has fingerprint zero and is linked like any other. A null id
    is no candidate for component_id (null only if the whole component has none); repeated rows stay
    separate rows of one class. Other columns of ``docs``, whatever their names, play no part.
    An empty table gives an empty result.
    """
    rows = materialize(fingerprints(docs, id_col, text_col, words), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min(id_col).alias("least_id"))
    roots = connected_components(near_links(nodes, radius)).withColumnRenamed("node", "fp")
    placed = materialize(nodes.join(roots, "fp", "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root")), "placed")
    # Written, so that joins deal both sides anew and Spark can split the rows of a very large class.
    shared = materialize(placed.filter("root <> fp").select("root").distinct(), "shared")
    linked = placed.join(shared, "root", "left_semi")
    ids = materialize(linked.groupBy("root").agg(F.min("least_id").alias("component_id")), "ids")
    classes = linked.join(ids, "root").select("fp", "root", "component_id").unionByName(
        placed.join(shared, "root", "left_anti").select("fp", "root", F.col("least_id").alias("component_id"))
    )
    return rows.join(classes, "fp").select(id_col, "text_key", "fp", "root", "component_id")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """The rows of ``docs`` that represent their near-duplicate class: the smallest (id, text key), once.

    Nulls sort first among ids. If the chosen row is repeated, one of its equal copies stays.
    """
    return keep_heads(docs, near_duplicate_classes(docs, id_col, text_col, words, radius), id_col, text_col)


def keep_heads(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest (id, text key) of each ``root`` in ``classes``, once."""
    head = F.struct(F.col(id_col).alias("id"), F.col("text_key").alias("key"))
    copies = classes.groupBy(F.col("root").alias("g"), head.alias("h")).agg(F.count("*").alias("n"))
    chosen = materialize(copies.groupBy("g").agg(F.min(F.struct("h", "n")).alias("c")).select(F.col("c.h.id").alias("_id"), F.col("c.h.key").alias("_key"), (F.col("c.n") > 1).alias("_again")), "chosen")
    # The whole row travels as one column, so no name of its own can clash.
    data = docs.select(F.col(id_col).alias("_doc"), text_key(text_col).alias("_text_key"), F.struct(*docs.columns).alias("_row"))
    kept = data.join(chosen, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key")))
    once = kept.filter(~F.col("_again")).select("_row.*")
    return once.unionByName(kept.filter("_again").dropDuplicates(["_doc", "_text_key"]).select("_row.*"))
