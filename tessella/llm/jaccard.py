"""Near-duplicates by exact Jaccard similarity of word shingles; SimHash links and MinHash bands find the pairs to compare."""

from __future__ import annotations

from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, slices, text_key
from .components import connected_components
from .simhash import keep_heads, majority_of, near_links, shingle_hashes

SEED = 42
#: Bands of ROWS least hashes: a pair of similarity s shares no band with probability (1-s^ROWS)^BANDS,
#: 3 in 10^6 at 0.8.
BANDS, ROWS = 24, 4
#: Differing bits of the SimHash fingerprints that are linked.
RADIUS = 2
#: Members of a bucket that all others are compared with.
HEADS = 8
#: Shingles whose hashes are held at once, 8 * BANDS * ROWS bytes each.
SHINGLES_AT_ONCE = 512

_RANDOM = np.random.default_rng(SEED)
_FLIPS = _RANDOM.integers(0, 1 << 64, BANDS * ROWS, np.uint64)[:, None]
_ODDS = _RANDOM.integers(0, 1 << 64, BANDS * ROWS, np.uint64)[:, None] | np.uint64(1)
_JOIN = _RANDOM.integers(0, 1 << 64, (BANDS, ROWS), np.uint64) | np.uint64(1)
_SHIFT = _RANDOM.integers(0, 1 << 64, BANDS, np.uint64)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The distinct shingle hashes of a text, as sorted signed longs."""
    hashes, total = shingle_hashes(text, words)
    return np.unique(np.fromiter(islice(hashes, total), np.uint64, total).view(np.int64))


def band_keys(members: np.ndarray) -> np.ndarray:
    """One signed long for each band of a set; none if the set is empty."""
    if not len(members):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for first in range(0, len(members), SHINGLES_AT_ONCE):
        part = members[first : first + SHINGLES_AT_ONCE].view(np.uint64)
        mixed = (part ^ _FLIPS) * _ODDS
        mixed ^= mixed >> np.uint64(29)
        np.minimum(least, (mixed * _ODDS).min(axis=1), out=least)
    return ((least.reshape(BANDS, ROWS) * _JOIN).sum(axis=1, dtype=np.uint64) + _SHIFT).view(np.int64)


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """``(<id>, text_key, sig, n, fp, keys)`` per row: a 64-bit name of its shingle set, the set's size, its SimHash fingerprint, its bands."""
    import xxhash

    def run(batches):
        for batch in slices(batches):
            sets = [shingle_set(t, words) for t in batch.column(2).to_pylist()]
            sigs = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64)
            sizes = np.array([len(s) for s in sets], np.int64)
            fps = np.array([majority_of(s.view(np.uint64)) for s in sets], np.int64)
            keys = pa.array([band_keys(s) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sigs), pa.array(sizes), pa.array(fps), keys], names=[id_col, "text_key", "sig", "n", "fp", "keys"])

    long = T.LongType()
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *(T.StructField(c, long) for c in ("text_key", "sig", "n", "fp")), T.StructField("keys", T.ArrayType(long))])
    return docs.select(F.col(id_col), text_key(text_col).alias("text_key"), F.col(text_col)).mapInArrow(run, schema)


def _sets_of(docs: DataFrame, rows: DataFrame, wanted: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """``(sig, members)`` for each ``sig`` of ``wanted``, from one row that has it."""
    one = rows.groupBy("sig").agg(F.min(F.struct(F.col(id_col).alias("id"), F.col("text_key").alias("key"))).alias("h"))
    one = materialize(one.join(wanted, "sig", "left_semi").select("sig", F.col("h.id").alias("_id"), F.col("h.key").alias("_key")), "one")
    data = docs.select(F.col(id_col).alias("_doc"), text_key(text_col).alias("_text_key"), F.col(text_col).alias("_text"))
    found = data.join(one, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key"))).select("sig", "_text").dropDuplicates(["sig"])

    def run(batches):
        for batch in slices(batches):
            sets = [shingle_set(t, words) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["sig", "members"])

    schema = T.StructType([T.StructField("sig", T.LongType()), T.StructField("members", T.ArrayType(T.LongType()))])
    return materialize(found.mapInArrow(run, schema), "sets")


def _alike(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``(a, b)`` whose sets have the similarity, exactly compared."""
    both = pairs.join(sets.select(F.col("sig").alias("a"), F.col("members").alias("x")), "a")
    both = both.join(sets.select(F.col("sig").alias("b"), F.col("members").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    judged = both.select("a", "b", shared.alias("shared"), (F.size("x") + F.size("y")).alias("total"))
    return judged.filter(F.col("shared") / (F.col("total") - F.col("shared")) >= threshold).select("a", "b")


def _roots(links: DataFrame) -> DataFrame:
    return materialize(connected_components(links).select(F.col("node").alias("sig"), "root"), "roots")


def _scattered(dealt: DataFrame, roots: DataFrame) -> DataFrame:
    """``dealt`` plus ``root``: the buckets whose members are not all connected yet."""
    placed = dealt.join(roots, "sig", "left").select(*dealt.columns, F.coalesce("root", "sig").alias("root"))
    placed = materialize(placed, "placed")
    # Written, so that joins deal both sides anew and Spark can split the rows of a very large bucket.
    split = materialize(placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("key"), "split")
    return materialize(placed.join(split, "key", "left_semi"), "left")


def _pairs_by_simhash(rows: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``(a, b)`` of sets whose SimHash fingerprints are linked at RADIUS bits or fewer: one set stands for
    each fingerprint, and the others that have it are paired with that one."""
    named = materialize(rows.select("fp", "sig", "n").distinct(), "named")
    least = materialize(named.groupBy("fp").agg(F.min(F.struct("sig", "n")).alias("h")).select("fp", F.col("h.sig").alias("one"), F.col("h.n").alias("one_n")), "fps")
    links = materialize(near_links(least, RADIUS), "links")
    ends = [least.select(F.col("fp").alias(c), F.col("one").alias(f"{c}_sig"), F.col("one_n").alias(f"{c}_n")) for c in "ab"]
    linked = links.join(ends[0], "a").join(ends[1], "b").select("a_sig", "a_n", "b_sig", "b_n")
    same = named.join(least, "fp").filter("sig <> one").select(F.col("sig").alias("a_sig"), F.col("n").alias("a_n"), F.col("one").alias("b_sig"), F.col("one_n").alias("b_n"))
    near = linked.unionByName(same).filter(_near("a_n", "b_n", threshold))
    return near.select(F.least("a_sig", "b_sig").alias("a"), F.greatest("a_sig", "b_sig").alias("b")).distinct()


def _pairs_with_heads(left: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``(a, b)`` of each bucket's members with the HEADS of them that meet most others, where not connected."""
    turn = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("met"), "sig"))
    heads = left.withColumn("turn", turn).filter(F.col("turn") <= HEADS).select("key", F.col("sig").alias("head"), F.col("n").alias("head_n"), F.col("root").alias("head_root"))
    both = left.join(materialize(heads, "heads"), "key").filter((F.col("root") != F.col("head_root")) & _near("n", "head_n", threshold))
    return both.select(F.least("sig", "head").alias("a"), F.greatest("sig", "head").alias("b")).distinct()


def _pairs_by_prefix(left: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``(a, b)`` of members not connected that could have the similarity: each pair that has it, and few others.

    Shingles are put in one order, rare ones first. Sets of n and m shingles of similarity t or more
    have t/(1+t) * (n+m) in common, so the first they share comes early in both: what either lacks of
    that number is all that may stand before it. So members are paired by their first shingles only,
    and those that differ from all others in many rare shingles meet nobody, however many there are.
    """
    members = left.select("sig", "n", "root").distinct()
    shingles = materialize(members.join(sets, "sig").select("sig", "n", "root", F.explode("members").alias("s")), "shingles")
    often = materialize(shingles.groupBy("s").agg(F.count("*").alias("df")).filter("df > 1"), "often")
    turn = F.row_number().over(Window.partitionBy("sig").orderBy("df", "s"))
    first = shingles.join(often, "s", "left").withColumn("df", F.coalesce("df", F.lit(1))).withColumn("turn", turn)
    # A little less than the bound, so that rounding cannot cut a prefix short. No partner has fewer than t * n.
    first = first.filter(F.col("turn") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1)
    first = materialize(first.select("sig", "n", "root", "s", "turn"), "prefixes")
    shared = materialize(first.groupBy("s").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("s"), "shared")
    first = materialize(first.join(shared, "s", "left_semi"), "prefixes")
    a, b = (first.select("s", *(F.col(c).alias(f"{p}_{c}") for c in ("sig", "n", "root", "turn"))) for p in "ab")
    common = F.ceil((F.col("a_n") + F.col("b_n")) * (threshold / (1 + threshold)) - 1e-9)
    early = (F.col("a_turn") <= F.col("a_n") - common + 1) & (F.col("b_turn") <= F.col("b_n") - common + 1)
    both = a.join(b, "s").filter((F.col("a_root") < F.col("b_root")) & _near("a_n", "b_n", threshold) & early)
    return both.select(F.least("a_sig", "b_sig").alias("a"), F.greatest("a_sig", "b_sig").alias("b")).distinct()


def _near(n: str, m: str, threshold: float) -> Column:
    """No pair of sizes further apart can have the similarity."""
    return F.least(n, m) >= threshold * F.greatest(n, m)


def similar_classes(docs: DataFrame, threshold: float = 0.8, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(<id>, text_key, root)`` per row; rows share a root if links of Jaccard ``threshold`` connect them.

    Rows of equal shingle sets are one node; texts without a word are one class. First sets whose SimHash
    fingerprints are linked are compared. At RADIUS bits these are hardly all pairs of 0.8, so MinHash bands
    give more: each member of a bucket is compared with the member that meets most others in all its buckets, as a text does of
    which others are changed copies; then, in buckets that do not lie in one component, with HEADS such
    members: work in proportion to the members. Members that are still apart are paired by rare
    shingles, so that no pair that shares a band is passed over unless it is connected already.
    """
    rows = materialize(signatures(docs, id_col, text_col, words), "signatures")
    dealt = materialize(rows.select("sig", "n", F.explode("keys").alias("key")).distinct(), "dealt")
    sizes = materialize(dealt.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1"), "sizes")
    crowded = materialize(dealt.join(sizes, "key"), "crowded")
    met = materialize(crowded.groupBy("sig").agg(F.sum("c").alias("met")), "met")
    crowded = materialize(crowded.join(met, "sig").select("key", "sig", "n", "met"), "crowded")
    heads = crowded.groupBy("key").agg(F.min(F.struct((-F.col("met")).alias("minus"), "sig", "n")).alias("h"))
    heads = materialize(heads.select("key", F.col("h.sig").alias("head"), F.col("h.n").alias("head_n")), "heads")
    linked = materialize(_pairs_by_simhash(rows, threshold), "linked")
    wanted = met.select("sig").unionByName(linked.select(F.explode(F.array("a", "b")).alias("sig"))).distinct()
    sets = _sets_of(docs, rows, wanted, id_col, text_col, words)
    first = crowded.join(heads, "key").filter((F.col("sig") != F.col("head")) & _near("n", "head_n", threshold)).select(F.least("sig", "head").alias("a"), F.greatest("sig", "head").alias("b"))
    seen = materialize(first.unionByName(linked).distinct(), "pairs")
    links = materialize(_alike(seen, sets, threshold), "alike")
    left = _scattered(crowded, _roots(links))
    for pairs_of in (_pairs_with_heads, lambda left, t: _pairs_by_prefix(left, sets, t)):
        more = materialize(pairs_of(left, threshold).join(seen, ["a", "b"], "left_anti"), "pairs")
        seen = seen.unionByName(more)
        links = links.unionByName(materialize(_alike(more, sets, threshold), "alike"))
        roots = _roots(links)
        if pairs_of is _pairs_with_heads:
            left = _scattered(left.drop("root"), roots)
    return rows.select(id_col, "text_key", "sig").join(roots, "sig", "left").select(id_col, "text_key", F.coalesce("root", "sig").alias("root"))


def keep_one_of_each(docs: DataFrame, threshold: float = 0.8, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that represent their class of similar texts: the smallest (id, text key), once."""
    return keep_heads(docs, similar_classes(docs, threshold, words, id_col, text_col), id_col, text_col)
