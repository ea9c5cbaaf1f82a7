"""Best-fit packing of token sequences with certified repacking."""

from __future__ import annotations

import json
import zlib
from array import array
from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, text_key

#: Words whose ids a task remembers in each of two generations, about 200 bytes each, if not told otherwise.
REMEMBERED_WORDS = 300_000
PIECES = T.StructType([T.StructField(n, t) for n, t in (("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()))])


# The vocabulary's rule for what merges do not cross, and the characters that stand
# for bytes (printable Latin-1 for itself, the other bytes in order from U+0100 on).
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def cuts_words(tokenizer) -> bool:
    """Whether a tokenizer is of the kind whose words may be encoded one by one, in pieces of PIECE.

    It lower-cases, drops white space, splits by PIECE, spells bytes, merges within a piece and has
    no special token that could begin without "<|".
    """
    own = json.loads(tokenizer.to_str())
    parts = lambda kind, inner: [p | {"behavior": None} for p in (own[kind] or {}).get(inner, [])]
    norm, pre = parts("normalizer", "normalizers"), parts("pre_tokenizer", "pretokenizers")
    return (
        [p["type"] for p in norm] == ["NFC", "Replace", "Lowercase"] and norm[1]["pattern"] == {"Regex": "\\s+"} and norm[1]["content"] == " "
        and [p["type"] for p in pre] == ["Split", "ByteLevel"] and pre[0]["pattern"] == {"Regex": PIECE} and pre[0]["invert"] and not pre[1]["add_prefix_space"] and not pre[1]["use_regex"]
        and own["post_processor"] is None and own["model"]["type"] == "BPE" and not own["model"]["dropout"]
        and all(t["content"].startswith("<|") and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in own["added_tokens"])
    )


class PieceIds(dict):
    """Token ids, as little-endian uint32 bytes, of single pieces, straight from the merge model."""

    def __init__(self, model, most: int = REMEMBERED_WORDS):
        self.model = model
        self.most = most
        others = (b for b in range(256) if b not in set(PRINTABLE))
        self.signs = {b: 256 + k for k, b in enumerate(others)}

    def __missing__(self, piece: str) -> bytes:
        # Printable ASCII stands for itself.
        signs = piece if piece.isascii() and piece.isprintable() else piece.encode("utf-8").decode("latin-1").translate(self.signs)
        ids = array("I", [t.id for t in self.model.tokenize(signs)]).tobytes()
        if len(self) >= self.most:
            self.clear()
        self[piece] = ids
        return ids


class WordIds(dict):
    """Token ids, as little-endian uint32 bytes, of words; those used lately are remembered.

    Words looked up since the last change of generation are in the dictionary itself; when it is full
    it becomes ``old``, from which words still in use come back. An unknown word of plain Latin letters
    is lower-cased and cut into pieces here; the tokenizer itself encodes words in which it might
    normalize characters or find a special token.
    """

    def __init__(self, tokenizer, most: int = REMEMBERED_WORDS):
        import regex

        self.tokenizer = tokenizer
        self.most = most
        self.by_word = cuts_words(tokenizer)
        self.old: dict[str, bytes] = {}
        self.pieces = PieceIds(tokenizer.model, most)
        self.cut = regex.compile(PIECE).findall

    def encoded(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        if (ids := self.old.get(word)) is None:
            if len(word) > 1000 or not (word.isascii() or max(word) < "\u0130"):
                ids = self.encoded(word)
            elif word.isalpha():
                ids = self.pieces[word.lower()]
            elif word[-1] in ".,!?;:" and word[:-1].isalpha():
                ids = self.pieces[word[:-1].lower()] + self.pieces[word[-1]]
            elif "<|" in word:
                ids = self.encoded(word)
            else:
                ids = b"".join(map(self.pieces.__getitem__, self.cut(word.lower())))
            if len(word) > 64:
                return ids
        if len(self) >= self.most:
            self.old = self.copy()
            self.clear()
        self[word] = ids
        return ids


@lru_cache(maxsize=2)
def _word_ids(path: str, most: int = REMEMBERED_WORDS) -> WordIds:
    from tokenizers import Tokenizer

    return WordIds(Tokenizer.from_file(path), most)


def token_bytes(text: str, words: WordIds) -> bytes:
    """Ids of a whole text, as bytes. The vocabulary drops white space and merges within words only, so
    a text's ids are those of its white-space-separated words in order. Python also splits at four
    control characters that are symbols to the tokenizer; a text with one is encoded as it is, as is
    every text where the tokenizer is of another kind."""
    if not words.by_word or any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return words.encoded(text)
    return b"".join(map(words.__getitem__, text.split()))


def cut_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", remembered_words: int = REMEMBERED_WORDS) -> DataFrame:
    """``(<id>, text_key, piece, start, length, ids_crc32)``: each document's ids and ``end_id``, cut at ``capacity``.

    ``tokenizer_path``: any file of the tokenizers library; for those of the kind of ``cuts_words``
    the words' ids are remembered, ``remembered_words`` in each of two generations (results do not
    depend on it). A null text is an empty one: one piece that holds ``end_id``.
    """
    end = int(end_id).to_bytes(4, "little")
    names = [id_col, "text_key", *PIECES.names]

    def run(batches):
        words = _word_ids(tokenizer_path, remembered_words)
        for batch in batches:
            take, piece, start, length, crc = [], [], [], [], []
            for row, text in enumerate(batch.column(2)):
                ids = memoryview(token_bytes(text.as_py() or "", words) + end)
                for k, first in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[first : first + 4 * capacity]
                    take.append(row), piece.append(k), start.append(first // 4), length.append(len(part) // 4), crc.append(zlib.crc32(part))
            take = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))], names=names)

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("text_key", T.LongType()), *PIECES])
    return docs.select(F.col(id_col), text_key(text_col).alias("text_key"), F.col(text_col)).mapInArrow(run, schema)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each length, and the number of bins; equal lengths are placed in input order."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_room: dict[int, list[int]] = {}
    rooms: list[int] = []  # rooms that some bin has, ascending
    used = 0
    for i in order.tolist():
        need = int(lengths[i])
        at = bisect_left(rooms, need)
        if at == len(rooms):
            b, room = used, capacity
            used += 1
        else:
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                del by_room[room], rooms[at]
        bins[i], offsets[i] = b, capacity - room
        if left := room - need:
            if left not in by_room:
                by_room[left] = []
                insort(rooms, left)
            by_room[left].append(b)
    return bins, offsets, used


def bin_lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing needs fewer bins: the best of two families of dual feasible functions and the plain sum.

    A dual feasible function maps sizes so that any set fitting one bin sums to one at most. First
    family: sizes over capacity-t count whole, under t nothing, others as they are. Second: sizes are
    counted in steps of 1/k of the bin, a size that is no whole step as its floor of (k+1)/capacity.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    best = -(-int((count * size).sum()) // capacity)
    number, total = np.cumsum(count), np.cumsum(count * size)
    for t in range(1, capacity // 2 + 1):
        whole = number[-1] - number[capacity - t]
        plain = total[capacity - t] - total[t - 1]
        best = max(best, int(whole) - (-int(plain) // capacity))
    for k in range(1, 51):
        step = (k + 1) * size
        exact = step % capacity == 0
        value = np.where(exact, k * size, (step // capacity) * capacity)  # in units of 1/(k*capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def _pack_groups(pieces: DataFrame, columns: list[str], capacity: int) -> DataFrame:
    """Best-fit decreasing in each ``part``, with the part's bin count and lower bound and each bin's fill."""

    def run(pdf):
        lengths = pdf["length"].to_numpy()
        bins, offsets, used = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(bins, weights=lengths, minlength=used).astype(np.int64)
        return pdf.assign(bin=bins, offset=offsets, bins=np.int64(used), bound=np.int64(bin_lower_bound(lengths, capacity)), fill=fill[bins])

    extra = [T.StructField(n, T.LongType()) for n in ("bin", "offset", "bins", "bound", "fill")]
    return pieces.groupBy("part").applyInPandas(run, T.StructType([*pieces.schema, *extra]))


def _dealt(rows: DataFrame, turn: int, parts: int) -> DataFrame:
    """``rows`` with a ``part`` by hash, of the row's number too: equal rows, however many, spread over all parts."""
    return rows.withColumn("part", F.pmod(F.xxhash64(F.lit(turn), F.monotonically_increasing_id(), *rows.columns), F.lit(parts)))


def pack(pieces: DataFrame, capacity: int = 2048, part_rows: int = 50_000, rounds: int = 4) -> DataFrame:
    """``pieces`` (with an integer column ``length``, at most ``capacity``) plus ``sequence_id`` and ``offset``.

    Pieces of full length are sequences by themselves. The others are dealt to parts of about
    ``part_rows``; each part is packed best-fit decreasing and certified by a lower bound. A part that
    meets its bound is final. In the others, bins with no room are final; the documents of all other
    bins are exchanged: dealt anew among fewer parts and packed again, ``rounds`` times at most. What
    is left of the gap then is less than one bin and the loss of best-fit decreasing for each part.

    Any column may be null or repeated but for ``length``; an empty table gives an empty result.
    """
    columns = pieces.columns
    pieces = materialize(pieces, "pieces")
    full = pieces.filter(F.col("length") == capacity).withColumn("sequence_id", F.shiftleft(F.lit(1).cast("long"), 62) + F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    done = [materialize(full, "full")]
    rest, first_id = pieces.filter(F.col("length") < capacity), 0
    count = rest.count()
    for k in range(rounds):
        if not count:
            break
        parts = max(1, -(-count // part_rows))
        dealt = _dealt(rest, k, parts)
        packed = materialize(_pack_groups(dealt.repartition(parts, "part") if parts > 1 else dealt, columns, capacity), "packed")
        # Numbers: part * (most pieces of a part + 1) + bin, above all numbers given before.
        width = packed.agg(F.max("bins")).first()[0] + 1
        numbered = packed.withColumn("sequence_id", F.lit(first_id) + F.col("part") * F.lit(width) + F.col("bin"))
        first_id += parts * width
        last = parts == 1 or k == rounds - 1
        final = F.lit(True) if last else (F.col("bins") <= F.col("bound")) | (F.col("fill") == capacity)
        done.append(numbered.filter(final).select(*columns, "sequence_id", "offset"))
        if last:
            break
        rest = materialize(numbered.filter(~final).select(*columns), "exchange")
        left = rest.count()
        if left == count:
            part_rows *= 2
        count = left
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out
