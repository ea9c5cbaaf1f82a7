"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fold_of, materialize

ORDER = 4
UNKNOWN = "und"
#: What stands before a text, so that its first bytes have a context.
LEAD = b"\n" * ORDER
#: Bytes scored at once.
BYTES_AT_ONCE = 1 << 18
#: Groups into which a language's texts are dealt when some of them are chosen.
SHARES = 64


@dataclass
class GramTable:
    """Integer codes with a row of values each, looked up by three hashed tables and a sorted rest."""

    codes: np.ndarray  # sorted, uint64
    values: np.ndarray  # (codes, languages) float32
    levels: list = field(default_factory=list, repr=False)

    def _slots(self, codes: np.ndarray, level: int, bits: int) -> np.ndarray:
        odd = np.uint64((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)[level])
        return (codes * odd) >> np.uint64(64 - bits)

    def build(self) -> None:
        """Hashed tables about four times as large as what they hold; later levels hold the collisions."""
        rows = np.arange(len(self.codes))
        for level in range(3):
            bits = max(4, int(4 * len(rows) + 1).bit_length())
            slots = self._slots(self.codes[rows], level, bits)
            at = np.full(1 << bits, -1, np.int32)
            at[slots] = rows
            self.levels.append((bits, at))
            rows = rows[at[slots] != rows]
            if not len(rows):
                break

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Row of each code, -1 where there is none."""
        if not len(self.codes):
            return np.full(len(codes), -1)
        if not self.levels:
            self.build()
        bits, at = self.levels[0]
        row = at[self._slots(codes, 0, bits)]
        row[self.codes[row] != codes] = -1
        miss = np.flatnonzero(row < 0)
        for level in range(1, len(self.levels)):
            bits, at = self.levels[level]
            some = at[self._slots(codes[miss], level, bits)]
            some[self.codes[some] != codes[miss]] = -1
            row[miss] = some
            miss = miss[some < 0]
        if len(self.levels) == 3 and len(miss):
            where = np.minimum(np.searchsorted(self.codes, codes[miss]), len(self.codes) - 1)
            row[miss] = np.where(self.codes[where] == codes[miss], where, -1)
        return row


@dataclass
class PpmModel:
    """Per-language byte context trees with frozen counts, compiled to log probabilities (natural).

    ``grams[m]``: for a context of m bytes and a next byte seen in any language, each language's
    log probability of the byte. ``escapes[m]``: for a context of m bytes seen in any language, each
    language's log probability of an escape from it (0 where the language has not seen it).
    """

    languages: list[str]
    grams: list[GramTable]
    escapes: list[GramTable]

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Exact code length in nats of each text under each language: (texts, languages)."""
        out = np.zeros((len(texts), len(self.languages)))
        rows: list[int] = []
        parts: list[bytes] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if parts:
                data = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint64)
                code = np.zeros(len(data) - ORDER, np.uint64)
                for k in range(ORDER + 1):
                    code |= data[ORDER - k : len(data) - k] << np.uint64(8 * k)
                lengths = [len(p) for p in parts]
                starts = np.cumsum([0] + lengths[:-1])
                logs = self._logs(code)
                # The first ORDER bytes of a part are only context.
                for k in range(1, ORDER + 1):
                    logs[starts[1:] - k] = 0
                np.add.at(out, rows, -np.add.reduceat(logs, starts, axis=0, dtype=np.float64) if len(logs) else 0)
            rows.clear(), parts.clear()
            size = 0

        for i, text in enumerate(texts):
            for first in range(0, len(text), BYTES_AT_ONCE):
                before = text[max(0, first - ORDER) : first]
                part = (LEAD + before)[-ORDER:] + text[first : first + BYTES_AT_ONCE]
                rows.append(i), parts.append(part)
                size += len(part)
                if size >= BYTES_AT_ONCE:
                    flush()
        flush()
        return out

    def _logs(self, code: np.ndarray) -> np.ndarray:
        out = np.zeros((len(code), len(self.languages)), np.float32)
        open_ = slice(None)
        for m in range(ORDER, -1, -1):
            keys = code & np.uint64((1 << (8 * (m + 1))) - 1)
            row = self.grams[m].find(keys)
            hit = row >= 0
            if m == ORDER:
                if hit.all():
                    return np.take(self.grams[m].values, row, axis=0)
                out[hit] = np.take(self.grams[m].values, row[hit], axis=0)
                open_ = np.flatnonzero(~hit)
            else:
                out[open_[hit]] += self.grams[m].values[row[hit]]
                open_ = open_[~hit]
            code, keys = code[~hit], keys[~hit]
            if not len(code):
                return out
            ctx = self.escapes[m].find(keys >> np.uint64(8))
            known = ctx >= 0
            out[open_[known]] += self.escapes[m].values[ctx[known]]
        out[open_] -= np.float32(np.log(256))
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and its posterior under equal priors; ``und`` with 0 for a text without a letter."""
        names = [UNKNOWN] * len(texts)
        scores = np.zeros(len(texts))
        asked = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        if asked and self.languages:
            bits = self.code_lengths([texts[i].encode("utf-8") for i in asked])
            best = bits.argmin(axis=1)
            scores[asked] = 1 / np.exp(-(bits - bits[np.arange(len(best)), best][:, None])).sum(axis=1)
            for i, b in zip(asked, best.tolist(), strict=True):
                names[i] = self.languages[b]
        return names, scores


def compile_ppm(samples: dict[str, list[bytes]]) -> PpmModel:
    """Count every context of up to ORDER bytes in each language's texts and freeze the statistics.

    Escapes by method C: a context seen n times with t different next bytes gives a seen byte
    count/(n+t) and an escape t/(n+t), after which the context one byte shorter decides; under the
    empty context a byte escapes to 1/256.
    """
    languages = sorted(samples)
    counts = []  # counts[language][m]: codes and how often
    for lang in languages:
        parts = [LEAD + t for t in samples[lang] if t]
        data = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint64)
        keep = np.ones(max(0, len(data) - ORDER), bool)
        for start in np.cumsum([0] + [len(p) for p in parts])[1:-1]:
            keep[max(0, start - ORDER) : start] = False
        code = np.zeros(len(keep), np.uint64)
        for k in range(ORDER + 1 if len(keep) else 0):
            code |= data[ORDER - k : len(data) - k] << np.uint64(8 * k)
        code = code[keep]
        counts.append([np.unique(code & np.uint64((1 << (8 * (m + 1))) - 1), return_counts=True) for m in range(ORDER + 1)])
    grams, escapes = [], []
    for m in range(ORDER + 1):
        codes = np.unique(np.concatenate([np.zeros(0, np.uint64), *(c[m][0] for c in counts)]))
        contexts = np.unique(codes >> np.uint64(8))
        values = np.zeros((len(codes), len(languages)), np.float32)
        leave = np.zeros((len(contexts), len(languages)), np.float32)
        if m:
            lower = grams[m - 1].find(codes & np.uint64((1 << (8 * m)) - 1))
        for j, c in enumerate(counts):
            own, n = c[m]
            group, where = np.unique(own >> np.uint64(8), return_inverse=True)
            total, kinds = np.bincount(where, weights=n, minlength=len(group)), np.bincount(where, minlength=len(group))
            escape = np.log(kinds / (total + kinds))
            at = np.searchsorted(contexts, group)
            leave[at, j] = escape
            base = grams[m - 1].values[lower, j] if m else np.full(len(codes), -np.log(256), np.float32)
            values[:, j] = base + leave[np.searchsorted(contexts, codes >> np.uint64(8)), j]
            values[np.searchsorted(codes, own), j] = np.log(n / (total + kinds)[where])
        grams.append(GramTable(codes, values))
        escapes.append(GramTable(contexts, leave))
    for table in (*grams, *escapes):
        table.levels.clear()
    return PpmModel(languages, grams, escapes)


def fit_languages(docs: DataFrame, modulus: int = 4, held_out: int = 2, docs_per_lang: int = 300, max_chars: int = 12_000, sample_chars: int = 48_000_000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> PpmModel:
    """Context trees from at most ``docs_per_lang`` distinct texts of at most ``max_chars`` for each language.

    Only rows with text and language whose crc32(id) mod ``modulus`` is not ``held_out`` count. Every
    language that has such a text is learned: those texts come first that are no longer than
    ``max_chars``, by hash, then the middles of longer ones. With so many languages that the sample
    could pass ``sample_chars``, each gets fewer texts, but one at least. Texts that many rows repeat
    count once. The sample is the same on every run; the model's tables hold a number for each
    language and context of the sample.
    """
    known = docs.select(F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("_lang"), F.col(text_col).alias("_text")).filter(F.col("_lang").isNotNull() & (F.length("_text") > 0)).filter(fold_of("_id", modulus) != held_out)
    known = known.select("_lang", F.xxhash64("_text").alias("_h"), "_text")
    kinds = known.groupBy("_lang", "_h").agg(F.max(F.length("_text") > max_chars).alias("long"))
    # Spark keeps no more than docs_per_lang rows of a group in any task before it deals them out. First
    # SHARES groups a language, as otherwise one task would get that many from every other.
    least = lambda rows, *by: rows.withColumn("turn", F.row_number().over(Window.partitionBy("_lang", *by).orderBy("long", "_h"))).filter(F.col("turn") <= docs_per_lang)
    some = materialize(least(kinds.withColumn("share", F.pmod(F.xxhash64("_h"), F.lit(SHARES))), "share").drop("turn"), "some")
    chosen = materialize(least(some).select("_lang", "_h", "turn"), "chosen")
    languages = chosen.select("_lang").distinct().count()
    each = max(1, min(docs_per_lang, sample_chars // (max_chars * max(1, languages))))
    middle = F.col("_text").substr(F.floor(F.greatest(F.length("_text") - max_chars, F.lit(0)) / 2).cast("int") + 1, F.lit(max_chars))
    drawn = known.join(chosen.filter(F.col("turn") <= each), ["_lang", "_h"]).select("_lang", "turn", middle.alias("_text")).dropDuplicates(["_lang", "turn"])
    samples: dict[str, list[bytes]] = {}
    for r in sorted(drawn.collect()):
        samples.setdefault(r["_lang"], []).append(r["_text"].encode("utf-8"))
    return compile_ppm(samples)


def predict_languages(docs: DataFrame, model: PpmModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(<id>, lang_pred, score)`` per row from its whole text alone; a null text gives ``und`` and 0."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            names: list[str] = []
            scores = [np.zeros(0)]
            for i in range(0, len(batch), 256):
                found, p = shared.value.predict(batch.column(1)[i : i + 256].to_pylist())
                names += found
                scores.append(p)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(np.concatenate(scores))], names=[id_col, "lang_pred", "score"])

    schema = T.StructType([docs.schema[id_col], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.select(id_col, text_col).mapInArrow(run, schema)
