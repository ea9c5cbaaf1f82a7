"""The corpus pipeline, stage by stage, against plain Python on the smallest tables."""

import hashlib
import os
import re
import zlib

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from tessella.llm import packing, quality
from tessella.llm.queries import WEIGHTS, tokenizer_path

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def good(docs, labels, spark):
    net = quality.fit_quality(docs, labels)
    return [r for r in docs.collect() if net.score([(r.text or "").encode()])[0] >= 0.5]


def without_repeats(rows, least=30):
    """Later copies of every run of lines with ``least`` words go."""
    seen, out = set(), []
    for r in sorted(rows, key=lambda r: r.doc_id):
        lines, gone = r.text.split("\n"), set()
        counts = [len(x.split()) for x in lines]
        for a in range(len(lines)):
            total = 0
            for e in range(a, len(lines)):
                total += counts[e]
                # Least runs only: from a on, or up to e. All longer ones are made of them.
                if total >= least and (total - counts[e] < least or total - counts[a] < least):
                    run = hashlib.md5("\n".join(lines[a : e + 1]).encode()).digest()
                    if run in seen:
                        gone.update(range(a, e + 1))
                    seen.add(run)
                if total - counts[a] >= least:
                    break
        if len(gone) < len(lines):
            out.append((r.doc_id, "\n".join(x for k, x in enumerate(lines) if k not in gone), r.source))
    return out


def one_of_each(rows):
    prints = []
    for _, text, _ in rows:
        w = [x.encode().lower() for x in words(text)]
        s = [b" ".join(w[k : k + 5]) for k in range(len(w) - 4)] or ([b" ".join(w)] if w else [])
        h = np.array([xxhash.xxh64_intdigest(x, 42) for x in s], np.uint64)
        prints.append(sum(1 << b for b in range(64) if 2 * int((h >> np.uint64(b) & np.uint64(1)).sum()) > len(h)))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)), key=lambda k: rows[k][0])
                root[b] = a
    return [r for k, r in enumerate(rows) if find(k) == k]


def mixture(rows, share=1.5, limit=2.0):
    size = {r: len(words(r[1])) for r in rows}
    sources = sorted({r[2] for r in rows})
    total = {s: sum(size[r] for r in rows if r[2] == s) for s in sources}
    weight = {s: WEIGHTS[k % len(WEIGHTS)] for k, s in enumerate(sources)}
    target, free, left = {}, set(sources), share * sum(total.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] >= limit * total[s]}
        for s in over or free:
            target[s] = limit * total[s] if over else level * weight[s]
        left -= sum(target[s] for s in over)
        free -= over or free
    out = []
    for s in sources:
        whole = int(target[s] // total[s])
        p, room = target[s] / total[s] - whole, target[s] - whole * total[s]

        def rank(r, p=p):
            token = f":{r[0]}:{hashlib.md5(r[1].encode()).hexdigest()}"
            u = (int(hashlib.md5(token.encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            return u / (1 - u) / (p / (1 - p))

        before = 0
        for r in sorted((r for r in rows if r[2] == s), key=rank) if p else [r for r in rows if r[2] == s]:
            out += [r] * (whole + (p > 0 and before + size[r] / 2 <= room))
            before += size[r]
    return out


def test_stages_equal_plain_python(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality_filter"](spark, docs, DATA)
    plain = good(docs, labels, spark)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in plain)
    clean = stages["line_dedup"](spark, kept, DATA)
    plain = without_repeats(plain)
    assert sorted((r.doc_id, r.text) for r in clean.collect()) == sorted((i, t) for i, t, _ in plain)
    single = stages["simhash_neardup"](spark, clean, DATA)
    plain = one_of_each(plain)
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, _, _ in plain)
    mixed = stages["mix_sources"](spark, single, DATA)
    plain = mixture(plain)
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(i for i, _, _ in plain)
    packed = stages["best_fit_packing"](spark, mixed, DATA).toPandas()
    tokenizer = packing._word_ids(tokenizer_path()).tokenizer
    want = []
    for i, t, _ in plain:
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4")
        want += [(i, s // 2048, s, len(ids[s : s + 2048]), zlib.crc32(ids[s : s + 2048].tobytes())) for s in range(0, len(ids), 2048)]
    assert sorted(want) == sorted(packed[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None))
    assert packed.groupby("sequence_id").length.sum().max() <= 2048
    assert packed.sequence_id.nunique() <= packing.bin_lower_bound(packed.length.to_numpy(), 2048) * 1.02 + 1


def test_run_equals_its_stages(spark):
    out = corpus_pipeline.run(spark, DATA)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0
