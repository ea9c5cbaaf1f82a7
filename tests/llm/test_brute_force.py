"""Operators that SQL cannot express, against plain Python on small random tables; models on held-out rows."""

import math
import os
import random
import re
import zlib

import numpy as np
import pytest

from tessella.llm import ann, langid, licenses, linededup, packing, quality, simhash, topk, toxicity
from tessella.llm.queries import ORACLE_SQL, QUERIES, tokenizer_path

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def corpus():
    """Random word texts, near copies, chains of copies and shared line runs."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 5))) for _ in range(200)]
    line = lambda: " ".join(rng.choices(words, k=rng.randint(1, 14)))
    shared = [[line() for _ in range(rng.randint(2, 9))] for _ in range(6)]
    docs = []
    for i in range(120):
        lines = [line() for _ in range(rng.randint(1, 12))]
        if rng.random() < 0.5:
            lines[rng.randint(0, len(lines)) : 0] = rng.choice(shared)[rng.randint(0, 1) :]
        if docs and rng.random() < 0.3:
            copy = rng.choice(docs)[1].split(" ")
            copy[rng.randrange(len(copy))] = rng.choice(words)
            lines = " ".join(copy).split("\n")
        docs.append((i, "\n".join(lines)))
    return docs + [(200 + k, "same words here") for k in range(5)] + [(300, "a b\na b\na b\na b\na b\nc")]


def test_simhash_classes(spark, corpus):
    import xxhash

    prints = {}
    for i, t in corpus:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
        s = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in prints:
        for j in prints:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    df = spark.createDataFrame(corpus, "doc_id long, text string")
    got = simhash.near_duplicate_classes(df).collect()
    assert {r.doc_id: r.fp % 2**64 for r in got} == prints
    assert {r.doc_id: r.component_id for r in got} == {i: find(i) for i in prints}


@pytest.mark.parametrize("pair_limit", [1, 16])
def test_links_connect_what_is_near(spark, pair_limit):
    """Crowded buckets go by half-way points, others by pairs; both must give the same components."""
    from tessella.llm.components import connected_components

    rng = random.Random(2)
    fps = [rng.getrandbits(64) for _ in range(20)]
    for _ in range(150):
        x = rng.choice(fps)
        for b in rng.sample(range(64), rng.choice((1, 2, 2, 3))):
            x ^= 1 << b
        fps.append(x)
    fps = sorted(set(fps))
    signed = [x - 2**64 if x >> 63 else x for x in fps]
    links = simhash.near_links(spark.createDataFrame([(x,) for x in signed], "fp long"), 2, pair_limit)
    assert all((r.a ^ r.b) % 2**64 and ((r.a ^ r.b) % 2**64).bit_count() <= 2 for r in links.collect())
    root = {r.node: r.root for r in connected_components(links).collect()}
    group = {x: x for x in signed}
    changed = True
    while changed:
        changed = False
        for x in signed:
            for y in signed:
                if ((x ^ y) % 2**64).bit_count() <= 2 and group[x] > group[y]:
                    group[x], changed = group[y], True
    assert {x: root.get(x, x) for x in signed} == group


def test_masks_cover_every_pair():
    for radius in (0, 2, 4):
        masks = simhash.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        rng = random.Random(radius)
        for _ in range(300):
            spots = sum(1 << b for b in rng.sample(range(64), radius))
            assert any(not m & spots for m in masks)


def test_line_runs(spark, corpus):
    least = 12
    seen, want = set(), {}
    for i, t in sorted(corpus):
        lines = t.split("\n")
        gone, fresh = set(), []
        for a in range(len(lines)):
            for e in range(a, len(lines)):
                if sum(len(x.split()) for x in lines[a : e + 1]) >= least:
                    run = tuple(lines[a : e + 1])
                    if run in seen:
                        gone.update(range(a, e + 1))
                    seen.add(run)
        del fresh
        want[i] = sorted(gone)
    df = spark.createDataFrame(corpus, "doc_id long, text string")
    got = {r.doc_id: (r._removed, r.text) for r in linededup.remove_repeated_runs(df, least).collect()}
    assert {i: x for i, (x, _) in got.items()} == want and sum(map(len, want.values())) > 20
    for i, t in corpus:
        assert got[i][1] == "\n".join(x for k, x in enumerate(t.split("\n")) if k not in want[i])


def test_packing_round_trip(spark, corpus):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    docs = corpus + [(400 + k, " ".join(t for _, t in corpus[k : k + 40])) for k in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = packing.pack(packing.cut_pieces(df, tokenizer_path()), part_rows=40).toPandas()
    for i, t in docs:
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4")
        own = out[out.doc_id == i].sort_values("piece")
        assert own.piece.tolist() == list(range(-(-len(ids) // 2048)))
        assert own.start.tolist() == list(range(0, len(ids), 2048))
        assert [zlib.crc32(ids[s : s + n].tobytes()) for s, n in zip(own.start, own.length, strict=True)] == own.ids_crc32.tolist()
    for _, own in out.sort_values("offset").groupby("sequence_id"):
        ends = own.length.cumsum()
        assert own.offset.tolist() == [0, *ends.tolist()[:-1]] and ends.iloc[-1] <= 2048
    bound = packing.bin_lower_bound(out.length.to_numpy(), 2048)
    assert bound <= out.sequence_id.nunique() <= bound * 1.01 + 1


def test_lower_bounds_hold():
    rng = np.random.default_rng(0)
    for high in (30, 60, 100):
        for _ in range(40):
            sizes = rng.integers(1, high + 1, rng.integers(1, 9))
            best = len(sizes)

            def place(k, bins, sizes=sizes):
                nonlocal best
                if len(bins) >= best:
                    return
                if k == len(sizes):
                    best = len(bins)
                    return
                for b in range(len(bins)):
                    if bins[b] + sizes[k] <= 100:
                        place(k + 1, [*bins[:b], bins[b] + sizes[k], *bins[b + 1 :]])
                place(k + 1, [*bins, sizes[k]])

            place(0, [])
            used = packing.best_fit_decreasing(sizes, 100)[2]
            assert packing.bin_lower_bound(sizes, 100) <= best <= used


def test_context_trees():
    """Code lengths equal those of a plain walk down each language's contexts."""
    samples = {"a": [b"abracadabra abc", b"bab", b""], "b": [b"the cat sat on the mat"], "c": ["ñandú".encode()]}
    model = langid.compile_ppm(samples)
    text = "the abra zñ".encode()
    for lang, got in zip(model.languages, model.code_lengths([text, b""])[0], strict=True):
        seen: dict[bytes, dict[int, int]] = {}
        for d in samples[lang]:
            b = langid.LEAD + d
            for i in range(4, len(b)):
                for k in range(5):
                    own = seen.setdefault(b[i - k : i], {})
                    own[b[i]] = own.get(b[i], 0) + 1
        total, b = 0.0, langid.LEAD + text
        for i in range(4, len(b)):
            for k in range(4, -1, -1):
                own = seen.get(b[i - k : i])
                if own is None:
                    continue
                n, t = sum(own.values()), len(own)
                if b[i] in own:
                    total -= math.log(own[b[i]] / (n + t))
                    break
                total -= math.log(t / (n + t))
            else:
                total += math.log(256)
        assert got == pytest.approx(total, rel=1e-5)


def test_long_texts_score_as_in_one_piece(monkeypatch):
    model = langid.compile_ppm({"a": [b"abc abd " * 9], "b": [b"xyz xyw " * 9]})
    text = b"abc xyz abd " * 50
    whole = model.code_lengths([text])
    monkeypatch.setattr(langid, "BYTES_AT_ONCE", 37)
    assert np.allclose(model.code_lengths([text]), whole, rtol=1e-5)


def test_quality_chunks_cover_the_text():
    text = bytes(random.Random(0).randrange(1, 256) for _ in range(3000))
    chunks = quality.chunk_bytes(text)
    for k, c in enumerate(chunks):
        at = k * quality.HOP
        assert c[: quality.CHUNK].tobytes().rstrip(b"\0") == text[at : at + quality.CHUNK]
    assert (len(chunks) - 1) * quality.HOP + quality.CHUNK >= len(text)
    net = quality.train([("good words all along " * 5, 1), ("### !!! *** " * 9, 0)] * 20, epochs=4)
    assert np.allclose(net.score([b"good words", text, b""]), [net.score([t])[0] for t in (b"good words", text, b"")])


def test_license_windows(spark):
    rng = random.Random(1)
    noise = lambda n: " ".join(rng.choices(["lorem", "ipsum", "license", "software", "conditions"], k=n))
    rows = [(k, f"{noise(rng.randint(0, 40))} {t} {noise(30)}") for k, t in enumerate(licenses.TEMPLATES.values())]
    names = list(licenses.TEMPLATES)
    changed = licenses.template_words(licenses.TEMPLATES["mit"])
    changed[40] = "something"
    rows += [(50, " ".join(changed)), (51, " ".join(changed[:40])), (52, noise(500))]
    got = {(r.doc_id, r.license) for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {(k, n) for k, n in enumerate(names)} <= got
    assert (50, "mit") in got and not {i for i, _ in got} & {51, 52}


def test_grammar():
    grammar = toxicity.Grammar()
    i, t, n, r, g, w, th = toxicity.INSULT, toxicity.TARGET, toxicity.NEGATION, toxicity.REPORT, toxicity.INTENT, toxicity.WORD, toxicity.THREAT
    assert grammar.patterns([w, i]) == ["insult"]
    assert grammar.patterns([t, w, i]) == ["insult+aimed"]
    assert grammar.patterns([n, w, i]) == ["insult+negated"] and grammar.patterns([n, w, w, w, i]) == ["insult"]
    assert grammar.patterns([r, t, n, i]) == ["insult+aimed+negated+reported"]
    assert grammar.patterns([g, th]) == ["meant"] and grammar.patterns([w, th, w]) == ["threat"]
    lexicon = toxicity.Lexicon(frozenset({"dolt"}), ("bloc",))
    assert list(toxicity.clauses_with_triggers("Fine. You dolt! Adolt, blockhead? dolts; a bloc.", lexicon)) == [" you dolt", " adolt, blockhead"]
    assert lexicon.is_insult("blocks") and not lexicon.is_insult("bloc")


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")
def test_recall_of_approximate_search(spark):
    """Recall against brute force over the driver's vectors; at least nine in ten."""
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet")
    got = {}
    for r in ann.search(rows, rows.filter("vec_id % 20 = 0"), k=20, vectors_per_list=30).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    p = rows.toPandas()
    v, ids = np.array(p.embedding.tolist(), float), p.vec_id.to_numpy()
    hits = []
    for q in np.flatnonzero(ids % 20 == 0):
        s = v @ v[q]
        s[q] = -np.inf
        hits.append(len(got[ids[q]] & set(ids[np.lexsort((ids, -s))[:20]])) / 20)
    assert np.mean(hits) >= 0.9


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    import glob

    import duckdb

    db = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    rows = lambda d: sorted(tuple(r) for r in d[sorted(d.columns)].itertuples(index=False))
    assert rows(QUERIES[name](spark, DATA).toPandas()) == rows(db.execute(ORACLE_SQL[name]).df())


def test_products_of_any_size():
    """Exact in doubles, longs or Python's integers; what does not fit a long is held at the nearest."""
    rng = np.random.default_rng(3)
    left = np.concatenate([np.floor(rng.normal(size=(20, 6)) * 10.0**e) for e in (2, 7, 9, 12, 20, 200)])
    right = np.concatenate([np.floor(rng.normal(size=(15, 6)) * 10.0**e) for e in (1, 8, 10, 18, 250)])
    right[3] = 0
    want = [[min(max(sum(int(x) * int(y) for x, y in zip(a, b, strict=True)), -topk.LONGEST), topk.LONGEST) for b in right] for a in left]
    assert topk.exact_products(left, right).tolist() == want


@pytest.mark.parametrize("query_bytes", [1 << 26, 512])
def test_exact_search_with_outliers(spark, monkeypatch, query_bytes):
    """Small and huge vectors, ties, several turns of queries, against Python's integers."""
    monkeypatch.setattr(topk, "QUERY_BYTES", query_bytes)
    rng = np.random.default_rng(0)
    v = rng.integers(-3, 4, (300, 4)) / 8
    v[7], v[8], v[9], v[20] = [1e18, 1, 0, 0], [1e250, 0, 0, 1], [-1e12, 1, 1, 1], [1e15, 0, 0, 0]
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(500, [1.0, 2.0]), (501, [1.0] * 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in topk.top_k(df, df.filter("vec_id % 20 = 0"), k=7).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    whole = [[math.floor(int(y) * 1024 if abs(y) > 2**40 else y * 1024) for y in x] for x in v.tolist()]
    for q in range(0, 300, 20):
        score = lambda j: min(max(sum(a * b for a, b in zip(whole[q], whole[j], strict=True)), -topk.LONGEST), topk.LONGEST)  # noqa: B023, E731
        want = sorted((-score(j), j) for j in range(300) if j != q)[:7]
        assert sorted(got[q]) == [(k + 1, j, -s) for k, (s, j) in enumerate(want)], q
    assert set(got) == set(range(0, 300, 20))
