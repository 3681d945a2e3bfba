"""Fingerprints, neighbours and language-model scores on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tillmark.llm import context_mixing, fingerprints, nearest


def sentences(n, seed=6):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 120))) for _ in range(n)]


def test_fingerprints(spark):
    texts = sentences(200)
    rows = [(i * 3 % 401, t) for i, t in enumerate(texts)] + [(500, texts[7]), (501, texts[7][:-3]), (502, None), (503, ""), (504, "é" * 9), (505, "ñ😀" * 20)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, place int").repartition(4)
    found = {r.doc_id: r for r in fingerprints.fingerprints(docs, low=0.1, high=0.5).collect()}
    rows.sort()
    assert len(found) == len(rows)
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = found[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert found[500].fingerprint == found[7 * 3 % 401].fingerprint
    assert found[500].near_next > 0.5
    mean = lambda c: sum(r[c] for r in found.values()) / len(found)
    assert mean("near_edited") > mean("near_next")


def xx(seed, *values):
    """Spark's xxhash64 of several values, as a signed number; ints hash as 4 bytes, ("long", n) as 8."""
    for v in values:
        data = v.encode() if isinstance(v, str) else v[1].to_bytes(8, "little", signed=True) if isinstance(v, tuple) else v.to_bytes(4, "little", signed=True)
        seed = xxhash.xxh64_intdigest(data, seed % 2**64)
    return seed - 2**64 if seed >= 2**63 else seed


def brute_fingerprints(rows, low, high):
    words = lambda t: {w for w in re.split(r"[\x20\x09-\x0D]+", t.lower()) if w}
    df = Counter(w for _, t in rows for w in words(t or ""))
    band = {w for w, n in df.items() if max(1.0, len(rows) * low) <= n <= max(2.0, len(rows) * high)}

    def hashes(text):
        known = sorted((xx(42, w), w) for w in words(text) & band)
        if not known:
            seed = 42
            for w in sorted(words(text)):
                seed = xx(seed, w)
            return [xx(seed, -1)]
        out = []
        for subset in range(fingerprints.DRAWS * fingerprints.LEVELS):
            draw, level = divmod(subset, fingerprints.LEVELS)
            start = found = xx(42, subset)
            for code, w in known:
                if xx(42, w, draw) & ((2 << level) - 1) == 0:
                    found = xx(42, ("long", found), ("long", code))
            out.append(None if found == start else found)
        return out

    def like(a, b):
        if len(a) != len(b):
            return 0.0
        used = [(x, y) for x, y in zip(a, b) if x is not None or y is not None]
        return sum(x == y for x, y in used) / len(used) if used else 1.0

    text = lambda h: ".".join("-" if x is None else format(x % 2**64, "x") for x in h)
    out, rows = [], sorted(rows)
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        t, after = t or "", after or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        a, b, c = hashes(t), hashes(edited), hashes(after)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), text(a), text(b), like(a, b), like(a, c)))
    return out


def test_fingerprints_by_brute_force(spark):
    rows = [(i * 7 % 401, t) for i, t in enumerate(sentences(150, 9))] + [(500, None), (501, ""), (502, "only here"), (503, "W1 w2\tw3 " * 4000)]
    found = fingerprints.fingerprints(spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, term string, row int").repartition(4), low=0.1, high=0.5)
    assert sorted(tuple(r) for r in found.collect()) == brute_fingerprints(rows, 0.1, 0.5)


def test_fingerprints_of_small_and_repeated_tables(spark):
    one = fingerprints.fingerprints(spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")).collect()
    assert one[0].near_next == 1.0 and one[0].edited_sha256 == hashlib.sha256(b"a b a b").hexdigest()
    many = fingerprints.fingerprints(spark.createDataFrame([(1, "x y"), (1, "x y"), (None, "z"), (None, None)], "doc_id long, text string")).collect()
    assert len(many) == 4
    assert fingerprints.fingerprints(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_neighbours_reach_the_recall(spark):
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(30, 12))
    v = centers[rng.integers(0, 30, 3000)] + 0.3 * rng.normal(size=(3000, 12))
    v[500:1500] = v[500]
    rows = [(i, [float(x) for x in row], i) for i, row in enumerate(v)] + [(5000, None, 1), (5100, [0.0] * 12, 1), (5200, [float("nan")] * 12, 1), (5300, [1.0] * 11 + [None], 1), (None, [1.0] * 12, 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int").repartition(5)
    found = nearest.nearest(table, table.where("vec_id % 100 = 0")).collect()
    by = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert set(by) == set(range(0, 3000, 100))
    hits = 0
    for q, got in by.items():
        d = np.sqrt(((v - v[q]) ** 2).sum(1))
        want = sorted((x, i) for i, x in enumerate(d.tolist()) if i != q)[:10]
        assert got == sorted(got) and len(got) == 10
        assert all(abs(d[i] - s) < 1e-12 for s, i in got)
        hits += len({i for _, i in want} & {i for _, i in got})
    assert hits >= 0.9 * 10 * len(by)
    assert [i for _, i in by[600]] == [i for i in range(500, 511) if i != 600][:10]


def test_neighbours_of_few_or_no_vectors(spark):
    table = spark.createDataFrame([(100, [1.0, 0.0]), (101, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in nearest.nearest(table, table.where("vec_id = 100")).collect()] == [(100, 1, 101, math.sqrt(2))]
    assert nearest.nearest(table.limit(0), table).collect() == []


def tokens_of(text):
    lower = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    return [w for w in re.split(rb"[\x20\x09-\x0D]+", lower) if w] + [None]


@pytest.mark.parametrize("block_bytes", [2000, 1 << 20])
def test_scores_against_counts(spark, monkeypatch, block_bytes):
    store = context_mixing.store_blocks
    monkeypatch.setattr(context_mixing, "store_blocks", lambda d: store(d, block_bytes))
    rows = list(enumerate(sentences(150))) + [(200, None), (201, ""), (202, "y" * 100), (203, "y" * 100 + " é　z\x00"), (None, "w1 w2"), (5, "W3 w3")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, bucket int").repartition(3)
    counts = Counter()
    for i, text in rows:
        if i is None or zlib.crc32(str(i).encode()) % 10:
            counts.update(tokens_of(text))
    n, v = sum(counts.values()), len(counts)
    expected = []
    for i, text in rows:
        own = tokens_of(text)
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        expected.append((i, i is not None and zlib.crc32(str(i).encode()) % 10 == 0, len(own), sum(counts[w] > 0 for w in own), n, round(base, 6)))
    found = context_mixing.lm_scores(docs).collect()
    assert sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found], key=str) == sorted(expected, key=str)
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    known = [r for r in found if r.held_out and r.n_known == r.n_tokens and r.n_tokens > 20]
    assert sum(r.score for r in known) > 1.2 * sum(r.base_score for r in known)


def test_word_probabilities_sum_to_less_than_one():
    """Over all words of one byte and the empty word, the model's bits cannot claim more than everything."""
    words = [b" "] + [bytes([b]) + b" " for b in range(256) if b not in (9, 10, 11, 12, 13, 32)]
    units = np.unique(np.array(words, dtype=f"S{context_mixing.WIDTH}"))
    counts = np.where(np.arange(len(units)) % 7 == 0, 5, 0)
    tables = np.zeros((len(context_mixing.ORDERS), 2, context_mixing.SLOTS), np.float32)
    mixer, total = context_mixing.Mixer(), np.zeros(len(units))
    for rows, edge, bits in context_mixing.Trie(units, counts).levels():
        cost = 0.0
        for bit, _, slots, n0, n1 in bits:
            p = mixer.predict(*mixer.inputs(tables, slots, n0, n1, False, bit))[1]
            cost = cost + np.log(np.where(bit == 1, p, 1 - p))
        total[rows] += cost[edge]
    assert 0 < np.exp(total).sum() <= 1 + 1e-9


def test_no_documents(spark):
    assert context_mixing.lm_scores(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_isolated_vectors_small_groups_and_other_lengths(spark):
    rng = np.random.default_rng(3)
    clustered = rng.normal(size=(20, 8))[rng.integers(0, 20, 3000)] + 0.3 * rng.normal(size=(3000, 8))
    isolated = 20 * rng.normal(size=(20, 8))
    groups = np.repeat(15 * rng.normal(size=(20, 8)), 5, axis=0) + 1e-3 * rng.normal(size=(100, 8))
    v = np.concatenate([clustered, isolated, groups])
    other = rng.normal(size=(40, 5))
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(10_000 + i, x.tolist()) for i, x in enumerate(other)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    by = {}
    for r in nearest.nearest(table, table.where("vec_id >= 3000")).collect():
        by.setdefault(r.query_id, set()).add(r.vec_id)
    assert all(len(by.get(i, ())) == 10 for i, _ in rows[3000:])
    hits = 0
    for i in range(3000, len(v)):
        d = ((v - v[i]) ** 2).sum(1)
        hits += len(by[i] & {j for j in np.argsort(d)[:11].tolist() if j != i})
    assert hits >= 0.9 * 10 * (len(v) - 3000)
    for i in range(40):
        d = ((other - other[i]) ** 2).sum(1)
        assert by[10_000 + i] == {10_000 + j for j in np.argsort(d)[1:11].tolist()}


def test_a_term_brings_its_depth_in_each_draw_in_four_bytes(spark):
    docs = spark.createDataFrame([(i, f"common{i % 7} term{i % 5} only{i}") for i in range(60)], "doc_id long, text string")
    found = fingerprints.lexicon(docs, 0.01, 0.5)
    assert dict(found.dtypes)["depths"] == "int"
    hashed = found.select("term", "depths", F.array(*[F.xxhash64("term", F.lit(draw)) for draw in range(fingerprints.DRAWS)]).alias("drawn")).collect()
    assert len(hashed) == 72
    for row in hashed:
        deep = [min((h & -h).bit_length() - 1 if h else 64, fingerprints.LEVELS) for h in row.drawn]
        assert row.depths == sum(depth << 4 * draw for draw, depth in enumerate(deep))
