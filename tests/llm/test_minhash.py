"""Near duplicates against all pairs on a small table, and what sketches promise."""

import random

import numpy as np
import pytest

from test_jaccard_join import documents, shingle_set
from tillmark.llm import minhash

SCHEMA = "doc_id long, text string, node long, bands string"


def brute(rows):
    sets = [shingle_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    names = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            names[find(i)] = min(names.get(find(i), doc_id), doc_id)
    out = [(doc_id, len(sets[i]), names.get(find(i))) for i, (doc_id, _) in enumerate(rows)]
    return sorted(((*r, r[0] == r[2]) for r in out), key=str)


def chain(rng, n):
    """Near copies of which neighbours link and far ones do not, some with an exact copy."""
    words, rows = [f"c{rng.randrange(500)}" for _ in range(120)], []
    for i in range(n):
        words = list(words)
        words[rng.randrange(len(words))] = f"n{i}"
        rows += [(2000 + 3 * i, " ".join(words))] * (1 + (i % 7 == 0))
    return rows


def star(rng, n):
    """Copies of one text that link with it, and mostly not with each other."""
    words = [f"s{rng.randrange(500)}" for _ in range(150)]
    rows = [(9000, " ".join(words))]
    for i in range(n):
        own = list(words)
        for _ in range(2):
            own[rng.randrange(len(own))] = f"m{i}"
        rows.append((9001 + i, " ".join(own)))
    return rows


@pytest.mark.parametrize("part, block_bytes", [(2048, 1 << 20), (8, 3000)])
def test_matches_all_pairs(spark, monkeypatch, part, block_bytes):
    monkeypatch.setattr(minhash, "PART", part)
    store = minhash.store_blocks
    monkeypatch.setattr(minhash, "store_blocks", lambda d: store(d, block_bytes))
    rng = random.Random(9)
    rows = documents(3) + chain(rng, 90) + star(rng, 60)
    docs = spark.createDataFrame([(i, t, 1, "b") for i, t in rows], SCHEMA).repartition(3)
    found = minhash.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted([tuple(r) for r in found], key=str) == brute(rows)


def test_documents_without_ids(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (None, ""), (3, None)]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted([tuple(r) for r in found], key=str) == [(3, 0, 3, True), (None, 0, None, True), (None, 2, None, True), (None, 2, None, True)]


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_every_coordinate_fills_and_agreement_follows_similarity():
    rng = np.random.default_rng(5)
    one = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (1, 2, 3, 20, 125, 3000)]
    found = minhash.sketches(one)
    assert (found != minhash._EMPTY).all()
    assert (minhash.sketches(one[2:3]) == found[2]).all()
    for n in (40, 400):
        agree = []
        for _ in range(40):
            tokens = rng.integers(0, 2**63, n + n // 4).astype(np.uint64)
            a, b = minhash.sketches([tokens[:n], tokens[n // 4 :]])
            agree.append((a == b).mean())
        exact = (n - n // 4) / (n + n // 4)
        assert abs(np.mean(agree) - exact) < 0.03 and np.std(agree) < 0.06
