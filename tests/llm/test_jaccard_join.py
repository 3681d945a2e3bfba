"""The Jaccard join against all pairs on a small table."""

import random
import re

import pytest

from tillmark.llm import jaccard_join, set_join


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [shingle_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and 100 * common >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    names = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            names[find(i)] = min(names.get(find(i), doc_id), doc_id)
    return sorted(((doc_id, len(sets[i]), names.get(find(i))) for i, (doc_id, _) in enumerate(rows)), key=str)


def documents(seed=2):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows, base = [], []
    for i in range(260):
        if base and rng.random() < 0.7:
            words = list(rng.choice(base))
            for _ in range(rng.randrange(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                words = words[: max(1, int(len(words) * rng.uniform(0.75, 1)))]
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 120))]
            if rng.random() < 0.3:
                words += passage
        base.append(words)
        rows.append(((i * 37) % 260, " ".join(words)))
    rows += [(900, None), (901, ""), (902, " \n\t"), (903, "One two"), (904, "one TWO"), (905, "two one"), (None, rows[0][1]), (10, rows[1][1]), (10, rows[1][1])]
    return rows + [(906, rows[5][1] + " x" * 3000), (907, rows[5][1] + " x" * 3000)]


@pytest.mark.parametrize("part, block_bytes", [(1024, 1 << 20), (16, 3000)])
def test_matches_all_pairs(spark, monkeypatch, part, block_bytes):
    monkeypatch.setattr(set_join, "PART", part)
    store = jaccard_join.store_blocks
    monkeypatch.setattr(jaccard_join, "store_blocks", lambda d: store(d, block_bytes))
    rows = documents()
    docs = spark.createDataFrame([(i, t, 1, "n") for i, t in rows], "doc_id long, text string, n int, node string").repartition(3)
    found = jaccard_join.near_documents(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted([tuple(r) for r in found], key=str) == brute(rows)


def test_empty_table(spark):
    assert jaccard_join.near_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("part", [1024, 16])
def test_every_link_counts(spark, monkeypatch, part):
    monkeypatch.setattr(set_join, "PART", part)
    rows = documents(5)
    sets = [shingle_set(text) for _, text in rows]
    near = lambda a, b: a and 100 * len(a & b) >= 80 * len(a | b)
    expected = [(i, sum(bool(near(a, b)) for b in sets) - bool(a)) for (i, _), a in zip(rows, sets)]
    assert max(n for _, n in expected) > 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = jaccard_join.near_documents(docs).select("doc_id", "n_links").collect()
    assert sorted([tuple(r) for r in found], key=str) == sorted(expected, key=str)
