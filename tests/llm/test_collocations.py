"""Phrase mining against plain counts of every phrase."""

import random
import re
from collections import Counter

import pytest

import oracle
from tillmark.llm import collocations

SCHEMA = "doc_id long, text string, lang string, n string, at int"


def brute(rows, least, returned):
    f, n = {}, Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        often = {p: c for p, c in counts.items() if c >= least}
        ranked = []
        for p, a in often.items():
            if len(p) == 1:
                continue
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: E731, B023
            if any(len(q) > len(p) and inside(q) and 100 * c >= 80 * a for q, c in often.items()):
                continue
            score, _, l, r = min((2000000 * a // (counts[p[:j]] + counts[p[j:]]), j, counts[p[:j]], counts[p[j:]]) for j in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(ranked)[:returned], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def texts(seed):
    rng = random.Random(seed)
    words = ["the", "Of", "a", "Über", "zoë", "x y", "q"] + [f"w{i}" for i in range(12)]
    fixed = [["new", "York", "city"], ["in", "the", "long", "run"], ["ab", "CD"]]
    rows = []
    for i in range(160):
        parts = []
        for _ in range(rng.randrange(0, 12)):
            parts += rng.choice(fixed) if rng.random() < 0.4 else [rng.choice(words) for _ in range(rng.randrange(1, 4))]
            parts.append(rng.choice([" ", ", ", ".", "\n", "\t", "!?", " \x0b"]))
        rows.append((i, " ".join(parts), rng.choice(["en", "de", None, "und", ""]), "x", 1))
    rows += [(900, None, "en", "x", 1), (901, "", "fr", "x", 1), (902, " .,\t", "fr", "x", 1), (None, rows[3][1], rows[3][2], None, None), rows[5], rows[5]]
    return rows + [(903, "so it goes " * 3000, "en", "x", 1), (904, "a b c d. " * 2000, "long", "x", 1)]


@pytest.mark.parametrize("shards, block, slots, returned", [(4, 1 << 20, 1 << 24, 2000), (3, 300, 1 << 24, 7), (2, 300, 16, 2000)])
def test_matches_plain_counts(spark, monkeypatch, shards, block, slots, returned):
    for name, value in {"SHARDS": shards, "BLOCK_BYTES": block, "SLOTS": slots, "LEAST": 6, "RETURNED": returned}.items():
        monkeypatch.setattr(collocations, name, value)
    rows = texts(4)
    found = collocations.collocations(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, 6, returned)


def test_late_phrases_get_a_full_cycle(spark, monkeypatch):
    """Words that only the last shard makes frequent start their phrases late; counts stay exact."""
    for name, value in {"BLOCK_BYTES": 40, "LEAST": 20}.items():
        monkeypatch.setattr(collocations, name, value)
    rows = [(i, "one two three four five", "en", "", 0) for i in range(24)]
    found = collocations.collocations(spark.createDataFrame(rows, SCHEMA).repartition(2)).collect()
    assert sorted(tuple(r) for r in found) == brute(rows, 20, 2000)


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_matches_sql(spark, sf_dir):
    found = collocations.op12_phrase_collocations(spark, sf_dir)
    assert oracle.differences(found, oracle.connect(sf_dir), collocations.SQL) == []
