"""Substring dedup against a brute-force version, and the suffix order against sorting."""

import hashlib
import random

import numpy as np
import pytest

from tillmark.llm import suffix_dedup as op


def brute(rows):
    """(doc_id, n_bytes, n_removed, n_spans, kept hash) per row."""
    least = {}
    data = [(doc_id, (text or "").encode()) for doc_id, text in rows]
    for doc_id, b in data:
        for i in range(len(b) - op.LENGTH + 1):
            w = b[i : i + op.LENGTH]
            if doc_id is not None:
                least[w] = min(least.get(w, doc_id), doc_id)
    out = []
    for doc_id, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - op.LENGTH + 1):
            if doc_id is not None and least[b[i : i + op.LENGTH]] < doc_id:
                gone[i : i + op.LENGTH] = b"\1" * op.LENGTH
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def documents():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 8)))
    passages = [" ".join(word() for _ in range(rng.randrange(5, 40))) for _ in range(12)]
    rows = []
    for i in range(150):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(word() for _ in range(rng.randrange(1, 30))) for _ in range(rng.randrange(1, 6))]
        rows.append((i * 7 % 150, " ".join(parts)))
    rows += [(200, rows[3][1]), (200, rows[3][1]), (201, rows[4][1][:-1] + "!"), (None, rows[5][1]), (None, None), (202, None), (203, "")]
    rows += [(204, "a" * 500), (205, "a" * 120), (206, "ab" * 200), (-3, "ab" * 100), (207, rows[0][1] * 40)]
    return rows


def digest(frame):
    from pyspark.sql import functions as F

    found = frame.select("doc_id", "n_bytes", F.col("n_bytes") - F.octet_length("kept"), F.size("spans"), F.sha2("kept", 256)).collect()
    return sorted([tuple(r) for r in found], key=str)


@pytest.mark.parametrize("block_bytes", [1000, 1 << 20])
def test_matches_brute_force(spark, monkeypatch, block_bytes):
    rows = documents()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, block string, ids int").repartition(3)
    store = op.store_blocks
    monkeypatch.setattr(op, "store_blocks", lambda d: store(d, block_bytes))
    assert digest(op.removed_spans(docs)) == brute(rows)


def test_empty_table(spark):
    assert op.removed_spans(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("size", [1 << 17, 40])
def test_suffix_ranks_follow_sorted_windows(monkeypatch, size):
    monkeypatch.setattr(op, "SUB_BUCKET", size)
    rng = np.random.default_rng(3)
    base = rng.integers(97, 99, 300).astype(np.uint8)
    data = np.concatenate([base, rng.integers(97, 123, 200).astype(np.uint8), base[50:250], np.full(120, 97, np.uint8), base])
    starts = np.arange(len(data) - op.LENGTH + 1)
    ranks = op.window_classes(data, starts)
    windows = [data[i : i + op.LENGTH].tobytes() for i in starts]
    ordered = sorted(windows)
    first = {}
    for at, window in enumerate(ordered):
        first.setdefault(window, at)
    assert ranks.tolist() == [first[w] for w in windows]
