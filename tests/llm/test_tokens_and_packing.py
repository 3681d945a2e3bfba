"""Token counts and packing against the tokenizer itself."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillmark.llm import packing
from tillmark.llm.pieces import Encoder
from tillmark.llm.token_counts import token_counts, tokenizer_path

HARD = list("ab 1'\n\t!?\x1c\x1f") + ["<|endoftext|>", "'ll", "é", "😀", " ", "　", "\r\n", "\x85", "\x0b", "\0", "²", "Ω", "Word,", " well-known"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def hard_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(HARD) for _ in range(rng.randrange(60))) for _ in range(n)] + ["", "x" * 5000, "lorem ipsum " * 4000]


def test_pieces_give_the_ids_of_whole_texts(tokenizer):
    texts = hard_texts(3000)
    coder = Encoder(tokenizer_path())
    found = [np.frombuffer(data[a:b], "<u4").tolist() for data, at in coder.encode(pa.array(texts)) for a, b in zip(at[:-1], at[1:])]
    assert found == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_small_memory_changes_nothing(tokenizer, monkeypatch):
    from tillmark.llm import pieces

    monkeypatch.setattr(pieces, "MEMORY", 5)
    monkeypatch.setattr(pieces, "GROUP", 100)
    texts = hard_texts(200, seed=2)
    found = [(b - a) // 4 for _, at in Encoder(tokenizer_path()).encode(pa.array(texts)) for a, b in zip(at[:-1], at[1:])]
    assert found == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_few_bytes_are_looked_up_at_once(monkeypatch):
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("aeioulnrst", k=9)) for _ in range(10_000)) for _ in range(80)]
    coder, at_once, encoded = Encoder(tokenizer_path()), [], []
    monkeypatch.setattr(coder, "_look_up", lambda pieces: at_once.append(sum(map(len, pieces))) or dict.fromkeys(pieces, b""))
    for _, at in coder.encode(pa.array(texts)):
        encoded.append(len(at) - 1)
    assert sum(encoded) == len(texts) and max(at_once) <= 5 << 20


def test_units_that_blanks_set_apart_need_no_mark(tokenizer):
    coder = Encoder(tokenizer_path())
    units = [" well", "\nknown", " 日本", " a\x1c", "  x", " 't", "x", " <|endoftext|>", "\n", " é", " \u2003y"]
    assert coder._encode(units) == {unit: np.array(tokenizer.encode(unit, add_special_tokens=False).ids, "<u4").tobytes() for unit in units}
    coder.mark = ""
    assert coder._encode([" well", "\nknown"]) == {unit: coder._alone(unit) for unit in (" well", "\nknown")}


def test_counts_of_nulls_and_extra_columns(spark, tokenizer):
    docs = spark.createDataFrame([(1, "a b", 5), (1, "a b", 6), (None, None, 7), (2, "", 8)], "doc_id long, text string, n_tokens int")
    found = sorted([tuple(r) for r in token_counts(docs, tokenizer_path()).collect()], key=str)
    assert found == [(1, 3, 2), (1, 3, 2), (2, 0, 0), (None, 0, 0)]
    assert token_counts(docs.limit(0), tokenizer_path()).collect() == []


def check(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_keeps_every_id(spark, tokenizer):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma,", "Delta"]) for _ in range(int(rng.expovariate(1 / 60)))) for _ in range(300)]
    texts += [None, "", texts[0], texts[0], "word " * 1500]
    docs = spark.createDataFrame([(i if i % 50 else None, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, key int").repartition(4)
    rows = packing.pack(docs, tokenizer_path(), capacity=128).collect()
    n = check(rows, 128)
    expected = []
    for i, text in enumerate(texts):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 128 or min(128, len(ids))
        cuts = [0, *range(first, len(ids) + 1, 128)]
        for piece, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            expected.append((i if i % 50 else None, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows], key=str) == sorted(expected, key=str)
    total = sum(length for *_, length, _ in expected)
    assert n <= 1.03 * total / 128 + 2


@pytest.mark.parametrize("sizes", [[345] * 300, [1] * 3000, [600] * 40 + [424] * 40, list(range(1, 1024)), [1024] * 3, []])
def test_best_fit_places_each_item_once(spark, sizes):
    items = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "key long, size int")
    rows = packing.best_fit(items).collect()
    assert sorted((r.key, r["size"]) for r in rows) == list(enumerate(sizes))
    used = {}
    for r in rows:
        used[r.seq] = used.get(r.seq, 0) + r["size"]
    assert max(used.values(), default=0) <= 1024
    per = max(1, 1024 // sizes[0]) if len(set(sizes)) == 1 else None
    if per:
        assert len(used) == -(-len(sizes) // per)


def test_empty_table_packs_to_nothing(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), tokenizer_path()).collect() == []
