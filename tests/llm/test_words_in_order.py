"""Scores in the order of the text: runs of words, the mixer that learns as it goes, and what order and repeats change."""

import math
import random

import numpy as np
import pytest

from tillmark.llm import context_mixing

TEXTS = ["a b a b c", "", "b", "c c c a b a b", "a b c d e f g h i j k l m n o p q r s t a b"]


def squash(x):
    return 1 / (1 + math.exp(-x))


def one_text(logs, seen, totals):
    """One text, word by word, in steps after which its mixers learn."""
    weights, recent, out = [list(w) for w in context_mixing.ORDER_WEIGHTS], [0.0, 0.0], []
    for low in range(0, len(logs), context_mixing.STEP):
        change, bits = [[0.0] * 3, [0.0] * 3], [[], []]
        for i in range(low, min(low + context_mixing.STEP, len(logs))):
            x = [[1.0, math.log(max(totals[k][i], 1)) / 4, recent[k]] for k in (0, 1)]
            gate = [squash(sum(a * b for a, b in zip(x[k], weights[k]))) if totals[k][i] else 0.0 for k in (0, 1)]
            share = [seen[k][i] / totals[k][i] if totals[k][i] else 0.0 for k in (0, 1)]
            one = gate[0] * share[0] + (1 - gate[0]) * 10 ** logs[i]
            both = gate[1] * share[1] + (1 - gate[1]) * one
            out.append(math.log10(both))
            taken = gate[1] * share[1] / both
            bit, expected = [(1 - taken) * gate[0] * share[0] / one, taken], [(1 - taken) * gate[0], gate[1]]
            for k in (0, 1):
                if totals[k][i]:
                    bits[k].append(bit[k])
                    change[k] = [c + (bit[k] - expected[k]) * v for c, v in zip(change[k], x[k])]
        for k in (0, 1):
            weights[k] = [w + context_mixing.ORDER_RATE * c for w, c in zip(weights[k], change[k])]
            if bits[k]:
                recent[k] += (sum(bits[k]) / len(bits[k]) - recent[k]) / 2
    return out


def test_texts_of_a_block_are_mixed_as_one_by_one():
    rng = np.random.default_rng(5)
    sizes = np.array([1, 40, 8, 17, 1, 9])
    first, n = np.cumsum(sizes) - sizes, sizes.sum()
    logs, totals = -5 * rng.random(n), rng.integers(0, 6, (2, n))
    seen = rng.integers(0, totals + 1)
    found = context_mixing.mixed_in_order(logs, seen, totals, first, sizes)
    for a, size in zip(first, sizes):
        some = slice(a, a + size)
        assert found[some] == pytest.approx(one_text(logs[some], seen[:, some], totals[:, some]), abs=1e-9)


def test_a_word_far_too_unlikely_for_a_float_keeps_a_finite_score():
    logs, none = np.array([-900.0, -1.0]), np.zeros((2, 2), np.int64)
    assert all(v > 0 for v in context_mixing.squash(np.array([-40.0, 40.0])))
    assert context_mixing.mixed_in_order(logs, none, none, np.array([0]), np.array([2])).tolist() == pytest.approx([-900, -1])
    found = context_mixing.mixed_in_order(logs, none, none + 3, np.array([0]), np.array([2]))
    assert np.isfinite(found).all() and (found < logs).all()


def test_runs_of_two_and_three_words():
    words = sorted({w.encode() for t in TEXTS for w in t.split()})
    tokens = np.array([words.index(w.encode()) for t in TEXTS for w in t.split()], np.int64)
    lens = np.array([len(t.split()) for t in TEXTS])
    stream, one, first, keys, place = context_mixing.in_order(words, tokens, lens)
    expected = [["", "", *t.split(), ""] for t in TEXTS]
    runs = [[tuple(x[i - k : i + 1]) for x in expected for i in range(2, len(x))] for k in (1, 2)]
    assert len(stream) == len(runs[0]) and first.tolist() == np.cumsum([0, *(lens + 1)])[:-1].tolist()
    assert [(*words, b"")[i].decode() for i in one] == [run[0] for run in runs[0]]
    by_key = {}
    for k in (0, 1):
        for run, at in zip(runs[k], place[k]):
            assert by_key.setdefault(run, keys[at]) == keys[at]
    assert len(set(by_key.values())) == len(by_key) == len(keys)


def test_order_and_repeats_of_words_change_a_score(spark):
    rng = random.Random(4)
    names = [f"word{i}" for i in range(60)]
    phrases = [" ".join(rng.choices(names, k=6)) for _ in range(12)]
    texts = [" ".join(rng.choices(phrases, k=8)) for _ in range(120)]
    lone = [" ".join(rng.choices(names, k=48)) for _ in range(12)]
    rows = [*enumerate(texts + lone), *((1000 + i, lone[i]) for i in range(6))]
    turned = [(i, " ".join(rng.sample(t.split(), len(t.split()))) if i % 2 else t) for i, t in rows]

    def scores(some, parts):
        docs = spark.createDataFrame(some, "doc_id long, text string").repartition(parts)
        return {r.doc_id: r for r in context_mixing.lm_scores(docs).collect()}

    plain = scores(rows, 3)
    # Only half of the texts keep their order, so the others lose by it.
    mixed = scores(turned, 3)
    held = [i for i, r in plain.items() if r.held_out and i < 120]
    assert held and all(plain[i].score > plain[i].base_score for i in held)
    assert sum(mixed[i].score - plain[i].score for i in plain if i < 120 and i % 2) < -100
    bits = {i: plain[i].bits_per_byte for i in plain}
    # A held-out copy teaches nothing.
    twice = [120 + i for i in range(6) if not plain[1000 + i].held_out]
    assert twice and max(bits[i] for i in twice) < 0.9 * min(bits[126 + i] for i in range(6))


def test_counts_of_runs_leave_out_held_out_texts_and_the_word_itself(spark):
    rows = [(i, "one two three four five six seven eight nine ten") for i in (1, 2)] + [(5, "ten nine eight seven six")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    both = {r.doc_id: r.score for r in context_mixing.lm_scores(docs).collect()}
    alone = {r.doc_id: r.score for r in context_mixing.lm_scores(docs.where("doc_id <> 2")).collect()}
    assert both[1] == pytest.approx(both[2]) and both[1] > alone[1] + 3


def test_numbers_survive_their_planes():
    some = [np.array([], np.uint64), np.array([7, 1 << 50, (1 << 64) - 1], np.uint64), np.arange(900, dtype=np.uint64)]
    data, at = b"head" + b"".join(context_mixing.planes(x) for x in some), 4
    for x in some:
        found, at = context_mixing.from_planes(data, at, "<u8")
        assert found.tolist() == x.tolist()
    assert at == len(data)
