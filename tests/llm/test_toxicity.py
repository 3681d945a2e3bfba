"""Restoration of disguised words and held-out scores of planted documents."""

import random

import numpy as np
import pytest

from tillmark.llm import toxicity


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(8)
    syllables = ["an", "the", "ti", "on", "re", "sh", "in", "ou"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    bad, hidden = ["idiot", "moron", "clown"], ["1d10t", "m0r0n", "c l o w n", "idioooot", "m.o.r.o.n", "Cl0wn!"]
    rows = []
    for i in range(900):
        words = [word() for _ in range(rng.randrange(5, 80))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(bad if i % 5 else hidden))
        rows.append((i, " ".join(words), int(toxic)))
    rows += [(1000, None, None), (1001, "", 0), (None, "idiot", 1), (1002, "x" * 200_000, None)]
    docs = spark.createDataFrame([(i, t, "k") for i, t, _ in rows], "doc_id long, text string, label string")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int")
    return docs, labels, rows


def test_scores_and_columns(spark, planted):
    docs, labels, rows = planted
    trained = toxicity.train(docs, labels.where(~toxicity.held_out("doc_id", 5)))
    plain = {"idiot", "moron", "clown"}
    assert plain <= set(trained[1])
    # What else is chosen are the disguises as written.
    assert all(plain & set(toxicity.Decoder(trained[0]).words(word)) for word in trained[1])
    scored = toxicity.toxicity(docs, *trained)
    assert scored.columns == ["doc_id", "text", "label", "toxicity"]
    score = {(r.doc_id, r.text): r.toxicity for r in scored.collect()}
    assert len(score) == len(rows)
    assert all(0 <= s <= 1 for s in score.values())
    wrong = [i for i, text, toxic in rows if toxic is not None and i is not None and (score[i, text] >= 0.5) != bool(toxic)]
    assert len(wrong) < 9
    assert score[1000, None] == score[1001, ""] < 0.5


def test_decoder_prefers_likely_letters():
    counts = np.zeros(toxicity.N**3)
    for word in ["idiot", "loser", "moron"] * 50:
        letters = [toxicity.EDGE, *(toxicity.CODE[c] for c in word), toxicity.EDGE]
        for a, b, c in zip([toxicity.EDGE, *letters], letters, letters[1:]):
            counts[(a * toxicity.N + b) * toxicity.N + c] += 1
    decoder = toxicity.Decoder(toxicity.letter_model([(i, n) for i, n in enumerate(counts) if n]))
    assert [decoder.words(w)[-1] for w in ("1d10t", "l0$er", "m.o.r.o.n", "looooser", "id*ot", "plain,")] == ["idiot", "loser", "moron", "loser", "idiot", "plain"]
    assert toxicity.spelled_apart("so m o r o n. is".split()) == [" moron"]
    assert decoder.words("2024") == ("2024",) and decoder.words("***") == ()


def test_without_labels_every_score_is_one_half(spark, planted):
    docs, labels, _ = planted
    scored = toxicity.toxicity(docs.limit(3), *toxicity.train(docs.limit(3), labels.limit(0)))
    assert {r.toxicity for r in scored.collect()} == {0.5}


@pytest.mark.parametrize("disguise", [
    lambda w: "a " + " ".join(w), lambda w: " ".join(w) + ".", lambda w: w[:2] + " " + w[2:], lambda w: w[:3] + " " + w[3:], lambda w: w[0] + w[1] * 60 + w[2:],
    lambda w: "-".join(["re", "shin", "on", w, "the", "anti", "re", "shin", "on", "the", "anti", "ouan"]), lambda w: "(" + " ".join(w) + ")", str.upper,
])
def test_disguised_words_score_as_plain_ones(spark, planted, disguise):
    docs, labels, _ = planted
    if not hasattr(test_disguised_words_score_as_plain_ones, "trained"):
        test_disguised_words_score_as_plain_ones.trained = toxicity.train(docs, labels.where(~toxicity.held_out("doc_id", 5)))
    model, weights, linear = test_disguised_words_score_as_plain_ones.trained
    reader = toxicity.Reader(model, weights)
    for word in ("idiot", "moron", "clown"):
        plain, hidden = [reader.features(f"the shin {w} ouan thean resh") for w in (word, disguise(word))]
        assert hidden[1] >= plain[1] > 0, (word, disguise(word))
    assert reader.features("the shin ouan thean resh on re anti") == (0.0, 0)


def test_a_column_of_the_same_name_is_replaced(spark, planted):
    docs, labels, _ = planted
    model, weights, linear = toxicity.train(docs, labels)
    out = toxicity.toxicity(docs.limit(5).withColumn("Toxicity", docs.text), model, weights, linear)
    assert out.columns == ["doc_id", "text", "label", "toxicity"] and out.count() == 5
