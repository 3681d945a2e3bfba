"""The pipeline stage by stage against brute-force versions, and from end to end."""

import random
import zlib

import numpy as np
import pytest
import test_jaccard_join
import test_line_dedup
from tokenizers import Tokenizer

import corpus_pipeline
from tillmark.llm import mixing
from tillmark.llm.token_counts import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    words = [f"u{i}" for i in range(500)]
    line = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(3, 40)))
    shared = [line() for _ in range(6)]
    texts = []
    for i in range(160):
        if texts and rng.random() < 0.3:
            own = rng.choice(texts).split(" ")
            own[rng.randrange(len(own))] = rng.choice(words)
            texts.append(" ".join(own))
        else:
            texts.append("\n".join(rng.choice(shared) if rng.random() < 0.2 else line() for _ in range(rng.randrange(1, 6))))
    texts = [f"{t} idiot clown" if i % 4 == 0 else t for i, t in enumerate(texts)]
    rows = [(i, t, "en", f"s{i % 5}", len(t)) for i, t in enumerate(texts)] + [(500, None, None, None, None), (501, "", "en", "s1", 0)]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(i % 4 == 0)) for i in range(160)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), rows


def pairs(frame):
    return [(r.doc_id, r.text) for r in frame.collect()]


def test_stages_do_what_brute_force_does(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)

    def run(name, frame):
        out = stage[name](spark, frame, path)
        kept = spark.createDataFrame(out.collect(), out.schema)
        return kept

    clean = run("toxicity", docs)
    assert {i for i, _ in pairs(clean)} == {i for i, t, *_ in rows if not (t and "idiot" in t)}
    lined = run("line dedup", clean)
    assert lined.columns == docs.columns
    brute = {i: text for i, _, text in test_line_dedup.brute(pairs(clean))}
    before = dict(pairs(clean))
    expected = {i: (text if text != (before[i] or "") else before[i]) for i, text in brute.items() if text.strip() or text == (before[i] or "")}
    assert dict(pairs(lined)) == expected
    single = run("n-gram Jaccard join", lined)
    groups = test_jaccard_join.brute(pairs(lined))
    assert sorted(i for i, _ in pairs(single)) == sorted(i for i, _, component in groups if i == component)
    mixed = run("mixing", single)
    sizes, taken = {}, {}
    for name, counts in ((single, sizes), (mixed, taken)):
        for r in name.collect():
            counts[r.source] = counts.get(r.source, 0) + len((r.text or "").split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = mixing.waterfill([sizes[n] for n in names], [(5, 2, 1)[k % 3] for k in range(len(names))], 3)
    longest = max(len((t or "").split()) for _, t in pairs(single))
    assert all(abs(taken.get(n, 0) - t) <= longest for n, t in zip(names, targets))
    packed = run("packing", mixed)
    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = [(i, np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")) for i, t in pairs(mixed)]
    assert sorted((r.doc_id, r.length, r.ids_crc32) for r in packed.collect()) == sorted((i, len(x), zlib.crc32(x.tobytes())) for i, x in ids)


def test_run_gives_the_last_stage(spark, folder):
    path, _ = folder
    out = corpus_pipeline.run(spark, path)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 0


@pytest.mark.parametrize("labels", [[], [(9999, 1, 1)], [(i, 1, 1) for i in range(160)]])
def test_toxicity_stage_keeps_all_when_nothing_is_learned(spark, folder, tmp_path, labels):
    path, rows = folder
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = corpus_pipeline.drop_toxic(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted(i for i, _ in pairs(kept)) == sorted(i for i, *_ in rows)
