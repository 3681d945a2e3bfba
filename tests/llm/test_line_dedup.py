"""Line dedup against all pairs of lines on a small table."""

import random
import re

from test_jaccard_join import shingle_set

from tillmark.llm import line_dedup, set_join


def brute(rows):
    listed = []
    for at, (doc_id, text) in enumerate(rows):
        for number, line in enumerate((text or "").split("\n")):
            if line.split():
                listed.append(((doc_id is None, doc_id or 0, at, number), at, number, shingle_set(line)))
    gone = {(a[1], a[2]) for a in listed for b in listed if b[0] < a[0] and 100 * len(a[3] & b[3]) >= 80 * len(a[3] | b[3])}
    out = []
    for at, (doc_id, text) in enumerate(rows):
        kept = [line for number, line in enumerate((text or "").split("\n")) if (at, number) not in gone]
        out.append((doc_id, len((text or "").split("\n")), "\n".join(kept)))
    return sorted(out, key=str)


def test_matches_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(set_join, "PART", 24)
    store = line_dedup.store_blocks
    monkeypatch.setattr(line_dedup, "store_blocks", lambda d: store(d, 4000))
    rng = random.Random(4)
    words = [f"v{i}" for i in range(300)]
    base = [[rng.choice(words) for _ in range(rng.randrange(1, 70))] for _ in range(40)]

    def line():
        own = list(rng.choice(base)) if rng.random() < 0.6 else [rng.choice(words) for _ in range(rng.randrange(0, 30))]
        if own and rng.random() < 0.5:
            own[rng.randrange(len(own))] = rng.choice(words)
        return " ".join(own)

    rows = [(i * 7 % 80, "\n".join(line() for _ in range(rng.randrange(1, 9)))) for i in range(80)]
    rows += [(None, rows[0][1]), (100, None), (101, ""), (102, "\n\n"), (103, "a b c d e\n" * 50), (104, "A b c d E"), (105, rows[3][1] * 30)]
    docs = spark.createDataFrame([(i, t, 3) for i, t in rows], "doc_id long, text string, line int").repartition(3)
    found = line_dedup.without_repeated_lines(docs).select("doc_id", "n_lines", "text").collect()
    assert sorted([tuple(r) for r in found], key=str) == brute(rows)


def test_only_lines_with_possible_partners_are_stored(spark):
    rows = [(1, "one line of some seven words here\nalone"), (None, None), (2, "ONE line of some seven words here\n\nnobody else has this line"), (2, "")]
    blocks = line_dedup.store_blocks(spark.createDataFrame(rows, "doc_id long, text string").repartition(2))
    every = [tuple(r) for r in set_join.items_with_partners(blocks, line_dedup.lines).collect()]
    some = [tuple(r) for r in set_join.items_with_partners(blocks, line_dedup.lines, alone=False).collect()]
    assert len(every) == 4 and sorted(some) == sorted(r for r in every if r[-1] is not None)
    assert sorted((r[0], r[4], r[5]) for r in some) == [(1, 0, 3), (2, 0, 3)]


def test_empty_table(spark):
    assert line_dedup.without_repeated_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_short_lines_go_with_equal_ones(spark):
    rows = [(1, "All rights reserved.\nalone\n\n"), (2, "ALL  rights reserved.\nreserved rights all\n\nx"), (3, "x\nall rights\nX\nall rights reserved. now and then")]
    found = line_dedup.without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: list(r.removed) for r in found} == {1: [], 2: [0], 3: [0, 2]}


def test_texts_stay_in_their_blocks(spark):
    rows = [(2, "x\nthe same line"), (None, "the same line\n"), (1, "THE same line\n\ny")]
    found = line_dedup.without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    # The numbers of removed lines are brought to the blocks, not texts to them by a join.
    assert not re.search(r"Join \[block", found._jdf.queryExecution().executedPlan().toString())
    assert {r.doc_id: (list(r.removed), r.n_lines, r.text) for r in found.collect()} == {
        1: ([], 3, "THE same line\n\ny"), 2: ([1], 2, "x"), None: ([0], 2, "")}
