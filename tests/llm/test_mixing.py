"""Source mixing: targets, words taken, shards and repeatability."""

import numpy as np
from pyspark.sql import functions as F

from tillmark.llm import mixing


def test_waterfill_stops_at_three_times_the_size():
    assert mixing.waterfill([10, 1000, 1000], [5, 2, 1], 3) == [30.0, 1980 * 2 / 3, 660.0]
    assert mixing.waterfill([0, 0], [5, 2], 3) == [0.0, 0.0]
    assert mixing.waterfill([], [], 3) == []


def test_tree_deals_out_every_draw():
    leaves = mixing.splitting_tree([1000, 10, 0, 333], 7, 1)
    assert leaves.sum(0).tolist() == [1000, 10, 0, 333]
    assert np.ptp(leaves.sum(1)) <= 7


def documents(spark):
    rows = [(i, "w " * (i % 37), ["b", "a", "c", None, "tiny", "a"][i % 6] if i % 60 != 4 else "tiny") for i in range(3000)]
    rows = [(i, t, s if s != "tiny" or i < 200 else "a") for i, t, s in rows]
    rows += [(None, None, "a"), (9000, None, None), (9001, "", ""), (9002, "x" * 10, "")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("block", F.lit("keeps"))


def test_words_taken_come_near_the_targets(spark):
    docs = documents(spark)
    out = mixing.mix(docs, block_words=500, shards=8)
    assert out.columns == [*docs.columns, "mix_shard", "mix_place"]
    rows = out.collect()
    sizes, taken = {}, {}
    for r in docs.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len((r.text or "").split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = dict(zip(names, mixing.waterfill([sizes[n] for n in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 3)))
    copies = {}
    for r in rows:
        taken[r.source] = taken.get(r.source, 0) + len((r.text or "").split())
        copies[(r.doc_id, r.source)] = copies.get((r.doc_id, r.source), 0) + 1
    for name in names:
        assert abs(taken.get(name, 0) - targets[name]) <= 37
    assert max(copies.values()) <= 3
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs.repartition(5), block_words=500, shards=8).collect()))


def test_empty_table(spark):
    assert mixing.mix(spark.createDataFrame([], "doc_id long, text string, source string")).collect() == []


def test_repeated_rows_are_documents_of_their_own(spark):
    """Equal rows of one source, and of another, meet the targets as different ones would."""
    rows = [(1, "w " * 50, "a")] * 400 + [(2, "v " * 50, "b")] * 400 + [(i, "u " * 50, "c") for i in range(10, 410)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    taken = {r.source: r.n for r in mixing.mix(docs, block_words=500, shards=8).groupBy("source").agg(F.sum(F.size(F.split("text", " ")) - 1).alias("n")).collect()}
    targets = dict(zip("abc", mixing.waterfill([20_000] * 3, [5, 2, 1], 3)))
    assert all(abs(taken[s] - targets[s]) <= 50 for s in "abc")


def test_columns_of_any_name_stay_as_they_are(spark):
    names = ["mix_size", "mix_key", "_block", "mix_shard", "mix_place", "mix_row", "mix_copy", "mix_at", "N"]
    docs = documents(spark).drop("block").select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in names])
    out = mixing.mix(docs, block_words=500, shards=8)
    assert out.columns == [*docs.columns, "mix_shard_", "mix_place_"]
    assert out.where("doc_id IS NOT NULL AND NOT (" + " AND ".join(f"{n} = concat('{n}', doc_id)" for n in names) + ")").isEmpty()
