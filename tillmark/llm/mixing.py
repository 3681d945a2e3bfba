"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Documents of a source fall into blocks of about ``block_words`` words by a hash. A source
whose target is r times its size draws each block floor(r) times and the rest from the
front of a hash permutation of its blocks; the last block is drawn in part, document by
document. A binary tree then deals the exact number of blocks that each source draws out
to the output shards: every node splits its counts by one multivariate-hypergeometric
draw, as if all drawn blocks had been shuffled together. A leaf holds how many blocks of
each source its shard gets, and disjoint runs of the permutation fill it. Documents are
shuffled inside their shard only.

The driver handles one row per source and, for the tree, one number per source and shard.
Blocks and documents stay distributed: a source with a third of all rows has a third of
the blocks, and running sums over its blocks are taken in slices.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillmark.llm.blocks import fresh_name, stored
from tillmark.sources.scratch import scratch_path

WEIGHTS, MOST_REPEATS = (5, 2, 1), 3
BLOCK_WORDS, SHARDS, SEED = 50_000, 64, 20_240_229
SLICES = 64
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def waterfill(sizes: list[int], weights: list[float], most: float) -> list[float]:
    """Shares of the sum of sizes by weight, none above ``most`` times its size."""
    targets = [0.0] * len(sizes)
    open_, rest = [i for i, size in enumerate(sizes) if size], float(sum(sizes))
    while open_:
        scale = rest / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * scale > most * sizes[i]]
        if not full:
            for i in open_:
                targets[i] = weights[i] * scale
            break
        for i in full:
            targets[i] = float(most * sizes[i])
            rest -= targets[i]
        open_ = [i for i in open_ if i not in set(full)]
    return targets


def splitting_tree(draws: list[int], shards: int, seed: int) -> np.ndarray:
    """How many of each source's block draws each shard gets: an array of shards by sources."""
    rng = np.random.default_rng(seed)
    leaves = np.zeros((shards, len(draws)), dtype=np.int64)

    def split(counts: np.ndarray, low: int, high: int) -> None:
        if high - low == 1:
            leaves[low] = counts
            return
        middle = (low + high) // 2
        total = int(counts.sum())
        share = total * (middle - low) // (high - low)
        left = rng.multivariate_hypergeometric(counts, share, method="marginals") if total else counts * 0
        split(left, low, middle)
        split(counts - left, middle, high)

    split(np.asarray(draws, dtype=np.int64), 0, shards)
    return leaves


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` with ``mix_size`` and ``mix_key``, the hash that permutes its documents."""
    return docs.withColumns({"mix_size": n_words("text"), "mix_key": F.xxhash64("doc_id", "text", F.lit(seed))})


def own_keys(full: DataFrame) -> DataFrame:
    """Rows with a ``mix_key`` of their own, also those that repeat in id and text.

    Repeated rows are stored and numbered within their key: in a part as Spark wrote it, behind the rows
    of the parts before it. No task gets a key whole.
    """
    repeated = stored(full.groupBy("mix_key").agg(F.count("*").alias("n")).where("n > 1").select("mix_key"), "mixing-keys")
    if repeated.isEmpty():
        return full
    rows = stored(full.join(repeated, "mix_key", "left_semi").withColumn("mix_at", F.monotonically_increasing_id()), "mixing-repeats")
    rows = rows.withColumn("mix_part", F.shiftright("mix_at", 33))
    before = Window.partitionBy("mix_key").orderBy("mix_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("mix_key", "mix_part").agg(F.count("*").alias("n"))
    parts = stored(parts.select("mix_key", "mix_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("mix_before")), "mixing-parts")
    inside = F.row_number().over(Window.partitionBy("mix_key", "mix_part").orderBy("mix_at"))
    placed = rows.withColumn("mix_place", inside).join(parts, ["mix_key", "mix_part"])
    own = F.xxhash64("mix_key", F.col("mix_before") + F.col("mix_place"))
    return full.join(repeated, "mix_key", "left_anti").select(full.columns).unionByName(placed.withColumn("mix_key", own).select(full.columns))


def mixing_blocks(
    rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, block_words: int = BLOCK_WORDS,
    shards: int = SHARDS, seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """What the mix takes of rows (source, mix_size, mix_key).

    Returns the sources (source, n_blocks, source_size, target) and the blocks (source,
    block, shards: one per whole draw, last_shard, in_full, picked). A block with a
    ``last_shard`` is drawn once more: in full, or only its documents with the keys
    ``picked``. Sources rank by code point, null last; the weights repeat.
    """
    spark = rows.sparkSession
    found = rows.groupBy("source").agg(F.sum("mix_size").alias("size")).collect()
    found.sort(key=lambda r: (r.source is None, r.source or ""))
    sizes = [r["size"] or 0 for r in found]
    targets = waterfill(sizes, [weights[i % len(weights)] for i in range(len(found))], most)
    plan = []
    for row, size, target in zip(found, sizes, targets):
        whole = min(int(target // size), most) if size else 0
        plan.append((row.source, max(1, -(-size // block_words)), size, target, whole, round(target - whole * size)))
    sources = spark.createDataFrame(plan, "source string, n_blocks long, source_size long, target double, whole int, rest long")

    dealt = with_block(rows, sources, seed)
    blocks = dealt.groupBy("source", F.col("_block").alias("block")).agg(F.sum("mix_size").alias("words"))
    per = sources.select(F.col("source").alias("s"), "n_blocks", "whole", "rest")
    blocks = blocks.join(F.broadcast(per), blocks.source.eqNullSafe(per.s)).drop("s")
    blocks = blocks.withColumn("place", F.xxhash64("source", "block", F.lit(seed + 1)))
    blocks = blocks.withColumn("slice", F.floor(F.shiftrightunsigned("place", 32) / F.lit(2**32 / SLICES)).cast("int"))
    kept = scratch_path(spark, "mixing-blocks")
    blocks.write.parquet(kept)
    blocks = spark.read.parquet(kept)
    # Running words and ranks in permuted order: per slice first, then within the slice.
    slices = blocks.groupBy("source", "slice").agg(F.sum("words").alias("words"), F.count("*").alias("n"))
    upto = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(
        F.col("source").alias("s"), F.col("slice").alias("c"),
        F.coalesce(F.sum("words").over(upto), F.lit(0)).alias("words_before"), F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("n_before"),
    )
    within = Window.partitionBy("source", "slice").orderBy("place", "block").rowsBetween(Window.unboundedPreceding, -1)
    ranked = blocks.join(slices, blocks.source.eqNullSafe(slices.s) & (blocks.slice == slices.c)).select(
        "source", "block", "words", "n_blocks", "whole", "rest",
        (F.col("words_before") + F.coalesce(F.sum("words").over(within), F.lit(0))).alias("before"),
        (F.col("n_before") + F.count("*").over(within)).alias("rank"),
    )
    ranked = ranked.withColumn("need", F.greatest(F.lit(0), F.least("words", F.col("rest") - F.col("before"))))
    ranked_path = scratch_path(spark, "mixing-ranks")
    ranked.write.parquet(ranked_path)
    ranked = spark.read.parquet(ranked_path)

    # Blocks without documents do not exist, so draws count the blocks that do.
    counts = ranked.groupBy("source").agg(F.count("*").alias("n"), F.max("whole").alias("whole"), F.count(F.when(F.col("need") > 0, 1)).alias("more"))
    drawn = {r.source: (r.n, r.n * r.whole + r.more) for r in counts.collect()}
    names = [row[0] for row in plan if row[0] in drawn]
    leaves = splitting_tree([drawn[name][1] for name in names], shards, seed)
    ends = np.cumsum(leaves, axis=0)
    runs = [(name, [int(x) for x in ends[:, i]]) for i, name in enumerate(names)]
    runs = spark.createDataFrame(runs, "s string, ends array<long>")
    n_by = spark.createDataFrame([(name, drawn[name][0]) for name in names], "t string, n long")

    ranked = ranked.join(runs, ranked.source.eqNullSafe(runs.s)).join(n_by, ranked.source.eqNullSafe(n_by.t))

    def shard_of(draw: Column) -> Column:
        return F.size(F.filter("ends", lambda end: end <= draw))

    draws = F.transform(F.sequence(F.lit(0), F.col("whole") - 1), lambda epoch: shard_of(epoch * F.col("n") + F.col("rank")))
    blocks = ranked.select(
        "source", "block", "words", "need",
        F.when(F.col("whole") > 0, draws).otherwise(F.array().cast("array<int>")).alias("shards"),
        F.when(F.col("need") > 0, shard_of(F.col("whole") * F.col("n") + F.col("rank"))).alias("last_shard"),
    )
    # Of a block drawn in part, its documents are taken in key order as far as they fit; a block is bounded.
    part = blocks.where((F.col("need") > 0) & (F.col("need") < F.col("words"))).select(F.col("source").alias("s"), F.col("block").alias("b"), "need")
    inside = dealt.where("mix_size > 0").join(F.broadcast(part), dealt.source.eqNullSafe(part.s) & (dealt._block == part.b))
    inside = inside.select("s", "b", "need", "mix_key", "mix_size")
    picks = inside.groupBy("s", "b").applyInPandas(_fill, "s string, b long, picked array<long>")
    blocks = blocks.join(picks, blocks.source.eqNullSafe(picks.s) & (blocks.block == picks.b), "left").select(
        "source", "block", "shards", "last_shard", (F.col("need") >= F.col("words")).alias("in_full"), "picked"
    )
    return sources.select("source", "n_blocks", "source_size", "target"), blocks


def _fill(block: pd.DataFrame) -> pd.DataFrame:
    left, picked = int(block["need"].iloc[0]), []
    sizes = block.groupby("mix_key")["mix_size"].sum()
    for key, size in sorted(sizes.items()):
        if size <= left:
            left -= size
            picked.append(key)
    over = min(((size, key) for key, size in sizes.drop(picked).items()), default=None)
    if over and over[0] - left < left:
        picked.append(over[1])
    return pd.DataFrame({"s": [block["s"].iloc[0]], "b": [block["b"].iloc[0]], "picked": [picked]})


def with_block(rows: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """Rows with the block of their source they belong to; one row per source is joined."""
    by = sources.select(F.col("source").alias("s"), F.col("n_blocks").alias("of"))
    joined = rows.join(F.broadcast(by), rows.source.eqNullSafe(by.s))
    return joined.withColumn("_block", F.pmod(F.xxhash64("mix_key", F.lit(seed + 2)), by.of)).drop(by.s, by.of)


def with_copies(rows: DataFrame, sources: DataFrame, blocks: DataFrame, seed: int = SEED) -> DataFrame:
    """``rows`` (source, mix_size, mix_key and more) with ``mix_shards``, one shard per copy taken."""
    dealt = with_block(rows, sources, seed)
    by = blocks.select(*(F.col(c).alias(f"mix_{c}") for c in blocks.columns))
    joined = dealt.join(by, dealt.source.eqNullSafe(by.mix_source) & (dealt._block == by.mix_block), "left")
    chosen = F.col("mix_in_full") | F.coalesce(F.array_contains("mix_picked", F.col("mix_key")), F.lit(False))
    once_more = F.col("mix_last_shard").isNotNull() & chosen
    copies = F.when(once_more, F.concat("mix_shards", F.array("mix_last_shard"))).otherwise(F.col("mix_shards"))
    return joined.withColumn("mix_shards", copies).drop(*(c for c in by.columns if c != "mix_shards"), "_block")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: a row per copy taken, with its shard and its place in the shard.

    ``docs`` needs doc_id, text and source; all its columns come out, then ``mix_shard``
    and ``mix_place``, lengthened where ``docs`` has such columns. Each source's words come within
    a document of its target, and no document is taken more than ``most`` times. Null texts and
    texts without words have size 0 and go along with their block. Rows that repeat are documents
    of their own. A null source is a source of its own; an empty table gives none.
    """
    seed = options.get("seed", SEED)
    # Columns of docs lie in one of their own meanwhile, out of the way of the names in use here.
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("mix_row"), "doc_id", "text", "source")
    full = own_keys(sized(packed, seed).drop("doc_id", "text"))
    kept = scratch_path(docs.sparkSession, "mixing-sizes")
    full.select("source", "mix_size", "mix_key").write.parquet(kept)
    sources, blocks = mixing_blocks(docs.sparkSession.read.parquet(kept), **options)
    copies = with_copies(full, sources, blocks, seed)
    rows = copies.select("mix_row", "mix_key", F.posexplode("mix_shards").alias("mix_copy", "mix_shard"))
    place = F.xxhash64("mix_key", "mix_copy", F.lit(seed + 3))
    return rows.select(
        *[F.col(f"mix_row.`{c}`").alias(c) for c in docs.columns], F.col("mix_shard").alias(fresh_name(docs.columns, "mix_shard")), place.alias(fresh_name(docs.columns, "mix_place")))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    kept = scratch_path(spark, "mixing-sizes")
    own_keys(sized(docs).drop("text")).write.parquet(kept)
    rows = spark.read.parquet(kept)
    sources, blocks = mixing_blocks(rows)
    taken = with_copies(rows, sources, blocks)
    per_source = sources.select(F.col("source").alias("of"), "source_size", "target")
    return taken.join(F.broadcast(per_source), F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", F.col("mix_size").alias("size"), "source_size", "target",
        (F.col("mix_size") * F.size(F.coalesce("mix_shards", F.array().cast("array<int>")))).alias("taken"),
        F.coalesce("mix_shards", F.array().cast("array<int>")).alias("shards"),
    )
