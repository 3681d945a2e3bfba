"""Near duplicates by fast similarity sketching, banding and exact verification.

A sketch has BANDS * ROWS coordinates. In each round every token of a set is thrown into one
bin by a hash of its own for that round, and a bin that was empty keeps its smallest value; a set
of n tokens fills its bins after some rounds, most sets after a few. Were bins still empty after
as many rounds as there are bins, one more round for each bin takes the smallest of all tokens for
it, so every coordinate fills. Values of an earlier round are smaller, so two sets
agree in a coordinate with the probability of their Jaccard similarity, and the number of
agreements concentrates as that of independent draws.

Documents with equal sets are one node. Nodes that agree in a whole band lie in one bucket.

1. Each node is compared with the smallest node of each of its buckets, the leader. This is
   linear, however large a bucket; a leader with many followers meets them in parts.
2. Of the nodes around a leader only those in different components are still open. They are
   compared in full, in parts of bounded size; two parts of one component do not meet.

Every comparison is of full sets. Components are built over verified links alone.
A pair at the limit of 85 % shares none of the BANDS bands with a probability of 4e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.blocks import Block, mix64, over_blocks, store_blocks, stored, unpacked
from tillmark.llm.set_join import components, noted, shingles, word_hashes

#: Two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 85
BANDS, ROWS = 25, 5
#: Sets that one task compares with one another.
PART = 2048

U64 = np.uint64
_STEP = U64(0x9E3779B97F4A7C15)
_EMPTY = U64(2**64 - 1)
_LOW = U64(2**56 - 1)


def sketches(sets: list[np.ndarray], size: int = BANDS * ROWS) -> np.ndarray:
    """One row of ``size`` coordinates for each set of hashed tokens; none may be empty. Twice ``size`` is below 256."""
    found = np.full((len(sets), size), _EMPTY)
    if not sets:
        return found
    tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = found.ravel()
    for turn in range(2 * size):
        x = mix64(tokens + _STEP * U64(turn + 1))
        value = (U64(turn) << U64(56)) | (x & _LOW)
        to = ((x >> U64(32)) * U64(size) >> U64(32)).astype(np.int64) if turn < size else turn - size
        np.minimum.at(flat, owner * size + to, value)
        open_ = (found == _EMPTY).any(1)
        if not open_.any():
            break
        still = open_[owner]
        tokens, owner = tokens[still], owner[still]
    return found


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """One key per band of each sketch."""
    parts = sketch.reshape(len(sketch), sketch.shape[1] // ROWS, ROWS)
    keys = mix64(np.arange(1, parts.shape[1] + 1, dtype=U64) * _STEP)[None].repeat(len(sketch), 0)
    for i in range(ROWS):
        keys = mix64(keys * _STEP + parts[:, :, i])
    return keys


def least_overlap(n: int) -> int:
    """Tokens that a set of n must share with any partner."""
    return -(-PERCENT * n // 100)


def linked(common, n, m):
    return 100 * common >= PERCENT * (n + m - common)


def sketched(block: Block) -> Iterator[dict]:
    """A row per document of the block; ``bands`` holds its keys, null for an empty set."""
    sets = [shingles(word_hashes(text)) for text in block.texts()]
    full = [place for place, tokens in enumerate(sets) if len(tokens)]
    keys = dict(zip(full, band_keys(sketches([sets[place] for place in full]))))
    for place, tokens in enumerate(sets):
        yield {
            "doc_id": int(block.ids[place]) if block.known[place] else None, "row": int(block.rows[place]), "block": block.number, "place": place,
            "n": len(tokens), "node": xxhash.xxh3_64_intdigest(tokens.tobytes()) - 2**63 if len(tokens) else None,
            "bands": keys[place].tobytes() if len(tokens) else None,
        }


ITEMS = "doc_id long, row long, block long, place int, n int, node long, bands binary"


def bucketed(items: DataFrame) -> DataFrame:
    """(leader, node): nodes with the smallest node of each of their buckets, that one among them, where there are others."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
            yield pa.record_batch({"key": pa.array(keys), "node": pa.array(np.repeat(batch.column(0).to_numpy(), len(keys) // max(batch.num_rows, 1)))})

    pairs = stored(items.where("node IS NOT NULL").select("node", "bands").mapInArrow(each, "key long, node long").distinct(), "bands")
    buckets = pairs.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("size")).where("size > 1").select("key", "leader")
    # Both sides of the join are stored, so that Spark can split a bucket with many nodes.
    return stored(pairs.join(stored(buckets, "buckets"), "key").select("leader", "node").distinct(), "bucketed")


def tokens_of(blocks: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, tokens) of nodes (node, block, place), stored."""

    def send(block: Block, _: bytes, state: bytes) -> Iterator[dict]:
        if state:
            places, _, names = unpacked(state)
            for place, node in zip(places.tolist(), names.tolist()):
                text = block.data[block.starts[place] : block.starts[place + 1]]
                yield {"node": node, "tokens": shingles(word_hashes(text)).tobytes()}

    notes = noted(nodes.withColumn("line", F.lit(0)), ["node"])
    return stored(over_blocks(blocks, send, "node long, tokens binary", notes), "node-tokens")


LINK = "a long, b long"


def _links(found: list[tuple[int, int]]) -> pa.Table:
    a, b = zip(*found) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def star_links(bucketed_nodes: DataFrame, tokens: DataFrame) -> DataFrame:
    """Verified links (a, b) of nodes with their leaders."""
    sizes = stored(bucketed_nodes.groupBy("leader").agg(F.count("*").alias("size")), "leader-sizes")
    placed = bucketed_nodes.join(sizes, "leader").withColumn("parts", F.ceil(F.col("size") / PART).cast("int"))
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    own = F.array(F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    # A leader goes to all parts, another node to one.
    placed = placed.withColumn("part", F.explode(F.when(F.col("node") == F.col("leader"), every).otherwise(own)))
    rows = placed.join(tokens, "node").withColumn("task", F.xxhash64("leader", "part"))

    def run(group: pa.Table) -> pa.Table:
        by: dict[int, list[tuple[int, np.ndarray]]] = {}
        for leader, node, data in zip(*(group.column(c).to_pylist() for c in ("leader", "node", "tokens"))):
            by.setdefault(leader, []).append((node, np.frombuffer(data, U64)))
        found = []
        for leader, sets in by.items():
            head = next((s for node, s in sets if node == leader), None)
            others = [(node, s) for node, s in sets if node != leader]
            if head is None or not others:
                continue
            sizes_ = np.array([len(s) for _, s in others])
            some = np.concatenate([s for _, s in others])
            hits = head[np.minimum(np.searchsorted(head, some), len(head) - 1)] == some
            common = np.add.reduceat(hits, np.cumsum(sizes_) - sizes_, dtype=np.int64)
            for k in np.flatnonzero(linked(common, sizes_, len(head))).tolist():
                found.append((others[k][0], leader))
        return _links(found)

    total = bucketed_nodes.count()
    tasks = max(1, -(-total // PART))
    rows = rows.withColumn("task", F.when(F.col("parts") == 1, F.pmod("task", F.lit(tasks))).otherwise(F.col("task")))
    return stored(rows.select("task", "leader", "node", "tokens").groupBy("task").applyInArrow(run, LINK), "star-links")


def between(sets: list[tuple[int, int, int, np.ndarray]], across: bool) -> Iterator[tuple[int, int]]:
    """Links (a, b) that join components, among sets (node, component, side, tokens); ``across`` asks
    only for links between the two sides.

    A set meets those that have one of its rarest tokens, as many as a partner can't all lack.
    """
    root: dict[int, int] = {}

    def find(c: int) -> int:
        while root.get(c, c) != c:
            c = root[c]
        return c

    every, owners = np.concatenate([s[3] for s in sets]), np.repeat(np.arange(len(sets)), [len(s[3]) for s in sets])
    order = np.argsort(every, kind="stable")
    every, owners = every[order], owners[order]
    lengths, sides = np.array([len(s[3]) for s in sets]), np.array([s[2] for s in sets])
    named = np.array([s[1] for s in sets])
    for q, (node, component, side, tokens) in enumerate(sets):
        n = len(tokens)
        low, high = np.searchsorted(every, tokens, "left"), np.searchsorted(every, tokens, "right")
        rare = np.argsort(high - low, kind="stable")[: n - least_overlap(n) + 1]
        lists = [owners[i:j] for i, j in zip(low[rare].tolist(), high[rare].tolist()) if j - i > 1]
        if not lists:
            continue
        near = np.unique(np.concatenate(lists))
        near = near[(near < q) & (named[near] != component) & (np.minimum(n, lengths[near]) * 100 >= PERCENT * np.maximum(n, lengths[near]))]
        if across:
            near = near[sides[near] != side]
        for c in near.tolist():
            if find(component) == find(sets[c][1]):
                continue
            other = sets[c][3]
            common = int((other[np.minimum(np.searchsorted(other, tokens), len(other) - 1)] == tokens).sum())
            if linked(common, n, len(other)):
                root[find(component)] = find(sets[c][1])
                yield node, sets[c][0]


def open_links(bucketed_nodes: DataFrame, tokens: DataFrame, names: DataFrame) -> DataFrame:
    """Verified links (a, b) between components (names: node, component) of nodes around one leader."""
    followers = bucketed_nodes.where("node <> leader").join(names, "node", "left").withColumn("component", F.coalesce("component", "node"))
    followers = stored(followers, "followers")
    sizes = followers.groupBy("leader", "component").agg(F.count("*").alias("own"))
    groups = sizes.groupBy("leader").agg(F.count("*").alias("n"), F.sum("own").alias("size")).where("n > 1")
    sizes = stored(sizes.join(groups, "leader"), "open-sizes")
    # A component of more than a part makes parts of its own; smaller ones share parts.
    mixed = F.greatest(F.lit(1), F.ceil(F.sum(F.when(F.col("own") <= PART, F.col("own")).otherwise(0)) / PART)).cast("int")
    shared = sizes.groupBy("leader").agg(mixed.alias("mixed"))
    pure = F.ceil(F.col("own") / PART).cast("int")
    parts = sizes.join(shared, "leader").select("leader", "component", "own", "size", pure.alias("pure"), "mixed")
    parts = parts.withColumn("parts", F.when(F.col("own") > PART, F.transform(F.sequence(F.lit(0), F.col("pure") - 1), lambda k: F.xxhash64("component", k)))
                             .otherwise(F.array(F.pmod(F.xxhash64("component"), F.col("mixed")))))
    parts = stored(parts.select("leader", "component", "size", "parts", (F.col("own") > PART).alias("alone")), "open-parts")
    # All parts of a leader, and whether one holds a single component; a task per two parts that differ in components.
    listed = parts.select("leader", "size", F.when(F.col("alone"), F.col("component")).alias("of"), F.explode("parts").alias("part")).distinct()
    listed = listed.where(F.col("size") > PART)
    left, right = listed.select("leader", F.col("part").alias("i"), F.col("of").alias("of_i")), listed.select("leader", F.col("part").alias("j"), F.col("of").alias("of_j"))
    meets = left.join(right, "leader").where("i <= j AND NOT (of_i IS NOT NULL AND of_i <=> of_j)").select("leader", "i", "j")
    meets = stored(meets, "open-meets")
    own = followers.join(parts, ["leader", "component"])
    own = stored(own.select("leader", "node", "component", "size", F.element_at("parts", F.pmod(F.xxhash64("node"), F.size("parts")).cast("int") + 1).alias("part")), "open-nodes")
    total = own.where(F.col("size") <= PART).count()
    tasks = max(1, -(-total // PART))
    small = own.where(F.col("size") <= PART).select("leader", "node", "component", F.lit(-1).alias("side"), F.pmod(F.xxhash64("leader"), F.lit(tasks)).alias("task"))
    many = own.where(F.col("size") > PART)
    first = many.join(meets.withColumnRenamed("i", "part"), ["leader", "part"]).select(
        "leader", "node", "component", F.when(F.col("part") == F.col("j"), -1).otherwise(0).alias("side"), F.xxhash64("leader", "part", "j").alias("task"))
    second = many.join(meets.where("i <> j").withColumnRenamed("j", "part"), ["leader", "part"]).select(
        "leader", "node", "component", F.lit(1).alias("side"), F.xxhash64("leader", "i", "part").alias("task"))

    def run(group: pa.Table) -> pa.Table:
        by: dict[int, list[tuple[int, int, int, np.ndarray]]] = {}
        for leader, node, component, side, data in zip(*(group.column(c).to_pylist() for c in ("leader", "node", "component", "side", "tokens"))):
            by.setdefault(leader, []).append((node, component, side, np.frombuffer(data, U64)))
        found = []
        for sets in by.values():
            found.extend(between(sets, sets[0][2] >= 0))
        return _links(found)

    rows = small.unionByName(first).unionByName(second).join(tokens, "node")
    return stored(rows.groupBy("task").applyInArrow(run, LINK), "open-links")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each document of ``docs`` (doc_id, text).

    A null text and one without words have no shingle and no link. Repeated rows are rows of
    their own with one result. Null ids are never the smallest id of a component; a document
    whose component has no other id keeps its own, null, and stays. Other columns are not read.
    """
    blocks = store_blocks(docs.select("doc_id", "text"))
    items = stored(over_blocks(blocks, sketched, ITEMS), "sketches")
    around = bucketed(items)
    nodes = items.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("first"), F.min(F.struct("block", "place")).alias("at")).select("node", "first", "at.*")
    nodes = stored(nodes, "nodes")
    tokens = tokens_of(blocks, nodes.join(around.select("node").distinct(), "node").select("node", "block", "place"))
    star = star_links(around, tokens)
    rest = open_links(around, tokens, components(star))
    names = components(star.unionByName(rest))
    grouped = nodes.select("node", "first").join(names, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    named = stored(grouped.join(smallest, "component").select("node", "component_id"), "named")
    result = items.select("doc_id", "n", "node").join(named, "node", "left")
    component_id = F.coalesce("component_id", "doc_id")
    return result.select("doc_id", F.col("n").cast("long").alias("n_shingles"), component_id.alias("component_id"), F.col("doc_id").eqNullSafe(component_id).alias("kept"))


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
