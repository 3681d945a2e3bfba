"""Similarity joins of sets of hashed tokens that lie in blocks of texts.

1. Each item (a document, or a line) sends the front of its sorted hashes to a census. Of
   an item with n tokens and a partner, at least ``slack`` tokens among the first
   ``n - T + slack`` are also among those its partner sends (T is the least overlap). Items
   with fewer repeated tokens have no partner; only the others go on.
2. Equal sets become one node.
3. A second census counts the tokens of the nodes. A node's ``n - T + 1`` rarest are its front:
   two nodes with the needed overlap share a token of it.
4. A third census gives each token of a front the smallest node that has it there, its leader. Two
   nodes that may be partners share a leader, so the nodes around each leader are compared.
5. Leaders are dealt out to tasks: those of few nodes many to a task, one of many nodes in parts
   of bounded size, every two parts in a task of their own.

A token that many items share arrives once from each block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.blocks import MESSAGE, NOTE, Block, answered, messages, mix64, n_buckets, note, over_blocks, packed, release, stored, unpacked

#: Two sets link when 100 * intersection >= PERCENT * union.
PERCENT, WORDS = 80, 5
#: Sets of one part around a leader of many, and of one task of several leaders.
PART = 4096

U64 = np.uint64
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_STEPS = [U64(pow(0x9E3779B97F4A7C15, i + 1, 2**64)) for i in range(WORDS)]


def word_hashes(text: bytes) -> np.ndarray:
    """A hash of each word, A to Z in lower case; words lie between ASCII white space."""
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(word) for word in text.translate(LOWER).split()], dtype=U64)


def shingles(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of WORDS words in a row; of fewer words, one of all."""
    n = len(words) - WORDS + 1
    if n > 0:
        found = words[:n] * _STEPS[0]
        for i in range(1, WORDS):
            found = mix64(found) + words[i : n + i] * _STEPS[i]
        return np.unique(mix64(found))
    if not len(words):
        return np.zeros(0, U64)
    return np.array([xxhash.xxh3_64_intdigest(words.tobytes(), seed=len(words))], dtype=U64)


#: Lower case for A to Z, one blank for all ASCII white space.
_PLAIN = bytes(32 if 9 <= b <= 13 else LOWER[b] for b in range(256))


#: Masks of the first 0 to 8 bytes of a number.
_LAST = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)


def hash_all(data: bytes, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of each of many words, eight bytes of all of them at a time; behind the last word lie eight more bytes."""
    found = mix64(np.arange(int(sizes.max(initial=0)) + 1).astype(U64) + _STEPS[0])[sizes]
    # The eight bytes from each byte on, as one number; of a word's last ones those behind it are cleared.
    eight = np.ndarray(len(data) - 7, "<u8", data, 0, (1,))
    left, rest = np.arange(len(sizes)), sizes
    for done in range(0, min(int(sizes.max(initial=0)), 64), 8):
        if done:
            left = left[rest > 8]
            rest = sizes[left] - done
        chunk = eight[at[left] + done] & _LAST[np.minimum(rest, 8)]
        found[left] = mix64(found[left] * _STEPS[1] + chunk)
    for long in np.flatnonzero(sizes > 64).tolist():
        found[long] = xxhash.xxh3_64_intdigest(data[at[long] : at[long] + sizes[long]])
    return found


def token_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct tokens of many texts one after another, and where each text's begin.

    A token is a hash of WORDS words in a row; a text of fewer words has one token of all. Words of all
    texts are found and hashed together.
    """
    data = b" ".join([b"", *texts, b"        "]).translate(_PLAIN)
    blank = np.frombuffer(data, np.uint8) == 32
    # Places where a word begins and where one ends, in turn; the text begins and ends with blanks.
    turns = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    first, sizes = turns[::2], turns[1::2] - turns[::2]
    words = hash_all(data, first, sizes)
    bounds = np.cumsum([1, *[len(text) + 1 for text in texts]])
    counts = np.diff(np.searchsorted(first, bounds))
    owner = np.repeat(np.arange(len(texts)), counts)
    n = max(0, len(words) - WORDS + 1)
    found = words[:n] * _STEPS[0]
    for i in range(1, WORDS):
        found = mix64(found) + words[i : n + i] * _STEPS[i]
    few = (counts > 0) & (counts < WORDS)
    own, begin = counts[few], (np.cumsum(counts) - counts)[few]
    whole = mix64(own.astype(U64))
    for i in range(WORDS - 1):
        more = own > i
        whole[more] = mix64(whole[more] * _STEPS[0] + words[begin[more] + i])
    # Each text's tokens in a stretch of their own, sorted there.
    sizes = np.where(few, 1, np.maximum(counts - WORDS + 1, 0))
    ends = np.cumsum(sizes)
    tokens, alone = np.empty(int(sizes.sum()), U64), np.repeat(few, sizes)
    tokens[~alone] = mix64(found[owner[:n] == owner[WORDS - 1 :][:n]])
    tokens[alone] = whole
    for low, high in zip((ends - sizes)[sizes > 1].tolist(), ends[sizes > 1].tolist()):
        tokens[low:high].sort()
    fresh = np.append(True, tokens[1:] != tokens[:-1])[: len(tokens)]
    fresh[(ends - sizes)[sizes > 0]] = True
    return tokens[fresh], np.append(0, np.cumsum(fresh))[np.append(0, ends)]


def least_overlap(n):
    """Tokens that a set of n must share with any partner; n may be an array."""
    return -(-PERCENT * n // 100)


def linked(common: int, n: int, m: int) -> bool:
    return 100 * common >= PERCENT * (n + m - common)


def slack(sizes: np.ndarray) -> np.ndarray:
    return np.maximum(1, (sizes - least_overlap(sizes)) // 2)


def several(keys: np.ndarray, sender: np.ndarray, values: list[np.ndarray]) -> np.ndarray:
    """Whether two items have the token."""
    order = np.argsort(keys, kind="stable")
    at = np.flatnonzero(np.append(True, np.diff(keys[order]) != 0))
    n = np.add.reduceat(values[0][order], at)
    out = np.empty(len(keys), np.uint8)
    out[order] = np.repeat(n > 1, np.diff(np.append(at, len(keys))))
    return out


def least(keys: np.ndarray, sender: np.ndarray, values: list[np.ndarray]) -> np.ndarray:
    """The smallest value of each token."""
    order = np.argsort(keys, kind="stable")
    at = np.flatnonzero(np.append(True, np.diff(keys[order]) != 0))
    out = np.empty(len(keys), np.int64)
    out[order] = np.repeat(np.minimum.reduceat(values[0][order], at), np.diff(np.append(at, len(keys))))
    return out


#: The items of a block, of all or of those with a (place, line) in a container: places, lines, the sorted distinct tokens
#: of one after another, and where each one's begin.
Items = Callable[..., tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def fronts(tokens: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the items send: the front of each one's sorted tokens, hashed once more, and the item of each.

    The front of a sorted set lies near zero; hashed again its tokens fill all buckets alike.
    """
    sizes = np.diff(starts)
    sent = sizes - least_overlap(sizes) + slack(sizes)
    owner = np.repeat(np.arange(len(sizes)), np.where(sizes > 0, sent, 0))
    within = np.arange(len(owner)) - np.searchsorted(owner, owner)
    return mix64(tokens[starts[owner] + within]), owner


def items_with_partners(blocks: DataFrame, items: Items, alone: bool = True) -> DataFrame:
    """One row per item: doc_id, row, block, place, line, n, and node if it may have a partner.

    Equal sets have equal nodes. Without ``alone`` only items that may have a partner come out.
    """
    buckets = n_buckets(blocks)

    def ask(block: Block) -> Iterator[dict]:
        _, _, tokens, starts = items(block)
        keys, counts = np.unique(fronts(tokens, starts)[0], return_counts=True)
        yield from messages(block, buckets, keys, [np.minimum(counts, 2).astype(np.uint8)])

    replies = answered(over_blocks(blocks, ask, MESSAGE), several)

    def choose(block: Block, got: bytes, _: bytes) -> Iterator[pa.Table]:
        place, line, tokens, starts = items(block)
        front, owner = fronts(tokens, starts)
        # Answers come in the order of the distinct keys.
        repeated = np.zeros(0, np.bool_) if not len(front) else (np.frombuffer(got, np.uint8) > 0)[np.unique(front, return_inverse=True)[1]]
        sizes = np.diff(starts)
        some = (sizes > 0) & (np.bincount(owner[repeated], minlength=len(sizes)) >= slack(sizes))
        node = np.zeros(len(sizes), np.int64)
        for i in np.flatnonzero(some).tolist():
            node[i] = xxhash.xxh3_64_intdigest(tokens[starts[i] : starts[i + 1]].tobytes()) - 2**63
        out = np.arange(len(sizes)) if alone else np.flatnonzero(some)
        at = place[out]
        yield pa.table({
            "doc_id": pa.array(block.ids[at], pa.int64(), mask=~block.known[at]), "row": block.rows[at], "block": np.full(len(out), block.number, np.int64),
            "place": at.astype(np.int32), "line": line[out].astype(np.int32), "n": sizes[out].astype(np.int32), "node": pa.array(node[out], mask=~some[out]),
        })

    found = stored(over_blocks(blocks, choose, "doc_id long, row long, block long, place int, line int, n int, node long", replies), "items")
    release(replies)
    return found


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b): the smallest node it is connected with.

    Each round every node and its neighbours point to the smallest of them, in turn over
    larger and smaller neighbours, until nothing changes. Only minima by node are shuffled.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = edges.union(edges.select("b", "a"))
        # Stored sides let Spark split the edges of a hub over tasks.
        small = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "small")
        large = edges.select(F.col("a").alias("v"), F.col("b").alias("a")).join(small, "a").select("v", "m").distinct()
        large = stored(large.where("v <> m"), "large")
        low = stored(large.groupBy("v").agg(F.min("m").alias("least")), "low")
        joined = large.join(low, "v")
        after = joined.where("m <> least").select(F.col("m").alias("a"), F.col("least").alias("b"))
        after = stored(after.union(low.select(F.col("v").alias("a"), F.col("least").alias("b"))).distinct(), "edges")
        # Done when every edge leads to a node that no edge leaves: a forest of stars.
        inner = after.select(F.col("b").alias("a")).distinct().join(after.select("a").distinct(), "a", "left_semi")
        doubled = after.groupBy("a").count().where("count > 1")
        edges = after
        if inner.isEmpty() and doubled.isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())


def noted(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of a block as its note to itself: the columns, long, in the order of place and line."""
    schema = "block long, bucket long, answers binary"

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by([("place", "ascending"), ("line", "ascending")])
        data = packed([group.column(c).to_numpy().astype(np.int64) for c in ["place", "line", *columns]])
        return pa.table({"block": group.column("block")[:1], "bucket": pa.array([NOTE], pa.int64()), "answers": pa.array([data], pa.binary())})

    return rows.select("block", "place", "line", *columns).groupBy("block").applyInArrow(pack, schema)


def counted(keys: np.ndarray, sender: np.ndarray, values: list[np.ndarray]) -> np.ndarray:
    """The sum of the values of each token."""
    order = np.argsort(keys, kind="stable")
    at = np.flatnonzero(np.append(True, np.diff(keys[order]) != 0))
    out = np.empty(len(keys), np.uint32)
    out[order] = np.repeat(np.minimum(np.add.reduceat(values[0][order].astype(np.int64), at), 2**32 - 1), np.diff(np.append(at, len(keys)))).astype(np.uint32)
    return out


def around_leaders(blocks: DataFrame, items: Items, notes: DataFrame) -> DataFrame:
    """(leader, node): of each rare token of a node the smallest node that has it among its own rare ones.

    A node's rare tokens are the first ``n - T + 1`` by the number of nodes that have them, so two
    nodes with the needed overlap share one, and with it its leader.
    """
    buckets = n_buckets(blocks)

    def ask(block: Block, _: bytes, state: bytes) -> Iterator[dict]:
        keys, n = np.unique(mix64(chosen(block, items, state)[0]), return_counts=True)
        yield from messages(block, buckets, keys, [n.astype(np.uint32)])

    counts = answered(over_blocks(blocks, ask, MESSAGE, notes), counted)

    def rare(block: Block, got: bytes, state: bytes) -> Iterator[dict]:
        """A message per token that two nodes have, with the nodes, packed; and what the block needs to read the answers."""
        tokens, starts, columns = chosen(block, items, state)
        own, sizes = mix64(tokens), np.diff(starts)
        often = np.frombuffer(got, np.uint32)[np.unique(own, return_inverse=True)[1]]
        of = np.repeat(np.arange(len(sizes)), sizes)
        # Each set's tokens stay in their stretch, rare ones first.
        order = np.lexsort((own, often, of))
        front = np.arange(len(own)) - starts[of] < (sizes - least_overlap(sizes) + 1)[of]
        order = order[front & (often[order] > 1)]
        token, owner = own[order], (columns[0] if columns else of)[of[order]]
        order = np.lexsort((owner, token))
        token, owner = token[order], owner[order]
        first = np.flatnonzero(np.append(True, np.diff(token) != 0)) if len(token) else order
        yield note(block, packed([token.view(np.int64), owner]))
        yield from messages(block, buckets, token[first], [owner[first]])

    asked = stored(over_blocks(blocks, rare, MESSAGE, counts.unionByName(notes)), "rare-tokens")
    own_notes = asked.where(F.col("bucket") == NOTE).select("block", "bucket", F.col("sent").alias("answers"))
    leaders = answered(asked.where(F.col("bucket") != NOTE), least)

    def lead(block: Block, got: bytes, state: bytes) -> Iterator[pa.Table]:
        if state:
            token, owner = unpacked(state)
            if len(token):
                found = np.frombuffer(got, np.int64)[np.cumsum(np.append(0, np.diff(token) != 0))]
                order = np.lexsort((owner, found))
                found, owner = found[order], owner[order]
                fresh = np.append(True, (np.diff(found) != 0) | (np.diff(owner) != 0))
                yield pa.table({"leader": found[fresh], "node": owner[fresh]})

    pairs = stored(over_blocks(blocks, lead, "leader long, node long", leaders.unionByName(own_notes)).distinct(), "around")
    release(counts, asked, leaders)
    return pairs


def chosen(block: Block, items: Items, state: bytes) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The tokens of the block's noted items one after another, where each one's begin, and what the note says of them."""
    if not state:
        return np.zeros(0, U64), np.zeros(1, np.int64), []
    place, line, *rest = unpacked(state)
    _, _, tokens, starts = items(block, set(zip(place.tolist(), line.tolist())))
    return tokens, starts, rest


Compare = Callable[[int, list[tuple], list[tuple] | None], Iterator[tuple]]


def compared(blocks: DataFrame, items: Items, nodes: DataFrame, compare: Compare, schema: str) -> DataFrame:
    """What ``compare`` finds among nodes (node, first; block, place and line of one of its items) that may be partners.

    Nodes meet around a leader: it gets the leader and the sets (node, first, n, tokens, leaders) around it, or
    those of two parts of them. Two nodes may meet around several leaders; ``leaders``, in
    order, tells which comes first. Nothing is made of chains of nodes.
    """
    notes = stored(noted(nodes, ["node"]), "nodes-by-block")
    around = around_leaders(blocks, items, notes)
    sizes = around.groupBy("leader").agg(F.count("*").alias("size")).where("size > 1")
    sizes = stored(sizes.withColumn("parts", F.ceil(F.col("size") / PART).cast("int")), "leader-sizes")
    around = stored(around.join(sizes, "leader"), "meeting")
    # As many leaders as a node has rare tokens at most.
    leaders = around.groupBy("node").agg(F.sort_array(F.collect_list("leader")).alias("leaders"))

    def send(block: Block, _: bytes, state: bytes) -> Iterator[pa.Table]:
        tokens, starts, columns = chosen(block, items, state)
        if columns:
            sets = [tokens[low:high].tobytes() for low, high in zip(starts[:-1].tolist(), starts[1:].tolist())]
            yield pa.table({"node": columns[0], "first": columns[1], "tokens": pa.array(sets, pa.binary())})

    needed = noted(nodes.join(leaders.select("node"), "node"), ["node", "first"])
    sets = over_blocks(blocks, send, "node long, first long, tokens binary", needed)
    sets = stored(sets.join(leaders, "node"), "sets")
    # Leaders of one part share tasks; two parts of a larger one meet in a task of their own.
    total = sizes.where("parts = 1").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first().n
    tasks = max(1, -(-total // PART))
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    placed = around.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    task = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("leader"), F.lit(tasks))).otherwise(F.xxhash64("leader", low, high))
    alone = F.col("parts") == 1
    rows = placed.select("node", "leader", "own", task.alias("task"), F.when(alone, -1).otherwise(low).alias("i"), F.when(alone, -1).otherwise(high).alias("j"))
    rows = rows.join(sets, "node")

    names = [field.split()[0] for field in schema.split(",")]
    kinds = pa.schema([(name, pa.int64()) for name in names])

    def run(group: pa.Table) -> pa.Table:
        by: dict[tuple[int, int, int], dict[int, list[tuple]]] = {}
        for row in group.to_pylist():
            tokens = np.frombuffer(row["tokens"], U64)
            own_sets = by.setdefault((row["leader"], row["i"], row["j"]), {}).setdefault(row["own"], [])
            own_sets.append((row["node"], row["first"], len(tokens), tokens, row["leaders"]))
        found: list[tuple] = []
        for (leader, i, j), parts in by.items():
            if i < 0 or i == j:
                found.extend(compare(leader, [s for own_sets in parts.values() for s in own_sets], None))
            else:
                found.extend(compare(leader, parts.get(i, []), parts.get(j, [])))
        columns = list(zip(*found)) if found else [[] for _ in names]
        return pa.table([pa.array(list(column), pa.int64()) for column in columns], schema=kinds)

    found = stored(rows.groupBy("task").applyInArrow(run, schema), "compared")
    release(notes, sizes, around, sets)
    return found


class Index:
    """Inverted lists of the tokens of some sets."""

    def __init__(self, sets: list[tuple]):
        self.tokens = np.concatenate([s[3] for s in sets]) if sets else np.zeros(0, U64)
        self.owners = np.repeat(np.arange(len(sets)), [len(s[3]) for s in sets])
        order = np.argsort(self.tokens, kind="stable")
        self.tokens, self.owners = self.tokens[order], self.owners[order]

    def lists(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.searchsorted(self.tokens, tokens, "left"), np.searchsorted(self.tokens, tokens, "right")
