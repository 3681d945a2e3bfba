"""Exact substring dedup with a suffix array built block by block over a difference cover.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with
a smaller id. Strings (windows) that could match are found first, without loss:

1. Texts are cut where a rolling hash says so. Equal cuts, with the bytes that their
   windows reach into, have equal windows, so all but those of the smallest id are settled
   by a census of 128-bit hashes.
2. Of each window that is left, the smallest gram hash is looked up. A window whose gram
   no other document has cannot match.

What remains are windows that share a gram, mostly at the ends of repeated passages. They
meet by that gram in one bucket. A task sorts its bucket as a suffix array of depth
``LENGTH``: it ranks the suffixes at difference-cover positions first, then sorts the
others one sub-bucket of equal first bytes at a time. Suffixes that tie there compare by the ranks of the
cover positions they both reach within ``PERIOD`` bytes. Memory depends on the sub-bucket, never on a tie.

Each distinct cut, gram and window travels once from a block, however many copies it has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.blocks import (
    MESSAGE, NOTE, REPLY, Block, answered, bucket_of, messages, mix64, n_buckets, note, over_blocks, packed, store_blocks, stored, unpacked,
)

LENGTH = 50
#: Bytes of a gram; each window holds LENGTH - GRAM + 1 of them.
GRAM = 24
#: A cut on average every so many bytes.
CUT = 128
#: A difference cover: every two residues have a common shift into it.
PERIOD, COVER = 7, (0, 1, 3)
#: Suffixes sorted at once, unless more share their first eight bytes.
SUB_BUCKET = 1 << 17

SLICE = 1 << 16
U64 = np.uint64
NONE = np.int64(2**63 - 1)
_BYTES = mix64(np.arange(1, 257, dtype=U64))
_SHIFT = {k: U64(pow(0x9E3779B97F4A7C15, k, 2**64)) for k in (1, 2, 4, 8)}


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each position."""
    h, size, kept = _BYTES[data], 1, {}
    while size < 16:
        h = h[:-size] * _SHIFT[size] + h[size:]
        size *= 2
        kept[size] = h
    n = len(data) - GRAM + 1
    return mix64(kept[16][:n] * _SHIFT[8] + kept[8][16 : 16 + n])


def smallest_grams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The gram hash at each position, and a hash of the smallest inside each window.

    Smallest values crowd near zero; hashed once more they fill all buckets alike.
    """
    n = len(data) - LENGTH + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, U64)
    grams, smallest = np.empty(n, U64), np.empty(n, U64)
    width = LENGTH - GRAM + 1
    for low in range(0, n, SLICE):
        high = min(n, low + SLICE)
        h = gram_hashes(data[low : high + LENGTH - 1])
        m, size = h, 1
        while size * 2 <= width:
            m = np.minimum(m[:-size], m[size:])
            size *= 2
        rest = width - size
        m = np.minimum(m[: len(m) - rest], m[rest:]) if rest else m
        grams[low:high], smallest[low:high] = h[: high - low], mix64(m[: high - low])
    return grams, smallest


class Windows:
    """The windows of a block: positions where LENGTH bytes of one document start."""

    def __init__(self, block: Block):
        self.block = block
        self.data = np.frombuffer(block.data, np.uint8)
        self.grams, self.smallest = smallest_grams(self.data)
        self.valid = np.zeros(len(self.smallest), bool)
        for low, high in zip(block.starts[:-1].tolist(), block.starts[1:].tolist()):
            if high - low >= LENGTH:
                self.valid[low : high - LENGTH + 1] = True
        self.ids = np.where(block.known, block.ids, NONE)

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.block.starts, at, side="right") - 1

    def cuts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First window, end of the windows, and end of the bytes of each cut."""
        starts = self.block.starts
        long = np.diff(starts) >= LENGTH
        heads = starts[:-1][long]
        inner = np.flatnonzero((self.grams & U64(CUT - 1) == 0) & self.valid)
        low = np.union1d(heads, inner)
        doc_end = starts[1:][self.doc_of(low)]
        high = np.minimum(np.append(low[1:], NONE), doc_end - LENGTH + 1)
        return low, high, np.minimum(high + LENGTH - 1, doc_end)


def cut_keys(w: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct 128-bit hashes of the cuts as two words, their smallest ids, and the place of each cut."""
    low, _, end = w.cuts()
    view = memoryview(w.block.data)
    hashes = [xxhash.xxh3_128_intdigest(view[a:b]) for a, b in zip(low.tolist(), end.tolist())]
    pairs = np.array([(h >> 64, h & (2**64 - 1)) for h in hashes], dtype=[("a", U64), ("b", U64)]) if hashes else np.zeros(0, [("a", U64), ("b", U64)])
    distinct, inverse = np.unique(pairs, return_inverse=True)
    least = np.full(len(distinct), NONE)
    np.minimum.at(least, inverse, w.ids[w.doc_of(low)])
    return distinct["a"].copy(), distinct["b"].copy(), least, inverse


def least_id(keys: np.ndarray, sender: np.ndarray, values: list[np.ndarray]) -> np.ndarray:
    """For each hash the smallest id that any block has for it."""
    low, ids = values
    order = np.lexsort((low, keys))
    new = np.append(True, (np.diff(keys[order]) != 0) | (np.diff(low[order]) != 0))
    group = np.cumsum(new) - 1
    least = np.minimum.reduceat(ids[order], np.flatnonzero(new))
    out = np.empty(len(keys), np.int64)
    out[order] = least[group]
    return out


def repeated(keys: np.ndarray, sender: np.ndarray, values: list[np.ndarray]) -> np.ndarray:
    """For each gram whether two blocks have it, or one block in two documents."""
    order = np.argsort(keys, kind="stable")
    new = np.append(True, np.diff(keys[order]) != 0)
    at = np.flatnonzero(new)
    several = (np.diff(np.append(at, len(keys))) > 1) | (np.maximum.reduceat(values[0][order], at) > 0)
    out = np.empty(len(keys), np.uint8)
    out[order] = several[np.cumsum(new) - 1]
    return out


def gram_keys(w: Windows, settled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct smallest grams of windows not yet settled, and whether two documents of the block have them."""
    at = np.flatnonzero(w.valid & ~settled)
    if not len(at):
        return np.zeros(0, U64), np.zeros(0, np.uint8)
    grams = w.smallest[at]
    first = np.append(True, (np.diff(grams) != 0) | (np.diff(at) != 1))
    grams, ids = grams[first], w.ids[w.doc_of(at[first])]
    order = np.argsort(grams, kind="stable")
    grams, ids = grams[order], ids[order]
    new = np.flatnonzero(np.append(True, np.diff(grams) != 0))
    return grams[new], (np.minimum.reduceat(ids, new) != np.maximum.reduceat(ids, new)).astype(np.uint8)


def settled_windows(n: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    marks = np.zeros(n + 1, np.int32)
    np.add.at(marks, low, 1)
    np.add.at(marks, high, -1)
    return np.cumsum(marks[:-1]) > 0


def words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as a number that sorts as they do; zeros follow the end."""
    wide = np.concatenate([data, np.zeros(7, np.uint8)]).astype(U64)
    for size in (1, 2, 4):
        wide = (wide[:-size] << U64(8 * size)) | wide[size:]
    return wide


def window_classes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A number for each window of LENGTH bytes, in order of the sorted suffixes, equal for equal windows."""
    if not len(starts):
        return np.zeros(0, np.int64)
    word = words(np.concatenate([data, np.zeros(LENGTH + 16, np.uint8)]))
    reach = np.zeros(len(data) + PERIOD + 1, bool)
    for shift in range(PERIOD):
        reach[starts + shift] = True
    cover = np.flatnonzero(reach & np.isin(np.arange(len(reach)) % PERIOD, COVER))
    # Ranks of the cover positions by LENGTH bytes; ranks at a smaller depth join neighbours that agree so far.
    keys = [word[cover + 8 * k] for k in range(LENGTH // 8)] + [word[cover + LENGTH - LENGTH % 8] >> U64(64 - 8 * (LENGTH % 8))]
    order = np.lexsort(keys[::-1])
    by = cover[order]
    place = np.zeros(len(reach), np.int32)
    place[cover] = np.arange(len(cover))
    ranks = np.zeros((PERIOD, len(cover)), np.int32)
    for shift in range(PERIOD):
        depth, differ = LENGTH - shift, np.zeros(len(by), bool)
        for k in range(0, depth, 8):
            a = word[by + k] >> U64(8 * max(0, k + 8 - depth))
            differ[1:] |= a[1:] != a[:-1]
        ranks[shift, order] = np.cumsum(differ)
    common = [[next(s for s in range(PERIOD) if (a + s) % PERIOD in COVER and (b + s) % PERIOD in COVER) for b in range(PERIOD)] for a in range(PERIOD)]

    classes = np.empty(len(starts), np.int64)
    sort = np.argsort(word[starts], kind="stable")
    heads = np.flatnonzero(np.append(True, np.diff(word[starts[sort]]) != 0))
    ends = np.append(heads[1:], len(sort))
    low = 0
    while low < len(heads):
        high = max(low + 1, int(np.searchsorted(ends, heads[low] + SUB_BUCKET, side="right")))
        inside = sort[heads[low] : ends[high - 1]]
        run = np.repeat(np.arange(high - low), ends[low:high] - heads[low:high])
        size = ends[low:high] - heads[low:high]
        classes[inside] = heads[low:high][run]
        tied = np.flatnonzero(size[run] > 1)
        at, runs = starts[inside[tied]], run[tied]
        groups = [np.flatnonzero(at % PERIOD == a) for a in range(PERIOD)]
        # How many suffixes are smaller; those of earlier runs count for all of a run alike and are taken off.
        smaller = -np.searchsorted(runs, runs, side="left")
        for a in range(PERIOD):
            for b in range(PERIOD):
                if len(groups[a]) and len(groups[b]):
                    shift = common[a][b]
                    own = (runs[groups[a]] << 32) + ranks[shift, place[at[groups[a]] + shift]]
                    other = np.sort((runs[groups[b]] << 32) + ranks[shift, place[at[groups[b]] + shift]])
                    smaller[groups[a]] += np.searchsorted(other, own, side="left")
        classes[inside[tied]] += smaller
        low = high
    return classes


def suffix_reply(group: pa.Table) -> pa.Table:
    """For each message a bit per window: whether a smaller id than the sender's has it too."""
    lens, ids, data, sizes = [], [], [], []
    for row in group.column("sent").to_pylist():
        cut = int.from_bytes(row[:8], "little")
        _, pieces, own = unpacked(row[8 : 8 + cut])
        lens.append(pieces)
        ids.append(own)
        data.append(np.frombuffer(row, np.uint8, offset=8 + cut))
        sizes.append(int((pieces - LENGTH + 1).sum()))
    lens_, ids_ = np.concatenate(lens), np.concatenate(ids)
    n_windows = lens_ - LENGTH + 1
    begin = np.cumsum(lens_) - lens_
    ahead = np.cumsum(n_windows) - n_windows
    starts = np.repeat(begin - ahead, n_windows) + np.arange(n_windows.sum())
    classes = window_classes(np.concatenate(data), starts)
    owner = np.repeat(ids_, n_windows)
    order = np.argsort(classes, kind="stable")
    new = np.flatnonzero(np.append(True, np.diff(classes[order]) != 0))
    least = np.empty(len(owner), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(owner[order], new), np.diff(np.append(new, len(owner))))
    smaller = least < owner
    ends = np.cumsum([0, *sizes])
    rows = [np.packbits(smaller[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:])]
    counted = [np.int64(n).tobytes() + row for n, row in zip(sizes, rows)]
    return pa.table({"block": group.column("block"), "bucket": group.column("bucket"), "answers": pa.array(counted, pa.binary())})


def removed_spans(docs: DataFrame) -> DataFrame:
    """Each document's doc_id, n_bytes, removed ``spans`` (start, end in bytes) and ``kept`` bytes.

    A null text is empty. Texts shorter than LENGTH bytes lose nothing. Documents of one id
    never remove each other's bytes, a null id is smaller than none and removes nothing.
    One row comes out per row; an empty table gives none. Other columns are not read.
    """
    blocks = store_blocks(docs)
    buckets = n_buckets(blocks)
    window_buckets = 4 * buckets

    def ask_cuts(block: Block) -> Iterator[dict]:
        a, b, least, _ = cut_keys(Windows(block))
        yield from messages(block, buckets, a, [b, least])

    cuts = answered(over_blocks(blocks, ask_cuts, MESSAGE), least_id)

    def done_cuts(w: Windows, got: bytes) -> tuple[np.ndarray, np.ndarray, int]:
        """The windows of cuts that a smaller id has as well, and the bytes of their answers."""
        low, high, _ = w.cuts()
        place = cut_keys(w)[3]
        size = 8 * (int(place.max()) + 1 if len(place) else 0)
        ids = w.ids[w.doc_of(low)]
        done = (np.frombuffer(got[:size], np.int64)[place] < ids) & (ids != NONE)
        return low[done], high[done], size

    def ask_grams(block: Block, got: bytes, _: bytes) -> Iterator[dict]:
        w = Windows(block)
        low, high, _ = done_cuts(w, got)
        grams, several = gram_keys(w, settled_windows(len(w.valid), low, high))
        yield from messages(block, buckets, grams, [several])

    grams = answered(over_blocks(blocks, ask_grams, MESSAGE, cuts), repeated)
    # Answers for cuts stand before those for grams.
    both = cuts.unionByName(grams.withColumn("bucket", F.col("bucket") + buckets))

    def ask_windows(block: Block, got: bytes, _: bytes) -> Iterator[dict]:
        w = Windows(block)
        low, high, size = done_cuts(w, got)
        settled = settled_windows(len(w.valid), low, high)
        keys, _ = gram_keys(w, settled)
        left = np.flatnonzero(w.valid & ~settled)
        known = np.frombuffer(got[size:], np.uint8)
        left = left[known[np.searchsorted(keys, w.smallest[left])] > 0] if len(left) else left
        grams = w.smallest[left]
        first = np.flatnonzero(np.append(True, (np.diff(grams) != 0) | (np.diff(left) != 1))) if len(left) else left
        begin, n = left[first], np.diff(np.append(first, len(left)))
        ids = w.ids[w.doc_of(begin)]
        # Equal pieces of the block travel once, with their smallest id.
        distinct: dict[bytes, int] = {}
        place, least, key = [], [], []
        for start, count, own, gram in zip(begin.tolist(), n.tolist(), ids.tolist(), grams[first].tolist()):
            piece = block.data[start : start + count + LENGTH - 1]
            at = distinct.setdefault(piece, len(distinct))
            if at == len(least):
                least.append(own)
                key.append(gram)
            least[at] = min(least[at], own)
            place.append(at)
        key, least, pieces = np.array(key, U64), np.array(least, np.int64), list(distinct)
        order = np.argsort(key, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        to = bucket_of(key[order], window_buckets)
        edges = np.concatenate([[0], np.flatnonzero(np.diff(to)) + 1, [len(to)]]) if len(to) else [0]
        for a, b in zip(edges[:-1], edges[1:]):
            own = [pieces[i] for i in order[a:b].tolist()]
            head = packed([key[order[a:b]], np.array([len(p) for p in own], np.int64), least[order[a:b]]])
            yield {"block": block.number, "bucket": int(to[a]), "sent": len(head).to_bytes(8, "little") + head + b"".join(own)}
        lens = np.array([len(p) for p in pieces], np.int64)[order] if pieces else np.zeros(0, np.int64)
        state = [packed([low, high]), packed([begin, n, rank[place] if place else np.zeros(0, np.int64)]), packed([lens, least[order]])]
        yield note(block, b"".join(len(part).to_bytes(8, "little") + part for part in state))

    asked = stored(over_blocks(blocks, ask_windows, MESSAGE, both), "windows")
    replies = asked.where(F.col("bucket") != NOTE).groupBy("bucket").applyInArrow(suffix_reply, REPLY)
    replies = stored(replies, "suffixes").unionByName(asked.where(F.col("bucket") == NOTE).withColumnRenamed("sent", "answers"))

    def remove(block: Block, got: bytes, state: bytes) -> Iterator[dict]:
        parts, at = [], 0
        while at < len(state):
            size = int.from_bytes(state[at : at + 8], "little")
            parts.append(unpacked(state[at + 8 : at + 8 + size]))
            at += 8 + size
        (low, high), (begin, n, rank), (lens, least) = parts
        bits, at = [], 0
        while at < len(got):
            count = int.from_bytes(got[at : at + 8], "little")
            size = -(-count // 8)
            bits.append(np.unpackbits(np.frombuffer(got, np.uint8, size, at + 8), count=count))
            at += 8 + size
        smaller = np.concatenate(bits) if bits else np.zeros(0, np.uint8)
        first = np.cumsum(lens - LENGTH + 1) - (lens - LENGTH + 1)
        ids = np.where(block.known, block.ids, NONE)
        own = ids[np.searchsorted(block.starts, begin, side="right") - 1]
        # A piece goes whole if the block has it in a smaller id, else as the reply says.
        of = np.repeat(np.arange(len(begin)), n)
        step = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        gone = ((least[rank] < own)[of] | (smaller[first[rank][of] + step] > 0)) & (own != NONE)[of] if len(of) else np.zeros(0, bool)
        marks = np.zeros(len(block.data) + LENGTH + 1, np.int32)
        np.add.at(marks, low, 1)
        np.add.at(marks, high + LENGTH - 1, -1)
        at = (begin[of] + step)[gone] if len(of) else np.zeros(0, np.int64)
        np.add.at(marks, at, 1)
        np.add.at(marks, at + LENGTH, -1)
        removed = np.cumsum(marks)[: len(block.data)] > 0
        data = np.frombuffer(block.data, np.uint8)
        for i in range(len(block)):
            a, b = int(block.starts[i]), int(block.starts[i + 1])
            mask = removed[a:b]
            edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
            yield {
                "doc_id": int(block.ids[i]) if block.known[i] else None, "n_bytes": b - a,
                "spans": [{"start": int(x), "end": int(y)} for x, y in edges.reshape(-1, 2)],
                "kept": data[a:b][~mask].tobytes(),
            }

    return over_blocks(blocks, remove, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary", replies)


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = removed_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
