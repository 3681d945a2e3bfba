"""LM scoring by online logistic context mixing over the bits of words.

A text is coded word by word, each word by its bytes (A to Z in lower case) and an end, the text by a
last empty word. Every bit is predicted from several contexts: the last one to four bytes
inside the word, hashed into count tables, and the whole word so far, counted exactly.
A mixer adds the predictions in the logistic domain. How often the longest contexts were
seen selects its weights, and an adaptive table refines the result. The bits of a word do not
depend on other words, so each distinct word is coded once per corpus. The words of
the document so far adapt the result to it.

Then the words are gone through in the order of the text. One bit a word and order says whether the word
comes from the words that followed the same one or two words in the training documents, whose
numbers are counted exactly, or from the order below. A mixer predicts the bit in the logistic domain from how
often the context was seen and from how often such bits were set in the text so far, and learns
online as it goes, in each document from the same start, so that a score does not depend on what else a block
holds. A training document's own word is taken off the counts of its contexts.

Blocks send their distinct words with their training counts to buckets by the first bytes
of the word, where common prefixes are shared. Mixers learn online inside each bucket,
from counts without the word being coded, and are averaged. The tables, the weights and
the refinement have a fixed size; the words and their counts grow with the corpus and
stay distributed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zlib
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.blocks import BLOCK_BYTES, BLOCKS_PER_BUCKET, MESSAGE, REPLY, Block, bucket_of, mix64, n_buckets, over_blocks, packed, store_blocks, unpacked
from tillmark.sources.scratch import stored

#: Slots of the count table of each order, and the orders.
SLOTS, ORDERS = 1 << 18, (1, 2, 3, 4)
#: Longer words are coded in segments of so many bytes.
SEGMENT = 32
#: Bytes that select the bucket of a word; deeper prefixes are counted inside the bucket.
HEAD = 4
RATE, CHUNK = 0.2, 1 << 12
#: A document's own words so far get up to this share of the probability, half of it after so many words.
OWN, OWN_AFTER = 0.2, 30
#: In-order mixer: first weights by order of bias, size of the context and recent bits, its rate, and words a step.
ORDER_WEIGHTS, ORDER_RATE, STEP = ((-2.0, 1.0, 2.0), (-1.0, 1.0, 2.0)), 0.15, 16
#: Mixer inputs and weight sets; refinement cells.
INPUTS, GATES, CELLS = len(ORDERS) + 2, 32, 33

WIDTH = SEGMENT + 2
ZSTD = pa.Codec("zstd", 1)
U64 = np.uint64
BLANK = bytes(32 if b in (9, 10, 11, 12, 13) else b + 32 if 65 <= b <= 90 else b for b in range(256))
WHOLE, INSIDE, END = b"\x0b", b"\n", b" "


def block_words(block: Block) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of a block, the word of each token, and the number of words of each document."""
    offsets = pa.py_buffer(block.starts.tobytes())
    texts = pa.Array.from_buffers(pa.large_binary(), len(block), [None, offsets, pa.py_buffer(block.data.translate(BLANK))])
    lists = pc.split_pattern(texts, END)
    words = lists.flatten()
    full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    at = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
    sums = np.concatenate([[0], np.cumsum(full)])
    coded = words.filter(pa.array(full)).dictionary_encode()
    # Slices of one text are made much faster than Arrow's values are.
    _, cuts, data = coded.dictionary.buffers()
    cuts = np.frombuffer(cuts, np.int64, len(coded.dictionary) + 1, 8 * coded.dictionary.offset).tolist() if len(coded.dictionary) else [0]
    data = data.to_pybytes() if data else b""
    return [data[a:b] for a, b in zip(cuts[:-1], cuts[1:])], coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.diff(sums[at])


def units_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What stands for words: units, and for each the word it belongs to and whether it is coded (1) or counted (2) or both (3)."""
    units, owner, use = [], [], []
    for at, word in enumerate(words):
        if len(word) <= SEGMENT:
            units.append(word + END)
            owner.append(at)
            use.append(3)
            continue
        units.append(WHOLE + xxhash.xxh3_128_hexdigest(word).encode() + END)
        parts = [word[i : i + SEGMENT] for i in range(0, len(word), SEGMENT)]
        units += [INSIDE + part + (INSIDE if i + 1 < len(parts) else END) for i, part in enumerate(parts)]
        owner += [at] * (len(parts) + 1)
        use += [2] + [1] * len(parts)
    return np.array(units, dtype=f"S{WIDTH}"), np.array(owner, np.int64), np.array(use, np.int8)


def sorted_units(units: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct units by bucket, their buckets, and the place of each unit among them."""
    distinct, inverse = np.unique(units, return_inverse=True)
    head = np.ascontiguousarray(distinct.view(np.uint8).reshape(-1, WIDTH)[:, :HEAD]).view("<u4").ravel() if len(distinct) else np.zeros(0, "<u4")
    to = bucket_of(mix64(head.astype(U64) + U64(1)), buckets)
    order = np.argsort(to, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return distinct[order], to[order], place[inverse]


def training(ids: np.ndarray, known: np.ndarray, folds: int) -> np.ndarray:
    """Whether documents are for training: the CRC-32 of the id as text is not divisible by ``folds``."""
    return np.array([not k or zlib.crc32(str(i).encode()) % folds != 0 for i, k in zip(ids.tolist(), known.tolist())], bool)


def run_bits(buckets: int) -> int:
    """Bits of the hash of a run of words: 20 more than count the bytes of the corpus, so that one run in millions at most meets another."""
    return min(64, 20 + (buckets * BLOCKS_PER_BUCKET * BLOCK_BYTES).bit_length())


def in_order(words: list[bytes], tokens: np.ndarray, lens: np.ndarray, bits: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of all texts with their ends, the word before each, where texts begin, the distinct keys of runs of
    two and of three words, and the place among them of the two runs that end at each word."""
    end = len(words)
    stream, first = np.insert(tokens, np.cumsum(lens), end), np.cumsum(lens + 1) - lens - 1
    # What stands before a text is an empty word, as its end is.
    one, two = np.append(end, stream[:-1]), np.append([end, end], stream[:-2])[: len(stream)]
    two[first] = end
    hashes = np.array([xxhash.xxh3_64_intdigest(word) for word in [*words, b""]], U64)
    pairs = mix64(mix64(hashes[one] + U64(1)) + hashes[stream])
    triples = mix64(mix64(mix64(hashes[two] + U64(2)) + hashes[one]) + hashes[stream])
    unused = U64(64 - bits)
    runs = np.concatenate([pairs, triples]) >> unused << unused
    order = np.argsort(runs)
    ordered = runs[order]
    heads = np.append(True, ordered[1:] != ordered[:-1])
    place = np.empty(len(runs), np.int64)
    place[order] = np.cumsum(heads) - 1
    return stream, one, first, ordered[heads], place.reshape(2, -1)


def planes(array: np.ndarray) -> bytes:
    """Numbers as compressed bytes: first all lowest bytes, then all next ones."""
    size = array.dtype.itemsize
    body = ZSTD.compress(np.ascontiguousarray(array.view(np.uint8).reshape(-1, size).T).tobytes(), asbytes=True)
    return np.array([len(array), len(body)], np.int64).tobytes() + body


def from_planes(data: bytes, at: int, kind: str) -> tuple[np.ndarray, int]:
    """The numbers that ``planes`` put at a place, and where they end."""
    n, length = np.frombuffer(data, np.int64, 2, at).tolist()
    size = np.dtype(kind).itemsize
    body = ZSTD.decompress(data[at + 16 : at + 16 + length], n * size, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(body, np.uint8).reshape(size, n).T).view(kind).ravel(), at + 16 + length


def run_counts(group: pa.Table) -> pa.Table:
    """How often the training documents have each run that a block asks for, for the blocks of a bucket."""
    keys, counts = [], []
    for sent in group.column("sent").to_pylist():
        steps, at = from_planes(sent, 0, "<u8")
        keys.append(np.cumsum(steps, dtype=U64))
        counts.append(from_planes(sent, at, "<u4")[0])
    # Keys come sorted from each block, so that a stable sort merges them.
    joined = np.concatenate(keys)
    order = np.argsort(joined, kind="stable")
    heads = np.append(True, np.diff(joined[order]) != 0)
    total = np.empty(len(joined), np.int64)
    total[order] = np.add.reduceat(np.concatenate(counts).astype(np.int64)[order], np.flatnonzero(heads))[np.cumsum(heads) - 1]
    ends = np.cumsum([0, *(len(k) for k in keys)])
    answers = [planes(total[low:high]) for low, high in zip(ends[:-1], ends[1:])]
    return pa.table({"block": group.column("block"), "bucket": group.column("bucket"), "answers": pa.array(answers, pa.binary())})


def mixed_in_order(logs: np.ndarray, seen: np.ndarray, totals: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The log10 of each word's probability, mixed in the order of the texts.

    ``logs`` are those without regard to the words before; ``seen`` and ``totals`` are, by order, how often the word and
    any word followed the context. A step codes so many words of all texts that go on, then their mixers learn.
    """
    result = np.empty(len(logs))
    order = np.argsort(-sizes, kind="stable")
    first, sizes = first[order], sizes[order]
    weights, recent = np.tile(np.array(ORDER_WEIGHTS)[:, None], (1, len(sizes), 1)), np.zeros((2, len(sizes)))
    more = np.maximum(totals, 1)
    facts = np.stack([*np.where(totals > 0, seen / more, 0.0), *(np.log(more) / 4), *(totals > 0), logs, 10.0 ** logs])
    ends, least = np.searchsorted(-sizes, -np.arange(0, int(sizes.max(initial=0)), STEP), side="left").tolist(), 1e-300
    for at, n in zip(range(0, STEP * len(ends), STEP), ends):
        place = at + np.arange(STEP)
        index = first[:n, None] + np.minimum(place, sizes[:n, None] - 1)
        some = facts[:, index]
        share, size, valid = some[0:2], some[2:4], place < sizes[:n, None]
        use = some[4:6] * valid
        w, now = weights[:, :n, :, None], recent[:, :n, None]
        gate = use * squash(w[:, :, 0] + w[:, :, 1] * size + w[:, :, 2] * now)
        stay, drawn = 1 - gate, gate * share
        one = drawn[0] + stay[0] * some[7]
        both = drawn[1] + stay[1] * one
        # What is too small for a float has its logarithm from below.
        result[index[valid]] = np.where(both > least, np.log10(np.maximum(both, least)), some[6] + np.log10(stay[0] * stay[1]))[valid]
        taken = drawn[1] / (both + least)
        left = 1 - taken
        bits = np.stack([left * drawn[0] / (one + least), taken])
        error = use * (bits - np.stack([left * gate[0], gate[1]]))
        total = error.sum(2)
        weights[:, :n] += ORDER_RATE * np.stack([total, (error * size).sum(2), total * recent[:, :n]], axis=2)
        number = use.sum(2)
        recent[:, :n] += np.where(number > 0, ((use * bits).sum(2) / np.maximum(number, 1) - recent[:, :n]) / 2, 0.0)
    return result


class Trie:
    """The bits of sorted units, edge by edge: equal prefixes are coded once."""

    def __init__(self, units: np.ndarray, counts: np.ndarray):
        self.bytes = units.view(np.uint8).reshape(-1, WIDTH)
        self.lens = np.char.str_len(units)
        self.counts = counts

    def levels(self) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, ...]]]]:
        """Per byte position: the rows, the edge of each, and per bit (bit, weight, slots, nodes, n0, n1)."""
        prefix = np.zeros(len(self.lens), np.int64)
        for level in range(int(self.lens.max(initial=0))):
            rows = np.flatnonzero(self.lens > level)
            byte, above = self.bytes[rows, level].astype(np.int64), prefix[rows]
            first = np.append(True, (np.diff(above) != 0) | (np.diff(byte) != 0))
            heads = np.flatnonzero(first)
            edge = np.cumsum(first) - 1
            weight = np.add.reduceat(self.counts[rows], heads).astype(np.float64)
            symbol, above = byte[heads], above[heads]
            # The order and how many bytes of the word it sees are part of a context.
            contexts, value = [], np.zeros(len(heads), U64)
            for order in range(1, max(ORDERS) + 1):
                if level >= order:
                    value = value + (self.bytes[rows[heads], level - order].astype(U64) << U64(8 * (order - 1)))
                contexts.append(mix64(value * U64(64) + U64(8 * order + min(level, order))))
            bits = []
            for k in range(7, -1, -1):
                partial, bit = (1 << (7 - k)) | (symbol >> (k + 1)), (symbol >> k) & 1
                slots = [((mix64(contexts[order - 1] + partial.astype(U64)) & U64(SLOTS - 1))).astype(np.int64) for order in ORDERS]
                node = np.append(True, (np.diff(above) != 0) | (np.diff(partial) != 0))
                at = np.flatnonzero(node)
                which = np.cumsum(node) - 1
                n = np.add.reduceat(weight, at)[which]
                n1 = np.add.reduceat(weight * bit, at)[which]
                deep = level >= HEAD
                # The longest order sees the whole of a shorter prefix, over all buckets.
                bits.append((bit, weight, slots, n - n1 if deep else None, n1 if deep else None))
            yield rows, edge, bits
            # Rows of one edge share the prefix of the next level.
            prefix = np.full(len(self.lens), -1, np.int64)
            prefix[rows] = edge


def stretch(p: np.ndarray) -> np.ndarray:
    return np.clip(np.log(p / (1 - p)), -12, 12)


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Mixer:
    """Gated weights over stretched predictions, and a refinement of what they give."""

    def __init__(self, state: np.ndarray | None = None):
        # At first a prefix that was seen before is believed, else all orders alike.
        start = np.zeros((GATES, INPUTS))
        start[:4, : len(ORDERS)] = 0.3
        start[4:, -2] = 1.0
        cells = squash(np.linspace(-8, 8, CELLS))
        self.weights = start if state is None else state[: GATES * INPUTS].reshape(GATES, INPUTS).copy()
        self.refined = np.tile(cells, (GATES, 1)) if state is None else state[GATES * INPUTS :].reshape(GATES, CELLS).copy()

    def state(self) -> np.ndarray:
        return np.concatenate([self.weights.ravel(), self.refined.ravel()])

    def inputs(self, tables: np.ndarray, slots: list[np.ndarray], n0: np.ndarray | None, n1: np.ndarray | None, own: bool, bit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Stretched predictions and the weight set of each bit; if ``own``, one token with the bit is taken off the counts."""
        off1, off0 = (bit, 1 - bit) if own else (0, 0)
        x = np.empty((len(bit), INPUTS))
        for i, slot in enumerate(slots):
            a, b = np.maximum(tables[i, 0, slot] - off0, 0), np.maximum(tables[i, 1, slot] - off1, 0)
            x[:, i] = stretch((b + 0.05) / (a + b + 0.1))
        longest = a + b
        if n0 is not None:
            a, b = np.maximum(n0 - off0, 0), np.maximum(n1 - off1, 0)
        x[:, -2] = stretch((b + 0.05) / (a + b + 0.1))
        x[:, -1] = 0.3
        gate = np.minimum(np.log2(a + b + 1), 7).astype(np.int64) * 4 + np.minimum(np.log2(longest + 1) / 3, 3).astype(np.int64)
        return x, gate

    def predict(self, x: np.ndarray, gate: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The mixed probability of a one, the refined one, and the refinement's cell and place between two cells."""
        dot = np.einsum("ij,ij->i", x, self.weights[gate])
        mixed = squash(dot)
        at = (np.clip(dot, -7.999, 7.999) + 8) * (CELLS - 1) / 16
        cell = at.astype(np.int64)
        part = at - cell
        refined = self.refined[gate, cell] * (1 - part) + self.refined[gate, cell + 1] * part
        return mixed, np.clip((mixed + 3 * refined) / 4, 1e-6, 1 - 1e-6), cell, part

    def learn(self, x: np.ndarray, gate: np.ndarray, bit: np.ndarray, weight: np.ndarray) -> None:
        """One online step per chunk."""
        for low in range(0, len(bit), CHUNK):
            s = slice(low, low + CHUNK)
            mixed, _, cell, part = self.predict(x[s], gate[s])
            total = np.bincount(gate[s], weight[s], minlength=GATES)
            step = (weight[s] * (bit[s] - mixed))[:, None] * x[s]
            gradient = np.stack([np.bincount(gate[s], step[:, i], minlength=GATES) for i in range(INPUTS)], axis=1)
            # Steps are measured by the squared inputs, so that no learning rate can diverge.
            power = np.bincount(gate[s], weight[s] * (x[s] ** 2).sum(1), minlength=GATES) / 4 + total
            self.weights += RATE * gradient / np.maximum(power, 1e-9)[:, None]
            near = gate[s] * CELLS + cell + (part > 0.5)
            seen = np.bincount(near, weight[s], minlength=GATES * CELLS)
            ones = np.bincount(near, weight[s] * bit[s], minlength=GATES * CELLS)
            share = (seen / (seen + 200)).reshape(GATES, CELLS)
            self.refined += share * ((ones / np.maximum(seen, 1e-9)).reshape(GATES, CELLS) - self.refined)


def vocabulary_rows(group: pa.Table) -> pa.Table:
    """A bucket's units with their training counts, and where each message's units stand among them."""
    heads, parts = [], []
    for row in group.column("sent").to_pylist():
        cut = int.from_bytes(row[:8], "little")
        heads.append(unpacked(row[8 : 8 + cut])[0])
        parts.append(np.frombuffer(row, dtype=f"S{WIDTH}", offset=8 + cut))
    units, inverse = np.unique(np.concatenate(parts), return_inverse=True)
    counts = np.bincount(inverse, np.concatenate(heads), minlength=len(units)).astype(np.int64)
    ends = np.cumsum([0, *(len(p) for p in parts)])
    places = [inverse[a:b].astype(np.int32).tobytes() for a, b in zip(ends[:-1], ends[1:])]
    bucket = group.column("bucket")[0].as_py()
    return pa.table({
        "block": [*group.column("block").to_pylist(), None], "bucket": [bucket] * (len(places) + 1),
        "places": pa.array([*places, None], pa.binary()), "units": pa.array([None] * len(places) + [units.tobytes()], pa.binary()),
        "counts": pa.array([None] * len(places) + [counts.tobytes()], pa.binary()),
    })


def coded_units(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units and counts of a vocabulary row, and which of them are coded."""
    units, counts = np.frombuffer(row["units"], dtype=f"S{WIDTH}"), np.frombuffer(row["counts"], np.int64)
    return units, counts, units.view(np.uint8).reshape(-1, WIDTH)[:, 0] != WHOLE[0] if len(units) else np.zeros(0, bool)


def over_rows(make: Callable[[Iterator[dict]], Iterator[dict]], schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (batch.slice(i, 1).to_pylist()[0] for batch in batches for i in range(batch.num_rows))
        for row in make(rows):
            yield pa.RecordBatch.from_pylist([row], schema=schema)

    return run


def count_tables(rows: Iterator[dict]) -> Iterator[dict]:
    """The zeros and ones seen in each slot, for the words of a task."""
    tables = np.zeros((len(ORDERS), 2, SLOTS), np.int64)
    for row in rows:
        units, counts, coded = coded_units(row)
        seen = coded & (counts > 0)
        for _, _, bits in Trie(units[seen], counts[seen]).levels():
            for bit, weight, slots, _, _ in bits:
                for i, slot in enumerate(slots):
                    for b in (0, 1):
                        here = bit == b
                        np.add.at(tables[i, b], slot[here], weight[here].astype(np.int64))
    for i in range(len(ORDERS)):
        for b in (0, 1):
            if tables[i, b].any():
                yield {"part": 2 * i + b, "counts": tables[i, b].tobytes()}


def added(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(row, np.int64) for row in group.column("counts").to_pylist())
    return pa.table({"part": group.column("part")[:1], "counts": pa.array([total.tobytes()], pa.binary())})


def lm_scores(docs: DataFrame, folds: int = 10) -> DataFrame:
    """Every document's score under a model of the training documents, and under word counts.

    Training documents are those whose CRC-32 of the id as text is not divisible by ``folds``; a null id
    is one. A null text is empty and has its end alone. Repeated rows count as often as
    they come. Without training documents every count is 0. Columns: doc_id, held_out,
    n_bytes, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.
    """
    spark = docs.sparkSession
    blocks = store_blocks(docs)
    buckets = n_buckets(blocks)
    bits = run_bits(buckets)

    def ask(block: Block) -> Iterator[dict]:
        words, tokens, lens = block_words(block)
        train = training(block.ids, block.known, folds)
        counts = np.bincount(tokens[np.repeat(train, lens)], minlength=len(words))
        units, owner, _ = units_of([*words, b""])
        counts = np.append(counts, train.sum())[owner]
        distinct, to, place = sorted_units(units, buckets)
        total = np.bincount(place, counts, minlength=len(distinct)).astype(np.int64)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(to)) + 1, [len(to)]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            head = packed([total[a:b]])
            yield {"block": block.number, "bucket": int(to[a]), "sent": len(head).to_bytes(8, "little") + head + distinct[a:b].tobytes()}

    def ask_runs(block: Block) -> Iterator[dict]:
        words, tokens, lens = block_words(block)
        _, _, _, keys, place = in_order(words, tokens, lens, bits)
        train = np.repeat(training(block.ids, block.known, folds), lens + 1)
        counts = sum(np.bincount(p[train], minlength=len(keys)) for p in place).astype("<u4")
        to = bucket_of(keys, buckets)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(to)) + 1, [len(to)]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield {"block": block.number, "bucket": int(to[a]), "sent": planes(np.diff(keys[a:b] >> U64(64 - bits), prepend=U64(0))) + planes(counts[a:b])}

    # What the runs of words are shuffled by goes before the words themselves are.
    runs = stored(over_blocks(blocks, ask_runs, MESSAGE).groupBy("bucket").applyInArrow(run_counts, REPLY), "runs")
    sent = over_blocks(blocks, ask, MESSAGE)
    merged = stored(sent.groupBy("bucket").applyInArrow(vocabulary_rows, "block long, bucket long, places binary, units binary, counts binary"), "vocabulary")
    vocabulary = merged.where("block IS NULL").select("bucket", "units", "counts")

    tables_schema = pa.schema([("part", pa.int32()), ("counts", pa.binary())])
    parts = vocabulary.mapInArrow(over_rows(count_tables, tables_schema), "part int, counts binary").groupBy("part").applyInArrow(added, "part int, counts binary")
    tables = np.zeros((len(ORDERS), 2, SLOTS), np.float32)
    for row in parts.collect():
        tables[row.part // 2, row.part % 2] = np.frombuffer(row.counts, np.int64)
    shared = spark.sparkContext.broadcast(tables)

    def train_mixer(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            units, counts, coded = coded_units(row)
            seen = coded & (counts > 0)
            mixer, total = Mixer(), 0.0
            for _, _, bits in Trie(units[seen], counts[seen]).levels():
                for bit, weight, slots, n0, n1 in bits:
                    x, gate = mixer.inputs(shared.value, slots, n0, n1, True, bit)
                    mixer.learn(x, gate, bit, weight)
                    total += weight.sum()
            words = ~np.char.startswith(units, INSIDE) & (counts > 0)
            yield {"weight": total, "state": mixer.state().tolist(), "n": int(counts[words].sum()), "v": int(words.sum())}

    state_schema = pa.schema([("weight", pa.float64()), ("state", pa.list_(pa.float64())), ("n", pa.int64()), ("v", pa.int64())])
    learned = stored(vocabulary.mapInArrow(over_rows(train_mixer, state_schema), "weight double, state array<double>, n long, v long"), "mixers")
    totals = learned.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("v"), F.lit(0)).alias("v"), F.sum("weight").alias("weight")).first()
    cells = learned.where("weight > 0").select("weight", F.posexplode("state").alias("at", "value")).groupBy("at").agg((F.sum(F.col("weight") * F.col("value")) / F.sum("weight")).alias("value"))
    state = np.array([r.value for r in sorted(cells.collect(), key=lambda r: r.at)]) if totals.weight else None

    def score_units(rows: Iterator[dict]) -> Iterator[dict]:
        mixer = Mixer(state)
        for row in rows:
            units, counts, coded = coded_units(row)
            at, logs = np.flatnonzero(coded), np.zeros(len(units))
            sums = np.zeros(len(at))
            for rows_, edge, bits in Trie(units[at], counts[at]).levels():
                cost = 0.0
                for bit, _, slots, n0, n1 in bits:
                    p = mixer.predict(*mixer.inputs(shared.value, slots, n0, n1, False, bit))[1]
                    cost = cost + np.log10(np.where(bit == 1, p, 1 - p))
                sums[rows_] += cost[edge]
            logs[at] = sums
            yield {"bucket": row["bucket"], "counts": row["counts"], "logs": logs.tobytes()}

    scores_schema = pa.schema([("bucket", pa.int64()), ("counts", pa.binary()), ("logs", pa.binary())])
    scores = stored(vocabulary.mapInArrow(over_rows(score_units, scores_schema), "bucket long, counts binary, logs binary"), "scores")

    def reply(asked: pa.Table, scored: pa.Table) -> pa.Table:
        counts, logs = (np.frombuffer(scored.column(c)[0].as_py(), t) for c, t in (("counts", np.int64), ("logs", np.float64)))
        rows = []
        for places in asked.column("places").to_pylist():
            at = np.frombuffer(places, np.int32)
            rows.append(np.rec.fromarrays([counts[at], logs[at]], dtype=[("c", "<i8"), ("l", "<f8")]).tobytes())
        return pa.table({"block": asked.column("block"), "bucket": asked.column("bucket"), "answers": pa.array(rows, pa.binary())})

    asked = merged.where("block IS NOT NULL").select("block", "bucket", "places")
    replies = asked.groupBy("bucket").cogroup(scores.groupBy("bucket")).applyInArrow(reply, "block long, bucket long, answers binary")
    # A block gets the answers about its runs of words behind those about its units.
    replies = replies.unionByName(runs.withColumn("bucket", F.col("bucket") + buckets))
    n, v = int(totals.n), int(totals.v)

    def add(block: Block, got: bytes, _: bytes) -> Iterator[dict]:
        words, tokens, lens = block_words(block)
        train = training(block.ids, block.known, folds)
        units, owner, use = units_of([*words, b""])
        distinct, _, place = sorted_units(units, buckets)
        answers = np.frombuffer(got, dtype=[("c", "<i8"), ("l", "<f8")], count=len(distinct))[place]
        _, one, first, _, run = in_order(words, tokens, lens, bits)
        parts, at = [], 16 * len(distinct)
        while at < len(got):
            part, at = from_planes(got, at, "<i8")
            parts.append(part)
        runs_seen = np.concatenate(parts)[run]
        counts = np.zeros(len(words) + 1, np.int64)
        counts[owner[use >= 2]] = answers["c"][use >= 2]
        logs = np.bincount(owner, np.where(use == 2, 0.0, answers["l"]), minlength=len(words) + 1)
        base = np.log10((counts + 0.1) / (n + 0.1 * (v + 1)))
        ends = np.cumsum(lens)

        def per_doc(values: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(values[tokens])])
            return sums[ends] - sums[ends - lens] + values[-1]

        # What a document has said before is likelier to come again.
        step = np.arange(len(tokens)) - np.repeat(ends - lens, lens)
        which = np.repeat(np.arange(len(block)), lens) * (len(words) + 1) + tokens
        order = np.argsort(which, kind="stable")
        heads = np.flatnonzero(np.append(True, np.diff(which[order]) != 0)) if len(order) else order
        before = np.empty(len(order), np.int64)
        before[order] = np.arange(len(order)) - np.repeat(heads, np.diff(np.append(heads, len(order))))
        own = OWN * step / (step + OWN_AFTER)
        with np.errstate(divide="ignore"):
            adapted = np.log10((1 - own) * 10.0 ** logs[tokens] + own * before / np.maximum(step, 1))
        adapted = np.maximum(adapted, np.log10(1 - own) + logs[tokens])
        last = np.log10(1 - OWN * lens / (lens + OWN_AFTER)) + logs[-1]
        # The contexts of a word are the word before it and the run of two before it, which no first word has.
        contexts = np.stack([counts[one], np.append(0, runs_seen[0][:-1])])
        contexts[1][first] = 0
        off = np.repeat(train, lens + 1).astype(np.int64)
        mixed = mixed_in_order(np.insert(adapted, ends, last), np.maximum(runs_seen - off, 0), np.maximum(contexts - off, 0), first, lens + 1)
        score = np.add.reduceat(mixed, first)
        known, base = per_doc((counts > 0).astype(np.int64)), per_doc(base)
        sizes = np.diff(block.starts)
        for i in range(len(block)):
            yield {
                "doc_id": int(block.ids[i]) if block.known[i] else None, "held_out": not train[i], "n_bytes": int(sizes[i]), "n_tokens": int(lens[i]) + 1,
                "n_known": int(known[i]), "train_tokens": n, "base_score": float(base[i]), "score": float(score[i]),
                "bits_per_byte": float(-score[i] / np.log10(2) / max(int(sizes[i]), 1)),
            }

    schema = "doc_id long, held_out boolean, n_bytes long, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    return over_blocks(blocks, add, schema, replies)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
