"""Texts in blocks, and a census of keys over all blocks.

A block holds the ids and texts of some documents, about ``BLOCK_BYTES`` of text. Blocks
are stored once, bucketed, so that later steps read them without a shuffle.

A census asks for each distinct key of a block what all blocks know of it together. The
blocks send their sorted distinct keys as one binary per bucket of keys; a bucket is
answered in one task, one value per key sent, and the answers return to their block in key
order. Only distinct keys travel: a key that a third of all documents share arrives once
from each block. Blocks may be lost and computed again, since keys depend on the text alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tillmark.sources.scratch import drop_scratch, scratch_path

BLOCK_BYTES = 1 << 20
#: Blocks whose keys make up one bucket, on average.
BLOCKS_PER_BUCKET = 8

def fresh_name(columns: list[str], name: str) -> str:
    """``name``, lengthened until no column has it; Spark takes upper and lower case for the same."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name += "_"
    return name


BLOCK = "block long, n long, ids binary, known binary, rows binary, sizes binary, text binary"


class Block:
    """The documents of a block: ``ids`` (int64), ``known`` (false for a null id), ``rows``, ``starts`` and the bytes."""

    def __init__(self, row: dict):
        self.number = row["block"]
        self.ids = np.frombuffer(row["ids"], dtype=np.int64)
        self.known = np.frombuffer(row["known"], dtype=np.bool_)
        self.rows = np.frombuffer(row["rows"], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(np.frombuffer(row["sizes"], dtype=np.int64))]).astype(np.int64)
        self.data = row["text"]

    def __len__(self) -> int:
        return len(self.ids)

    def texts(self) -> Iterator[bytes]:
        for low, high in zip(self.starts[:-1].tolist(), self.starts[1:].tolist()):
            yield self.data[low:high]


def store_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents (doc_id, text: string or binary) of a table as stored blocks. A null text is empty.

    A column ``row`` (long), where there is one, comes along; it tells rows of one id apart.
    """
    spark = docs.sparkSession

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, serial = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        rows: list[int] = []
        texts: list[bytes] = []
        held = 0

        def flush() -> pa.RecordBatch:
            row = {
                "block": (part << 32) + serial, "n": len(ids), "ids": np.array([i or 0 for i in ids], np.int64).tobytes(),
                "known": np.array([i is not None for i in ids], np.bool_).tobytes(),
                "rows": np.array(rows, np.int64).tobytes(),
                "sizes": np.array([len(t) for t in texts], np.int64).tobytes(), "text": b"".join(texts),
            }
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([("block", pa.int64()), ("n", pa.int64()), *((c, pa.binary()) for c in ("ids", "known", "rows", "sizes", "text"))]))

        for batch in batches:
            for doc_id, text, row in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
                ids.append(doc_id)
                rows.append(row)
                texts.append(text or b"")
                held += len(texts[-1])
                if held >= block_bytes:
                    yield flush()
                    ids, rows, texts, held, serial = [], [], [], 0, serial + 1
        if ids:
            yield flush()

    row = F.col("row") if dict(docs.dtypes).get("row") == "bigint" else F.lit(0).cast("long")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(row, F.lit(0)).alias("row"))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    name = f"blocks_{uuid.uuid4().hex}"
    path = scratch_path(spark, "blocks")
    # No two texts are equal, so that a dictionary of them would be made in vain.
    writer = docs.mapInArrow(gather, BLOCK).write.format("parquet").options(**{"compression": "zstd", "parquet.enable.dictionary": "false", "path": path})
    writer.bucketBy(buckets, "block").saveAsTable(name)
    return spark.table(name)


def n_buckets(blocks: DataFrame, blocks_per_bucket: int = BLOCKS_PER_BUCKET) -> int:
    """Buckets of keys for so many blocks."""
    return max(1, -(-blocks.count() // blocks_per_bucket))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each 64-bit key; it rises with the key."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: equal inputs stay equal, bits spread evenly."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


MESSAGE = "block long, bucket long, sent binary"
REPLY = "block long, bucket long, answers binary"
#: The bucket of what a block writes to itself, for its next step.
NOTE = -1


def note(block: Block, state: bytes) -> dict:
    return {"block": block.number, "bucket": NOTE, "sent": state}


def messages(block: Block, buckets: int, keys: np.ndarray, values: list[np.ndarray]) -> Iterator[dict]:
    """One message per bucket with the block's sorted keys and their values."""
    to = bucket_of(keys, buckets)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(to)) + 1, [len(keys)]]) if len(keys) else [0]
    for low, high in zip(cuts[:-1], cuts[1:]):
        yield {"block": block.number, "bucket": int(to[low]), "sent": packed([keys[low:high], *(v[low:high] for v in values)])}


def answered(sent: DataFrame, answer: Callable[[np.ndarray, np.ndarray, list[np.ndarray]], np.ndarray]) -> DataFrame:
    """Replies (block, bucket, answers) to messages, stored.

    ``answer`` gets all keys of a bucket, the number of the sender of each, and the
    values; it returns one value per key.
    """

    def reply(group: pa.Table) -> pa.Table:
        parts = [unpacked(row) for row in group.column("sent").to_pylist()]
        sizes = [len(part[0]) for part in parts]
        columns = [np.concatenate([part[i] for part in parts]) for i in range(len(parts[0]))]
        got = answer(columns[0], np.repeat(np.arange(len(parts)), sizes), columns[1:])
        ends = np.cumsum([0, *sizes])
        rows = [got[low:high].tobytes() for low, high in zip(ends[:-1], ends[1:])]
        return pa.table({"block": group.column("block"), "bucket": group.column("bucket"), "answers": pa.array(rows, pa.binary())})

    return stored(sent.groupBy("bucket").applyInArrow(reply, REPLY), "replies")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared scratch folder and read back."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def release(*frames: DataFrame) -> None:
    """Removes the folders of stored frames that nothing reads any more."""
    for frame in frames:
        for folder in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
            drop_scratch(frame.sparkSession, folder)


def packed(arrays: list[np.ndarray]) -> bytes:
    """Arrays of one length as bytes."""
    kinds = ",".join(a.dtype.str for a in arrays).encode()
    return len(kinds).to_bytes(2, "little") + kinds + len(arrays[0]).to_bytes(8, "little") + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def unpacked(data: bytes) -> list[np.ndarray]:
    size = int.from_bytes(data[:2], "little")
    kinds, n, at, found = data[2 : 2 + size].decode().split(","), int.from_bytes(data[2 + size : 10 + size], "little"), 10 + size, []
    for kind in kinds:
        found.append(np.frombuffer(data, dtype=kind, count=n, offset=at))
        at += n * np.dtype(kind).itemsize
    return found


def over_blocks(blocks: DataFrame, make: Callable[..., Iterator[dict | pa.Table]], schema: str, answers: DataFrame | None = None) -> DataFrame:
    """The rows that ``make(block)`` gives for each block, one by one or as tables of whole columns.

    With ``answers`` it is called as ``make(block, got, state)``: the answers in the order
    of the keys sent, and the block's note to itself.
    """
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def table(row: dict, *more: bytes) -> pa.Table:
        made = list(make(Block(row), *more))
        if made and isinstance(made[0], pa.Table):
            return pa.concat_tables([part.select(kinds.names).cast(kinds) for part in made])
        return pa.Table.from_pylist(made, schema=kinds)

    if answers is None:

        def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    yield from table(batch.slice(i, 1).to_pylist()[0]).to_batches()

        return blocks.mapInArrow(alone, schema)

    def together(block: pa.Table, replies: pa.Table) -> pa.Table:
        rows = block.to_pylist()
        if not rows:
            return kinds.empty_table()
        replies = replies.sort_by("bucket")
        parts = list(zip(replies.column("bucket").to_pylist(), replies.column("answers").to_pylist()))
        got = b"".join(part for bucket, part in parts if bucket != NOTE)
        return table(rows[0], got, next((part for bucket, part in parts if bucket == NOTE), b""))

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(together, schema)
