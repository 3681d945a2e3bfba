"""Best-fit packing: documents into token sequences by bulk-synchronous rounds.

A round sorts the unplaced pieces and the gaps of open sequences together by size and
range-partitions them. Each task sweeps its range from large to small: a gap goes on a
stack, a piece takes the top, which is its successor, the smallest gap not below it. What
a range leaves over is matched between ranges by rank: the tasks report two counts each,
and the counts alone say which ranks of which range belong together. Then the gaps are
updated and the next round begins. A gap much larger than the largest unplaced piece enters
the sweep as several slots, so short pieces do not need a round each. Pieces larger than
every gap open new sequences, as many as their total length needs at least.

Pieces of one length differ in their key, and ranges are cut by (size, key), so a length
that a third of all pieces share is dealt over many tasks. The driver sees two counts per
task and a few totals.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillmark.llm.pieces import encoder
from tillmark.llm.token_counts import tokenizer_path
from tillmark.sources.scratch import scratch_path

CAPACITY, END_ID = 1024, 2
# What a row of a round's table is.
OPEN, PLACED, LEFT = 0, 1, 2
SWEPT = "kind int, key long, size int, seq long, part int, rank long"


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """The pieces of every whole text: its ids, then ``end_id``, in pieces of at most ``capacity``.

    Only longer documents are cut. All pieces but the first are full, so at most one
    piece of a document shares its sequence. A null text counts as empty and gives one
    piece that holds the end alone. With ``keep_ids`` the ids come along as little-endian
    unsigned 32-bit bytes.
    """
    end = int(end_id).to_bytes(4, "little")
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if keep_ids else [])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            rows: list[tuple] = []
            coded = (bytes(data[a:b]) for data, bounds in coder.encode(batch.column(1)) for a, b in zip(bounds[:-1], bounds[1:]))
            for at, ids in enumerate(coded):
                ids += end
                total = len(ids) // 4
                start, piece = 0, 0
                stop = total % capacity or min(total, capacity)
                while start < total:
                    part = ids[4 * start : 4 * stop]
                    rows.append((at, piece, start, stop - start, zlib.crc32(part), part if keep_ids else None))
                    start, stop, piece = stop, stop + capacity, piece + 1
            at, piece, start, length, crc, part = zip(*rows) if rows else ((),) * 6
            columns = [
                batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(part, pa.binary())] if keep_ids else []), names)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range: rows of (kind, key, size) from large to small, gaps before pieces of their size."""
    part = TaskContext.get().partitionId()
    stack: list[tuple[int, int]] = []
    waiting = 0

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kind, key, size, seq, rank = zip(*rows) if rows else ((),) * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(kind, pa.int32()), pa.array(key, pa.int64()), pa.array(size, pa.int32()), pa.array(seq, pa.int64()),
             pa.array([part] * len(kind), pa.int32()), pa.array(rank, pa.int64())],
            ["kind", "key", "size", "seq", "part", "rank"],
        )

    for table in batches:
        rows = []
        for kind, key, size in zip(*(column.to_pylist() for column in table.columns)):
            if kind == OPEN:
                stack.append((key, size))
            elif stack:
                rows.append((PLACED, key, size, stack.pop()[0], None))
            else:
                rows.append((LEFT, key, size, None, waiting))
                waiting += 1
        yield batch(rows)
    # Rank 0 is the smallest gap left over, the next that a smaller range would take.
    for low in range(0, len(stack), 10_000):
        rows = [(OPEN, key, size, key, low + at) for at, (key, size) in enumerate(stack[::-1][low : low + 10_000])]
        yield batch(rows)


def _between_ranges(counts: dict[tuple[int, int], int]) -> list[tuple[int, int, int, int, int]]:
    """(range of pieces, first rank, number, range of gaps, first rank) of what ranges match with each other."""
    found, stack = [], []
    for part in sorted({part for part, _ in counts}):
        need, rank = counts.get((part, LEFT), 0), 0
        while need and stack:
            gap_part, gap_rank, room = stack.pop()
            n = min(need, room)
            found.append((part, rank, n, gap_part, gap_rank))
            need, rank = need - n, rank + n
            if room > n:
                stack.append((gap_part, gap_rank + n, room - n))
        if room := counts.get((part, OPEN), 0):
            stack.append((part, 0, room))
    return found


def best_fit(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Sequences for items (key long, unique, not null; size int, 1 to capacity): key, size, seq.

    Items of the full size, and an empty table, need no round. Every item is placed. The
    result is read from tables in the scratch folder, one per round.
    """
    spark = items.sparkSession
    base = scratch_path(spark, "packing")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def stored(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    placed = [items.where(F.col("size") >= capacity).select("key", "size", (-1 - F.col("key")).alias("seq"))]
    left = items.where(F.col("size") < capacity).select("key", "size")
    gaps = spark.createDataFrame([], "seq long, gap int")
    opened = widest = number = 0
    while True:
        over = F.col("size") > widest
        now = left.agg(
            F.count("*").alias("n"), F.min("size").alias("least"), F.max("size").alias("most"),
            F.coalesce(F.sum(F.when(over, F.col("size").cast("long"))), F.lit(0)).alias("total"),
            F.count(F.when(over & (F.col("size") > capacity // 2), 1)).alias("halves"),
        ).first()
        if not now.n:
            break
        new = max(-(-now.total // capacity), now.halves)
        if new:
            fresh = spark.range(opened, opened + new, numPartitions=tasks).select(F.col("id").alias("seq"), F.lit(capacity).alias("gap"))
            gaps, opened = gaps.union(fresh), opened + new
        slots = F.greatest(F.lit(1), F.floor(F.col("gap") / now.most)).cast("int")
        open_rows = gaps.where(F.col("gap") >= now.least).select(
            F.lit(OPEN).alias("kind"), F.col("seq").alias("key"),
            F.explode(F.concat(F.array_repeat(F.lit(now.most), slots - 1), F.array(F.col("gap") - (slots - 1) * now.most))).alias("size"),
        )
        rows = open_rows.union(left.select(F.lit(LEFT).alias("kind"), "key", "size"))
        order = [F.col("size").desc(), F.col("kind"), F.col("key")]
        swept = stored(rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order).mapInArrow(_sweep, SWEPT), f"swept-{number}")
        counts = {(r.part, r.kind): r["count"] for r in swept.where(F.col("kind") != PLACED).groupBy("part", "kind").count().collect()}
        # Two rows per task at most.
        pairs = spark.createDataFrame(_between_ranges(counts), "part int, first long, n long, gap_part int, gap_first long")

        matched = swept.where(F.col("kind") == LEFT).join(F.broadcast(pairs), "part").where(
            (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("n"))
        ).select("key", "size", "gap_part", (F.col("gap_first") + F.col("rank") - F.col("first")).alias("gap_rank"))
        free = swept.where(F.col("kind") == OPEN).select(F.col("part").alias("gap_part"), F.col("rank").alias("gap_rank"), "seq")
        took = matched.join(free, ["gap_part", "gap_rank"]).select("key", "size", "seq")
        # Ranks below a range's matched number are taken; the rest waits for the next round.
        reach = pairs.groupBy("part").agg(F.sum("n").alias("reach"))
        still = swept.where(F.col("kind") == LEFT).join(F.broadcast(reach), "part", "left").where(F.col("rank") >= F.coalesce("reach", F.lit(0)))
        put = swept.where(F.col("kind") == PLACED).select("key", "size", "seq").union(took)
        used = put.groupBy("seq").agg(F.sum("size").alias("used"))
        rest = gaps.join(used, "seq", "left").select("seq", (F.col("gap") - F.coalesce("used", F.lit(0))).cast("int").alias("gap"))
        state = stored(
            put.select(F.lit(PLACED).alias("kind"), "key", "size", "seq")
            .union(still.select(F.lit(LEFT), "key", "size", F.lit(None).cast("long")))
            .union(rest.where("gap > 0").select(F.lit(OPEN), F.lit(None).cast("long"), "gap", "seq")),
            f"state-{number}",
        )
        placed.append(state.where(F.col("kind") == PLACED).select("key", "size", "seq"))
        left = state.where(F.col("kind") == LEFT).select("key", "size")
        gaps = state.where(F.col("kind") == OPEN).select("seq", F.col("size").alias("gap"))
        widest = gaps.agg(F.max("gap")).first()[0] or 0
        number += 1
    result = placed[0]
    for more in placed[1:]:
        result = result.union(more)
    return result


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """All pieces of all texts with their sequence_id and the offset in it, gapless from 0.

    Null texts count as empty, ids may be null or repeat: each row is a document of its
    own. An empty table gives no rows. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    kept = f"{scratch_path(spark, 'pieces')}"
    token_pieces(docs, path, capacity, end_id, keep_ids).withColumn("key", F.monotonically_increasing_id()).write.parquet(kept)
    pieces = spark.read.parquet(kept)
    seqs = best_fit(pieces.select("key", F.col("length").cast("int").alias("size")), capacity)
    within = Window.partitionBy("sequence_id").orderBy(F.col("length").desc(), "key").rowsBetween(Window.unboundedPreceding, -1)
    return (
        pieces.join(seqs.select("key", F.col("seq").alias("sequence_id")), "key")
        .withColumn("offset", F.coalesce(F.sum("length").over(within), F.lit(0)))
        .drop("key")
    )


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path())
