"""Phrase collocations by dynamic itemset counting.

Texts become blocks of word places, dealt into SHARDS shards. One step scans one shard, in
turn, and counts phrases of every length that are active there: words from the first step
on, a longer phrase from the step after both phrases that it consists of but for one end
word have reached LEAST. Each phrase is counted for one full cycle of shards, wherever it began,
so its count is exact; lengths overlap, and the whole takes fewer scans than one cycle after another.

Which phrases have reached LEAST, and at which step, lies in a table of SLOTS bytes, one per
hash slot, that every task gets. Its size never changes. Two phrases in one slot share
the earlier step, which can only start a phrase too early: it costs a count, and changes none,
since every block of a step sees the same table and a slot that is set stays as it is.
Counts themselves are a distributed table, merged by key.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillmark.llm.blocks import mix64, stored
from tillmark.sources.scratch import drop_scratch, scratch_path

#: Longest phrases, least occurrences, shards of a cycle, phrases returned per language.
LONGEST, LEAST, SHARDS, RETURNED = 4, 30, 4, 2000
#: Bytes of the table of steps, and the byte of a free slot.
SLOTS, FREE = 1 << 24, 255
#: Text of a block, and how much of all languages a task holds before it writes them out.
BLOCK_BYTES, HELD_BYTES = 1 << 20, 1 << 23

U64 = np.uint64
_STEP = U64(0x9E3779B97F4A7C15)
#: Lower case for A to Z, one break for every separator, one blank for both blanks.
_PLAIN = bytes(10 if b in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))

BLOCK = "block long, lang string, n long, places binary, hashes binary, vocabulary binary"


def places_of(texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """The words of plain texts as places in a vocabulary, -1 between pieces, and the vocabulary."""
    pieces = pa.array([piece for text in texts for piece in text.split(b"\n") if piece], pa.large_binary())
    lists = pc.split_pattern(pieces, pattern=" ")
    of = np.repeat(np.arange(len(pieces)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    words = pc.list_flatten(lists)
    real = pc.greater(pc.binary_length(words), 0)
    of, coded = of[real.to_numpy(zero_copy_only=False)], words.filter(real).dictionary_encode()
    breaks = np.cumsum(np.append(0, np.diff(of) != 0)) if len(of) else of
    places = np.full(len(of) + (int(breaks[-1]) if len(of) else 0), -1, np.int32)
    places[np.arange(len(of)) + breaks] = coded.indices.to_numpy()
    return places, coded.dictionary.to_pylist()


def word_blocks(docs: DataFrame) -> DataFrame:
    """The texts of a table (lang, text) as stored blocks of one language each, in shards."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, serial = TaskContext.get().partitionId(), 0
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def flush(lang: str) -> pa.RecordBatch:
            nonlocal serial
            places, vocabulary = places_of(held.pop(lang))
            sizes.pop(lang)
            seed = xxhash.xxh3_64_intdigest(lang.encode())
            hashes = np.array([xxhash.xxh3_64_intdigest(word, seed) for word in vocabulary], U64)
            serial += 1
            row = {
                "block": (part << 32) + serial, "lang": lang, "n": int((places >= 0).sum()), "places": places.tobytes(),
                "hashes": hashes.tobytes(), "vocabulary": b"\n".join(vocabulary),
            }
            kinds = [("block", pa.int64()), ("lang", pa.string()), ("n", pa.int64()), *((c, pa.binary()) for c in ("places", "hashes", "vocabulary"))]
            return pa.RecordBatch.from_pylist([row], schema=pa.schema(kinds))

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist()):
                text, at = (text or b"").translate(_PLAIN), 0
                while at < len(text):
                    # No phrase crosses a break, so a long text may go on in the next block there.
                    end = text.find(b"\n", at + BLOCK_BYTES) if len(text) - at > BLOCK_BYTES else -1
                    some, at = (text[at:], len(text)) if end < 0 else (text[at:end], end + 1)
                    held.setdefault(lang, []).append(some)
                    sizes[lang] = sizes.get(lang, 0) + len(some)
                    if sizes[lang] >= BLOCK_BYTES:
                        yield flush(lang)
                if sum(sizes.values()) >= HELD_BYTES:
                    yield flush(max(sizes, key=sizes.get))
        for lang in list(held):
            yield flush(lang)

    path = scratch_path(docs.sparkSession, "phrase-blocks")
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(gather, BLOCK)
    rows.withColumn("shard", F.pmod(F.xxhash64("block"), F.lit(SHARDS)).cast("int")).write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(f"{BLOCK}, shard int").parquet(path)


def phrase_keys(places: np.ndarray, hashes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length from 1 the keys of the phrases from each place on, and whether there is such a phrase."""
    if not len(places):
        return [(np.zeros(0, U64), np.zeros(0, bool))] * LONGEST
    words, real = hashes[places], places >= 0
    keys, there = mix64(words + _STEP), real
    found = [(keys, there)]
    for k in range(2, LONGEST + 1):
        n = max(0, len(places) - k + 1)
        keys, there = mix64(keys[:n] * _STEP + words[len(words) - n :]), there[:n] & real[len(real) - n :]
        found.append((keys, there))
    return found


def active(keys: list[tuple[np.ndarray, np.ndarray]], reached: np.ndarray, step: int, shards: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, keys, first steps) of the phrases of a block that are counted in a step."""
    steps = None
    for k, (own, there) in enumerate(keys, 1):
        if k == 1:
            first = np.zeros(len(own), np.int64)
        else:
            n = len(own)
            first = np.maximum(steps[:n], steps[1 : n + 1]) + 1
            there = there & (first <= step)
        counted = there & (step < first + shards)
        yield k, own[counted], first[counted]
        if k < LONGEST:
            # Another phrase in the slot may have set it before this one was active.
            steps = np.where(there, np.maximum(reached[(own & U64(len(reached) - 1)).astype(np.int64)], first), FREE)


DELTA = "key long, k int, n long, first int, at long"


def scanned(shard: DataFrame, table: Broadcast, step: int) -> DataFrame:
    """Counts of the active phrases of each block of a shard; ``table`` is the packed table of steps, ``at`` the block."""
    shards = SHARDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.frombuffer(zlib.decompress(table.value), np.uint8)
        for batch in batches:
            for row in batch.to_pylist():
                keys = phrase_keys(np.frombuffer(row["places"], np.int32), np.frombuffer(row["hashes"], U64))
                for k, some, first in active(keys, own, step, shards):
                    distinct, at, n = np.unique(some, return_index=True, return_counts=True)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(distinct.view(np.int64)), pa.array(np.full(len(n), k, np.int32)), pa.array(n.astype(np.int64)),
                        pa.array(first[at].astype(np.int32)), pa.array(np.full(len(n), row["block"], np.int64)),
                    ], ["key", "k", "n", "first", "at"])

    return shard.select("block", "places", "hashes").mapInArrow(run, DELTA)


STATE = f"{DELTA}, reached int, done boolean"


def frequent_phrases(blocks: DataFrame) -> DataFrame:
    """(key, k, n, at) of every phrase with LEAST occurrences or more; ``at`` is a block that holds it."""
    spark = blocks.sparkSession
    reached = np.full(SLOTS, FREE, np.uint8)
    state = spark.createDataFrame([], STATE)
    finished, last_new, step = [], -1, 0
    before = None
    while step < max(SHARDS, last_new + SHARDS + 1):
        # Free slots pack to nothing.
        table = spark.sparkContext.broadcast(zlib.compress(reached.tobytes(), 1))
        delta = scanned(blocks.where(F.col("shard") == step % SHARDS), table, step)
        both = state.drop("done").unionByName(delta, allowMissingColumns=True)
        merged = both.groupBy("key", "k").agg(
            F.sum("n").alias("n"), F.min("first").alias("first"), F.min("at").alias("at"), F.min("reached").alias("reached")
        )
        merged = merged.withColumns({
            "reached": F.coalesce("reached", F.when(F.col("n") >= LEAST, step)), "done": F.col("first") + SHARDS - 1 <= step,
        }).where(f"NOT done OR n >= {LEAST}")
        path = scratch_path(spark, f"phrases-{step}")
        merged.write.partitionBy("done").parquet(path)
        table.destroy()
        now = spark.read.schema(STATE).parquet(path)
        finished.append(now.where("done"))
        state = now.where("NOT done")
        if before:
            drop_scratch(spark, f"{before}/done=false")
        before = path
        # One byte per slot at most, whatever the number of phrases.
        some = now.where((F.col("reached") == step) & (F.col("k") < LONGEST)).select(F.col("key").bitwiseAND(F.lit(SLOTS - 1)).cast("int").alias("slot"))
        fresh = some.distinct().toArrow().column("slot").to_numpy()
        if len(fresh):
            last_new = step
            reached[fresh] = np.minimum(reached[fresh], step)
        step += 1
    result = finished[0]
    for more in finished[1:]:
        result = result.unionByName(more)
    return result.select("key", "k", "n", "at")


def phrase_texts(blocks: DataFrame, phrases: DataFrame) -> DataFrame:
    """(key, lang, phrase, cuts, inner) of phrases of two words or more: the keys of the parts of
    every cut, and of the shorter phrases of two words or more inside."""
    asked = phrases.where("k > 1").groupBy("at").agg(F.collect_list("key").alias("keys"))
    schema = "key long, lang string, phrase string, cuts array<struct<cut:int,left:long,right:long>>, inner array<long>"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                places, vocabulary = np.frombuffer(row["places"], np.int32), row["vocabulary"].split(b"\n")
                keys = phrase_keys(places, np.frombuffer(row["hashes"], U64))
                signed = [own.view(np.int64) for own, _ in keys]
                wanted, found = np.array(row["keys"], np.int64), []
                for k in range(2, LONGEST + 1):
                    at = np.flatnonzero(keys[k - 1][1] & np.isin(signed[k - 1], wanted))
                    for i in at[np.unique(signed[k - 1][at], return_index=True)[1]].tolist():
                        found.append({
                            "key": int(signed[k - 1][i]), "lang": row["lang"], "phrase": b" ".join(vocabulary[p] for p in places[i : i + k]).decode(),
                            "cuts": [{"cut": j, "left": int(signed[j - 1][i]), "right": int(signed[k - j - 1][i + j])} for j in range(1, k)],
                            "inner": [int(signed[m - 1][i + j]) for m in range(2, k) for j in range(k - m + 1)],
                        })
                cut = pa.struct([("cut", pa.int32()), ("left", pa.int64()), ("right", pa.int64())])
                kinds = pa.schema([("key", pa.int64()), ("lang", pa.string()), ("phrase", pa.string()), ("cuts", pa.list_(cut)), ("inner", pa.list_(pa.int64()))])
                yield pa.RecordBatch.from_pylist(found, schema=kinds)

    joined = blocks.join(asked, F.col("block") == F.col("at"))
    return stored(joined.select("lang", "places", "hashes", "vocabulary", "keys").mapInArrow(read, schema), "phrase-texts")


def collocations(docs: DataFrame) -> DataFrame:
    """Each language's RETURNED best phrases: lang, rank, phrase, a, l, r, n, score.

    ``docs`` has lang and text. A null language is ``und``, together with rows that say so. Null and
    empty texts hold no words, and repeated rows count as often as they come. A language
    without a phrase that is frequent enough has no row, and neither has an empty table. Ties
    go as the order says: score, a, then the bytes of the phrase. Other columns are not read.
    """
    blocks = word_blocks(docs)
    counts = stored(frequent_phrases(blocks), "phrases")
    texts = phrase_texts(blocks, counts)
    of = lambda name, value: counts.select(F.col("key").alias(name), F.col("n").alias(value))
    exact = lambda column: F.col(column).cast("decimal(20,0)")

    cuts = texts.join(of("key", "a"), "key").select("key", "a", F.inline("cuts"))
    cuts = cuts.join(of("left", "l"), "left").join(of("right", "r"), "right")
    cuts = cuts.withColumn("score", F.expr("(CAST(a AS decimal(20,0)) * 2000000BD) DIV (CAST(l AS decimal(20,0)) + CAST(r AS decimal(20,0)))"))
    # Of the lowest score the shortest first part.
    scored = cuts.groupBy("key").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"), F.first("a").alias("a")).select("key", "a", "best.score", "best.l", "best.r")
    longer = texts.join(of("key", "m"), "key").select(F.explode("inner").alias("key"), "m").groupBy("key").agg(F.max("m").alias("m"))
    kept = scored.join(longer, "key", "left").where(F.col("m").isNull() | (exact("m") * 100 < exact("a") * 80)).drop("m")
    kept = kept.join(texts.select("key", "lang", "phrase"), "key")

    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First among parts of a language, so that no task gets a language whole.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = kept.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)))
    first = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))).where(F.col("rank") <= RETURNED)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= RETURNED)
    # One row per language.
    words = blocks.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH pieces AS (
    SELECT COALESCE(lang, 'und') AS lang,
           unnest(string_split_regex(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), placed AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded
), phrases AS (
    SELECT lang, k, list_slice(w, i, i + k - 1) AS p, count(*)::HUGEINT AS f
    FROM placed, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL
), words AS (
    SELECT lang, sum(len(w))::HUGEINT AS n FROM worded GROUP BY lang
), frequent AS (
    SELECT * FROM phrases WHERE f >= 30
), cuts AS (
    SELECT lang, k, p, f AS a, unnest(range(1, k)) AS c FROM frequent WHERE k > 1
), scores AS (
    SELECT x.lang, x.k, x.p, x.a, x.c, y.f AS l, z.f AS r, (2000000::HUGEINT * x.a) // (y.f + z.f) AS score
    FROM cuts x JOIN frequent y ON y.lang = x.lang AND y.p = list_slice(x.p, 1, x.c)
    JOIN frequent z ON z.lang = x.lang AND z.p = list_slice(x.p, x.c + 1, x.k)
), lowest AS (
    SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, c) = 1
), inside AS (
    SELECT lang, list_slice(p, j, j + size - 1) AS p, max(f) AS m
    FROM (SELECT lang, p, k, f, unnest(range(2, k)) AS size FROM frequent WHERE k > 2), (SELECT unnest([1, 2, 3]) AS j)
    WHERE j + size - 1 <= k GROUP BY 1, 2
), kept AS (
    SELECT x.*, array_to_string(x.p, ' ') AS phrase FROM lowest x
    LEFT JOIN inside y ON y.lang = x.lang AND y.p = x.p
    WHERE y.m IS NULL OR 100 * y.m < 80 * x.a
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT r.lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r.r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked r JOIN words USING (lang) WHERE rank <= 2000
"""
