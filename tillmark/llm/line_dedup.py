"""Line dedup by an exact set-similarity join; of similar lines the first stays.

The tokens of a line are its distinct runs of five words (all words of a shorter line), A
to Z in lower case. A line goes if an earlier line, by doc_id and line number, has a token
set with a Jaccard similarity of 0.8 or more. Lines are judged on the input. Every line
with a word takes part; one of fewer than five words goes if an earlier one has the same words.

Lines that may be similar are brought together by :mod:`tillmark.llm.set_join`. A task
orders the tokens of its sets by rarity and indexes only the rare front that two similar
sets must share a token of. A pair that meets there has to pass the length filter and
the positional filter, what is left of both sets after the shared token, before its
Jaccard similarity is verified.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Container, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm import set_join
from tillmark.llm.blocks import Block, fresh_name, over_blocks, store_blocks, stored, unpacked
from tillmark.llm.set_join import PERCENT, Index, least_overlap, linked, token_sets

def lines(block: Block, only: Container | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lines with a word: document, number, tokens and where they begin. Others have no tokens to compare."""
    places, numbers, texts = [], [], []
    for place, text in enumerate(block.texts()):
        split = text.split(b"\n")
        wanted = range(len(split)) if only is None else [number for number in range(len(split)) if (place, number) in only]
        places += [place] * len(wanted)
        numbers += wanted
        texts += split if only is None else [split[number] for number in wanted]
    tokens, starts = token_sets(texts)
    having = np.diff(starts) > 0
    return np.array(places, np.int64)[having], np.array(numbers, np.int64)[having], tokens, np.append(starts[:-1][having], len(tokens))


def pair_overlap(n: int, m: int) -> int:
    """The least overlap of linked sets of n and m tokens."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def later_of_similar(leader: int, left: list[tuple], right: list[tuple] | None) -> Iterator[tuple[int]]:
    """Nodes whose first line comes after the first line of a similar node."""
    sets = left if right is None else left + right
    index = Index(sets)
    gone: set[int] = set()
    lists: dict[int, list[tuple[int, int]]] = defaultdict(list)
    ordered = []
    for _, _, n, tokens, _ in sets:
        low, high = index.lists(tokens)
        ordered.append(tokens[np.lexsort((tokens, high - low))])
    # Short sets first, so that an indexed set is never longer than the query.
    for q in sorted(range(len(sets)), key=lambda k: (sets[k][2], sets[k][0])):
        node, first, n, tokens, _ = sets[q]
        front = ordered[q][: n - least_overlap(n) + 1].tolist()
        met: dict[int, bool] = {}
        for i, token in enumerate(front):
            for c, j in lists[token]:
                m = sets[c][2]
                if c in met or 100 * m < PERCENT * n:
                    continue
                # The first token both share in this order: all others come after it.
                met[c] = 1 + min(n - i - 1, m - j - 1) >= pair_overlap(n, m)
            lists[token].append((q, i))
        for c, possible in met.items():
            other, earlier, m, having, _ = sets[c]
            late = node if (first, node) > (earlier, other) else other
            if not possible or late in gone or (right is not None and (c < len(left)) == (q < len(left))):
                continue
            at = np.minimum(np.searchsorted(having, tokens), m - 1)
            if linked(int((having[at] == tokens).sum()), n, m):
                gone.add(late)
                yield (late,)


def removed_lines(blocks: DataFrame) -> DataFrame:
    """The lines of stored blocks to remove: block, place (of the document) and line, from 0.

    Lines end at line feeds. Ties in doc_id go by the place of the row in the stored
    blocks; null ids come last. Null and empty texts have no line that counts.
    """
    rows = set_join.items_with_partners(blocks, lines, alone=False)
    at = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "block", "place", "line")
    nodes = rows.groupBy("node").agg(F.min(at).alias("at"))
    nodes = stored(nodes, "nodes")
    # Places of first lines in order, as one number that keeps their order.
    ranked = ordinals(nodes)
    later = set_join.compared(blocks, lines, nodes.join(ranked, "node").select("node", "first", "at.block", "at.place", "at.line"), later_of_similar, "late long").distinct()
    verdict = nodes.select("node", "at").join(later, F.col("node") == F.col("late"), "left")
    verdict = stored(verdict.select(F.col("node").alias("of"), "at", F.col("late").isNotNull().alias("all")), "verdicts")
    joined = rows.select("block", "place", "line", "node").join(verdict, F.col("node") == F.col("of"))
    first = (F.col("block") == F.col("at.block")) & (F.col("place") == F.col("at.place")) & (F.col("line") == F.col("at.line"))
    return joined.where(F.col("all") | ~first).select("block", "place", "line")


def ordinals(nodes: DataFrame) -> DataFrame:
    """(node, first): numbers in the order of ``at``, by ranges."""
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Columns of their own compare faster than a struct.
    plain = nodes.select("node", "at.*")
    order = [*(c for c in plain.columns if c != "node"), "node"]
    sorted_ = plain.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    return stored(sorted_.select("node", F.monotonically_increasing_id().alias("first")), "order")


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """Each document's doc_id, n_lines, the numbers of its ``removed`` lines, and its ``text`` without them.

    A long column ``row`` of ``docs``, where there is one, comes along.

    One row comes out per row; a document that loses all lines keeps an empty text. An
    empty table gives none. Other columns are not read.
    """
    blocks = store_blocks(docs)

    def cut(block: Block, _: bytes, state: bytes) -> Iterator[pa.Table]:
        gone: dict[int, list[int]] = defaultdict(list)
        for place, line in zip(*map(np.ndarray.tolist, unpacked(state))) if state else ():
            gone[place].append(line)
        kept, n_lines = list(block.texts()), []
        for place, text in enumerate(kept):
            n_lines.append(text.count(b"\n") + 1)
            if place in gone:
                removed = set(gone[place])
                kept[place] = b"\n".join([line for number, line in enumerate(text.split(b"\n")) if number not in removed])
        yield pa.table({
            "doc_id": pa.array(block.ids, pa.int64(), mask=~block.known), "row": block.rows, "n_lines": n_lines,
            "removed": pa.array([gone.get(place, []) for place in range(len(kept))], pa.list_(pa.int32())), "text": pa.array(kept, pa.binary()),
        })

    # The numbers of lines go to the texts, which lie in their blocks already.
    return over_blocks(blocks, cut, "doc_id long, row long, n_lines int, removed array<int>, text string", set_join.noted(removed_lines(blocks), []))


def with_lines_removed(docs: DataFrame) -> DataFrame:
    """``docs`` with texts that have lost their repeated lines; rows that lose all of their text go.

    Null texts stay, ids may repeat or be null (see :func:`removed_lines`), an empty table gives none. All
    columns come out as they are, but for ``n_chars``, which follows the text.
    """
    row = fresh_name(docs.columns, "row_of_line")
    rest = fresh_name(docs.columns, "rest_of_text")
    marked = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = without_repeated_lines(marked.select("doc_id", "text", F.col(row).alias("row"))).where(F.size("removed") > 0)
    cut = found.select(F.col("row").alias(row), F.col("text").alias(rest))
    joined = marked.join(cut, row, "left").where(F.col(rest).isNull() | (F.trim(rest) != ""))
    changed = {"text": F.coalesce(rest, "text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col(rest).isNull(), F.col("n_chars")).otherwise(F.char_length(rest))
    return joined.select(*(changed[c].cast(docs.schema[c].dataType).alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeated_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.size("removed").cast("long").alias("n_removed"), F.sha2("text", 256).alias("kept_sha256"))
