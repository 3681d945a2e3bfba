"""N-gram Jaccard join of documents by T-occurrence search with DivideSkip.

Documents that may have partners are brought together by :mod:`tillmark.llm.set_join`. A task
keeps inverted lists of its sets. A query needs T of its tokens in a partner; it sets the
longest lists aside, merges the short ones, keeps sets that occur there often enough, and
probes the long lists for these, by binary search where they are few. All links count, also
those inside a group that is connected already; what leaves a task is the number of links
of each set and as many links as connect its groups.
"""

from __future__ import annotations

import math
from collections.abc import Container, Iterator
from functools import partial

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm import set_join
from tillmark.llm.blocks import Block, fresh_name, store_blocks, stored
from tillmark.llm.set_join import Index, least_overlap, linked, token_sets

#: Weight of the list lengths in the choice of the number of long lists.
MU = 0.05


def documents(block: Block, only: Container | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    places = [place for place in range(len(block)) if only is None or (place, 0) in only]
    tokens, starts = token_sets([block.data[block.starts[place] : block.starts[place + 1]] for place in places])
    return np.array(places, np.int64), np.zeros(len(places), np.int64), tokens, starts


def links(leader: int, left: list[tuple], right: list[tuple] | None, counted: bool = True) -> Iterator[tuple[int, int, int]]:
    """Links (a, b, 0) that connect all sets that are linked, inside ``left`` or between it and
    ``right``, and the documents (a, a, n) that each set is linked with.

    The second value of a set is its number of documents. A link counts around the first leader
    that both have in common. Without ``counted`` links that cannot change the groups need no
    probe, and only links come out.
    """
    index = Index(left)
    queries = left if right is None else right
    every = left if right is None else left + right
    root = list(range(len(every)))
    lengths = np.array([s[2] for s in left], np.int64)
    copies = np.array([s[1] for s in left], np.int64)
    total = np.zeros(len(every), np.int64)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def merged(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        owners = [index.owners[i:j] for i, j in zip(low.tolist(), high.tolist()) if j > i]
        return np.bincount(np.concatenate([*owners, np.zeros(0, np.int64)]), minlength=len(left))

    for q, (node, own_copies, n, tokens, leaders) in enumerate(queries):
        own = q if right is None else len(left) + q
        low, high = index.lists(tokens)
        size = high - low
        need = least_overlap(n)
        longest = int(size.max(initial=0))
        n_long = min(need - 1, int(need / (MU * math.log2(longest + 2) + 1)))
        order = np.argsort(size, kind="stable")
        short, long = order[: n - n_long], order[n - n_long :]
        seen = merged(low[short], high[short])
        sets = np.flatnonzero(seen >= need - n_long)
        m = lengths[sets]
        sets = sets[np.minimum(n, m) * 100 >= set_join.PERCENT * np.maximum(n, m)]
        if right is None:
            sets = sets[sets < q]
        if not counted:
            sets = np.array([c for c in sets.tolist() if find(c) != find(own)], np.int64)
        seen = seen[sets]
        if len(sets) > n_long:
            seen = seen + merged(low[long], high[long])[sets]
        else:
            rest = tokens[long]
            for k, c in enumerate(sets.tolist()):
                having = left[c][3]
                seen[k] += (having[np.minimum(np.searchsorted(having, rest), len(having) - 1)] == rest).sum()
        partners = sets[linked(seen, n, lengths[sets])]
        if counted:
            earlier = {at for at in leaders if at < leader}
            new = partners if not earlier else np.array([c for c in partners.tolist() if earlier.isdisjoint(left[c][4])], np.int64)
            total[new] += own_copies
            total[own] += copies[new].sum()
        for c in partners.tolist():
            if find(c) != find(own):
                root[find(own)] = find(c)
                yield node, left[c][0], 0
    if counted:
        for k in np.flatnonzero(total).tolist():
            yield every[k][0], every[k][0], int(total[k])


def near_documents(docs: DataFrame, counted: bool = True) -> DataFrame:
    """Each document's doc_id, n_shingles, component_id and n_links, the number of other documents
    it is linked with, with its component (null where it has no possible partner) and, if
    ``docs`` has a long column ``row``, that. Without ``counted`` n_links is null.

    A null text and one without words have no shingle and no link. Repeated rows are rows
    of their own with one result. Null ids are never the smallest id of a component, and a
    document whose component has no other id keeps its own. Other columns are not read.
    """
    blocks = store_blocks(docs)
    items = set_join.items_with_partners(blocks, documents)
    nodes = items.where("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("copies"), F.min(F.struct("block", "place", "line")).alias("at")
    ).select("node", "first", "copies", "at.*")
    nodes = stored(nodes, "nodes")
    found = set_join.compared(blocks, documents, nodes.withColumn("first", F.col("copies")), partial(links, counted=counted), "a long, b long, n long")
    others = found.where("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    linked_with = F.col("copies") - 1 + F.coalesce("others", F.lit(0)) if counted else F.lit(None).cast("long")
    joined = nodes.select("node", "first", "copies").join(others, "node", "left").withColumn("n_links", linked_with)
    joined = joined.select("node", "first", "n_links").join(set_join.components(found), "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = joined.groupBy("component").agg(F.min("first").alias("component_id"))
    per_node = stored(joined.select("node", "component", "n_links").join(names, "component").select(F.col("node").alias("of"), "component", "component_id", "n_links"), "components")
    rows = items.select("doc_id", "row", "n", "node")
    alone = rows.where("node IS NULL").withColumns({"component": F.lit(None).cast("long"), "component_id": F.col("doc_id"), "n_links": F.lit(0 if counted else None).cast("long")})
    with_node = rows.where("node IS NOT NULL").join(per_node, F.col("node") == F.col("of"), "left").drop("of")
    result = alone.unionByName(with_node)
    return result.select("doc_id", "row", F.col("n").cast("long").alias("n_shingles"), "component", F.coalesce("component_id", "doc_id").alias("component_id"), "n_links")


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """``docs`` without near copies: of each component the row with the smallest id stays, null ids last.

    Null texts, empty ones and those without words stay. Of rows that repeat one stays. All columns come out as they are.
    """
    row = fresh_name(docs.columns, "row_of_group")
    marked = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = stored(near_documents(marked.select("doc_id", "text", F.col(row).alias("row")), counted=False), "groups").where("component IS NOT NULL")
    first = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
    copies = found.join(first, "component").where(F.col("row") != F.col("first.row")).select(F.col("row").alias(row))
    return marked.join(copies, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_documents(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_shingles", "component_id", "n_links")
