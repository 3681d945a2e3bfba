"""Approximate nearest neighbours by balanced posting lists.

Centroids come from a balanced k-means over a bounded sample. They are searched by a
proximity graph held in memory. Every vector goes to the list of its nearest centroid and,
if it lies near a boundary, to the lists of others that are hardly farther. A query visits
the lists whose centroids the graph finds nearest: as many as hold the ids of a full result,
and then such as lie within a ratio of the last of these. One that does not get there visits
all lists. Distances are exact, in double precision. Vectors of each length are searched apart.

Equal vectors are one entry of a list with their smallest ids, as many as a result can
hold, so a vector that a third of all rows share does not fill a list. Long lists are
searched in parts of bounded size.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillmark.llm.blocks import stored

#: The sample that fits the centroids: at most so many vectors and values.
SAMPLE_ROWS, SAMPLE_VALUES = 20_000, 2_000_000
#: Vectors per list aimed at, most centroids, and rows of a list searched by one task.
LIST, MOST_CENTROIDS, PART = 128, 2048, 4096
#: Most lists that hold a vector, and how much farther than the nearest these may be.
COPIES, BOUNDARY = 4, 0.08
#: Most lists that a query visits unless it falls short, and their ratio to the last that fills a result.
PROBES, RATIO = 48, 1.5
DEGREE, BEAM = 24, 64
NEAREST = 10


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0)


def balanced_centroids(sample: np.ndarray, k: int, seed: int = 7, rounds: int = 12) -> np.ndarray:
    """k-means whose full clusters get dearer, so that sizes stay near each other."""
    rng = np.random.default_rng(seed)
    centroids = sample[rng.choice(len(sample), k, replace=False)]
    price = np.zeros(k)
    for _ in range(rounds):
        own = np.empty(len(sample), np.int64)
        scale = 0.0
        for low in range(0, len(sample), 2048):
            d = squared(sample[low : low + 2048], centroids)
            scale += d.min(1).sum()
            own[low : low + 2048] = (d + price).argmin(1)
        sizes = np.bincount(own, minlength=k)
        price += 0.3 * scale / len(sample) * (sizes * k / len(sample) - 1)
        price = np.maximum(price - price.min(), 0)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, sample)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], sample[rng.choice(len(sample), k)])
    return centroids


class Graph:
    """A proximity graph over the centroids: near neighbours and a few far ones of each."""

    def __init__(self, centroids: np.ndarray, seed: int = 11):
        self.centroids = centroids
        k = len(centroids)
        near = np.empty((k, min(DEGREE, k)), np.int64)
        for low in range(0, k, 1024):
            near[low : low + 1024] = np.argsort(squared(centroids[low : low + 1024], centroids), axis=1)[:, : near.shape[1]]
        far = np.random.default_rng(seed).integers(0, k, (k, 4))
        self.links = np.concatenate([near, far], axis=1)
        self.entries = np.unique(np.linspace(0, k - 1, min(k, 32)).astype(np.int64))

    def search(self, queries: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroids found for each query and their distances, nearest first."""
        rows = np.arange(len(queries))[:, None]
        beam, n = max(BEAM, n), min(n, len(self.centroids))
        seen = np.zeros((len(queries), len(self.centroids)), bool)
        seen[:, self.entries] = True
        ids = np.tile(self.entries, (len(queries), 1))
        dist = squared(queries, self.centroids[self.entries])
        done = np.zeros(ids.shape, bool)
        while True:
            order = np.argsort(dist, axis=1, kind="stable")[:, :beam]
            ids, dist, done = ids[rows, order], dist[rows, order], done[rows, order]
            open_ = np.where(done | np.isinf(dist), np.inf, dist)
            if np.isinf(open_.min(initial=np.inf)):
                break
            best = np.argsort(open_, axis=1, kind="stable")[:, :4]
            live = ~np.isinf(open_[rows, best])
            done[rows, best] |= live
            after = self.links[ids[rows, best]].reshape(len(queries), -1)
            fresh = np.repeat(live, self.links.shape[1], axis=1) & ~seen[rows, after]
            # Of a centroid that two links reach, one copy counts.
            sort = np.argsort(after, axis=1, kind="stable")
            ranked = after[rows, sort]
            twice = np.zeros(after.shape, bool)
            twice[rows, sort[:, 1:]] = (ranked[:, 1:] == ranked[:, :-1]) & np.take_along_axis(fresh, sort, 1)[:, :-1]
            fresh &= ~twice
            at = np.nonzero(fresh)
            seen[at[0], after[at]] = True
            gap = ((queries[:, None] - self.centroids[after]) ** 2).sum(2)
            ids = np.concatenate([ids, after], axis=1)
            dist = np.concatenate([dist, np.where(fresh, gap, np.inf)], axis=1)
            done = np.concatenate([done, np.zeros(after.shape, bool)], axis=1)
        return ids[:, :n], np.sqrt(dist[:, :n])


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): vectors in double precision that are neither null, zero nor hold null or non-finite values."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select("vec_id", v.alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    return rows.where(finite & F.exists("v", lambda x: x != 0))


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(v, ids): distinct vectors with their NEAREST + 1 smallest ids, first within partitions, then over all."""
    keyed = rows.withColumns({"part": F.spark_partition_id(), "key": F.xxhash64("v")})
    inside = Window.partitionBy("part", "key", "v").orderBy("vec_id")
    overall = Window.partitionBy("key", "v").orderBy("vec_id")
    first = keyed.withColumn("rank", F.row_number().over(inside)).where(F.col("rank") <= NEAREST + 1)
    kept = first.withColumn("rank", F.row_number().over(overall)).where(F.col("rank") <= NEAREST + 1)
    return kept.groupBy("key", "v").agg(F.array_sort(F.collect_set("vec_id")).alias("ids")).select("v", "ids")


def nearest(vectors: DataFrame, queries: DataFrame) -> DataFrame:
    """The NEAREST vectors found for each query: query_id, rank from 1, vec_id, score.

    Both tables have vec_id and embedding. A query does not find its own id. Ties go to
    smaller ids. A query is compared with vectors of its own length, and an id with vectors of
    several lengths is a query of each. Rows that repeat count once. Empty tables give no rows;
    other columns are not read.
    """
    spark = vectors.sparkSession
    rows, asked = usable(vectors), usable(queries).select(F.col("vec_id").alias("query_id"), "v").dropDuplicates()
    # One row per length.
    both = rows.select(F.size("v").alias("d")).distinct().join(asked.select(F.size("v").alias("d")).distinct(), "d")
    pairs = [pairs_of_length(rows, asked, r.d) for r in both.orderBy("d").collect()]
    if not pairs:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    once = reduce(DataFrame.unionByName, pairs).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= NEAREST).select("query_id", "rank", "vec_id", "score")


def pairs_of_length(rows: DataFrame, asked: DataFrame, d: int) -> DataFrame:
    """(query_id, vec_id, score): what each list visited by a query of length ``d`` has nearest to it."""
    distinct = stored(distinct_vectors(rows.where(F.size("v") == d)), "vectors")
    n = distinct.count()
    sample = distinct.orderBy(F.xxhash64("v"), F.col("ids")[0]).limit(max(1, min(SAMPLE_ROWS, SAMPLE_VALUES // d))).select("v").collect()
    sample = np.array([r.v for r in sample])
    k = max(1, min(MOST_CENTROIDS, -(-n // LIST), max(1, len(sample) // 8)))
    graph = Graph(balanced_centroids(sample, k))

    def dealt(column: int, most: int, visited):
        def run(batches):
            for batch in batches:
                for low in range(0, batch.num_rows, 512):
                    part = batch.slice(low, 512)
                    ids, dist = graph.search(part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, d), most)
                    at, own, slot = visited(ids, dist)
                    taken = part.take(pa.array(at))
                    columns = [pa.array(own, pa.int32()), pa.array(slot == 0), *taken.columns]
                    yield pa.RecordBatch.from_arrays(columns, ["list", "main", *part.schema.names])

        return run

    def near_boundary(ids: np.ndarray, dist: np.ndarray):
        at, slot = np.nonzero(dist <= (1 + BOUNDARY) * dist[:, :1] + 1e-12)
        return at, ids[at, slot], slot

    lists = stored(distinct.mapInArrow(dealt(0, COPIES, near_boundary), "list int, main boolean, v array<double>, ids array<long>"), "lists")
    # One row per centroid at most. Boundary copies do not count, so no id counts twice by its vector.
    held = np.zeros(k, np.int64)
    for r in lists.where("main").groupBy("list").agg(F.sum(F.size("ids")).alias("n")).collect():
        held[r.list] = r.n
    filled = np.array(sorted(r.list for r in lists.select("list").distinct().collect()), np.int64)

    def enough(ids: np.ndarray, dist: np.ndarray):
        have = np.cumsum(np.where(np.isinf(dist), 0, held[ids]), axis=1) > NEAREST
        full, last = have.any(1), have.argmax(1)
        reach = np.where(full, dist[np.arange(len(ids)), last], -1.0)
        at, slot = np.nonzero((dist <= RATIO * reach[:, None] + 1e-12) & full[:, None])
        short = np.flatnonzero(~full)
        every = np.repeat(short, len(filled))
        return np.concatenate([at, every]), np.concatenate([ids[at, slot], np.tile(filled, len(short))]), np.concatenate([slot, np.zeros(len(every), np.int64)])

    probes = asked.where(F.size("v") == d).mapInArrow(dealt(1, PROBES, enough), "list int, main boolean, query_id long, v array<double>")
    # One row per centroid at most.
    parts = stored(lists.groupBy("list").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts")), "parts")
    left = lists.join(F.broadcast(parts), "list").select("list", F.pmod(F.xxhash64("v"), "parts").cast("int").alias("part"), "v", "ids")
    others = parts.select(F.col("list").alias("at"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("place"))
    right = probes.join(F.broadcast(others), F.col("list") == F.col("at")).select("list", F.col("place").alias("part"), "query_id", "v")

    def closest(list_: pa.Table, queries_: pa.Table) -> pa.Table:
        found = []
        if list_.num_rows and queries_.num_rows:
            v, ids = np.array(list_.column("v").to_pylist()), list_.column("ids").to_pylist()
            for query_id, q in zip(queries_.column("query_id").to_pylist(), np.array(queries_.column("v").to_pylist())):
                score = np.sqrt(((v - q) ** 2).sum(1))
                # Entries up to the distance of the one that fills the result; its own entry may be the query alone.
                cut = np.partition(score, min(NEAREST, len(score) - 1))[min(NEAREST, len(score) - 1)]
                best = [(float(score[i]), x) for i in np.flatnonzero(score <= cut).tolist() for x in ids[i] if x != query_id]
                found += [(query_id, x, s) for s, x in sorted(best)[:NEAREST]]
        a, b, c = zip(*found) if found else ((), (), ())
        return pa.table({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(c, pa.float64())})

    return left.groupBy("list", "part").cogroup(right.groupBy("list", "part")).applyInArrow(closest, "query_id long, vec_id long, score double")


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, vectors.where("vec_id % 100 = 0"))
