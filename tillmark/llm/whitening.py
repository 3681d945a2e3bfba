"""Embedding whitening by Chebyshev-filtered subspace iteration.

Distinct vectors are stored once as blocks of integers. Every step of the polynomial
recurrence is one distributed pass that sums centred XᵀXQ over the blocks; what comes back
is as large as Q, a matrix of one row per dimension and BASIS columns. The recurrence
damps the spectrum below the smallest Ritz value, QR and Rayleigh-Ritz on the small matrix
turn the basis, and rounds go on until every wanted pair is certified: its residual is at
rounding level, and a fresh random block, filtered the same way beside the basis, holds
no direction of more variance.

Vectors of each length are a table of their own: own list, own components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.blocks import stored

#: Components returned, columns of the basis, and columns of the random block that looks for missed directions.
COMPONENTS, BASIS, PROBES = 16, 32, 4
#: Degree of the polynomial of a round, and most rounds.
DEGREE, ROUNDS = 10, 60
#: A residual, as a share of the largest eigenvalue, that counts as rounding; the largest one a result may have.
ROUNDING, LARGEST = 2e-14, 1e-11
#: Eigenvalues below this share of the largest are zero: their directions have no variance to scale.
ZERO = 1e-13
#: Values of a block, and the integers that entries stop at.
BLOCK_VALUES, STOP = 1 << 17, 1 << 52


def integers(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and integer vectors of the usable vectors of a list array, one pair per length and share of rows."""
    known = pc.is_valid(vectors).to_numpy(zero_copy_only=False)
    sizes = np.where(known, pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False), 0).astype(np.int64)
    values = pc.cast(pc.list_flatten(vectors), pa.float64()).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    broken = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    usable = known & (sizes > 0) & (broken[starts[1:]] == broken[starts[:-1]])
    for d in np.unique(sizes[usable]).tolist():
        rows = np.flatnonzero(usable & (sizes == d))
        step = max(1, BLOCK_VALUES // d)
        for low in range(0, len(rows), step):
            some = rows[low : low + step]
            with np.errstate(over="ignore"):
                x = np.floor(64 * values[starts[some][:, None] + np.arange(d)])
            yield some, np.clip(x, -STOP, STOP).astype(np.int64) + 1_000_000


def fit_blocks(vectors: DataFrame) -> DataFrame:
    """(d, n, data): the distinct integer vectors of the table ``vectors`` (embedding), stored in blocks."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in integers(batch.column(0)):
                yield pa.record_batch({"x": pa.array([row.tobytes() for row in x], pa.binary())})

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}

        def flush(size: int) -> pa.RecordBatch:
            rows = held.pop(size)
            return pa.record_batch({"d": pa.array([size // 8], pa.int32()), "n": pa.array([len(rows)], pa.int64()), "data": pa.array([b"".join(rows)], pa.binary())})

        for batch in batches:
            for row in batch.column(0).to_pylist():
                own = held.setdefault(len(row), [])
                own.append(row)
                if len(own) * len(row) >= 8 * BLOCK_VALUES:
                    yield flush(len(row))
        for size in list(held):
            yield flush(size)

    distinct = vectors.select("embedding").mapInArrow(read, "x binary").distinct()
    return stored(distinct.mapInArrow(gather, "d int, n long, data binary"), "whitening-blocks")


def summed(blocks: DataFrame, make: Callable[[np.ndarray], np.ndarray], kind: type = np.float64) -> dict[int, np.ndarray]:
    """By vector length, the sum over all blocks of ``make(x)``, an array of one shape per length.

    Tasks add their blocks up; entry by entry Spark adds up tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = make(np.frombuffer(data, np.int64).reshape(-1, d)).ravel()
                total[d] = total[d] + part if d in total else part
        for d, part in total.items():
            yield pa.record_batch({"d": pa.array(np.full(len(part), d, np.int32)), "entry": pa.array(np.arange(len(part), dtype=np.int32)), "value": pa.array(part.astype(kind))})

    schema = f"d int, entry int, value {'long' if kind is np.int64 else 'double'}"
    sums = blocks.select("d", "data").mapInArrow(run, schema).groupBy("d", "entry").agg(F.sum("value").alias("value")).toArrow()
    found: dict[int, np.ndarray] = {}
    lengths, entries, values = (sums.column(c).to_numpy() for c in ("d", "entry", "value"))
    for d in np.unique(lengths).tolist():
        found[d] = np.empty((lengths == d).sum(), kind)
        found[d][entries[lengths == d]] = values[lengths == d]
    return found


class Centre:
    """The number of vectors of a length, their exact sums, and the mean as an integer and a fraction."""

    def __init__(self, sums: np.ndarray):
        parts = sums.reshape(-1, 2).tolist()
        self.n = int(parts[-1][0])
        self.sums = [(high << 32) + low for high, low in parts[:-1]]
        self.whole = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = np.array([s % self.n for s in self.sums], object)
        self.fraction = np.array([s % self.n / self.n for s in self.sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.fraction

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum of (n * x - S)^2 of each vector; None where a long can't hold it."""
        gap = x - self.whole
        most = (int(np.abs(gap).max(initial=0)) + 1) * self.n
        if most * most * x.shape[1] < 1 << 62:
            return ((self.n * gap - self.rest.astype(np.int64)) ** 2).sum(1).tolist()
        exact = [int(v) for v in ((self.n * gap.astype(object) - self.rest) ** 2).sum(1)]
        return [v if v < 1 << 63 else None for v in exact]


def counted(x: np.ndarray) -> np.ndarray:
    """Sums of the high and the low halves of each dimension, and the number of vectors."""
    return np.concatenate([np.column_stack([(x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)]), [[len(x), 0]]])


class Subspace:
    """The basis of one vector length, and what is known of the spectrum."""

    def __init__(self, d: int, variance: float):
        self.d, self.trace = d, variance
        self.wanted = min(COMPONENTS, d)
        self.random = np.random.default_rng(d)
        self.basis = np.linalg.qr(self.random.standard_normal((d, min(BASIS, d))))[0]
        self.values = np.zeros(self.basis.shape[1])
        self.worst, self.stuck, self.done = np.inf, 0, False
        self.searched = self.basis.shape[1] == d

    def turn(self, image: np.ndarray) -> None:
        """Rayleigh-Ritz of the basis with its image under the covariance."""
        values, turn = np.linalg.eigh((self.basis.T @ image + image.T @ self.basis) / 2)
        order = np.argsort(-values)
        self.basis, image, self.values = self.basis @ turn[:, order], image @ turn[:, order], values[order]
        gaps = np.linalg.norm(image - self.basis * self.values, axis=0)[: self.wanted]
        worst = float(gaps.max()) / self.values[0] if self.values[0] > 0 else 0.0
        # Near rounding level a residual no longer falls; it counts once two rounds bring nothing.
        self.stuck = self.stuck + 1 if worst > self.worst / 2 else 0
        self.worst = min(self.worst, worst)
        self.done = worst <= ROUNDING or (worst <= LARGEST and self.stuck >= 2)
        keep = min(BASIS, self.d)
        self.basis, self.values = self.basis[:, :keep], self.values[:keep]

    def interval(self) -> tuple[float, float]:
        """Centre and half width of the spectrum to damp: from zero to the smallest Ritz value."""
        high = max(float(self.values[-1]), ZERO * max(float(self.values[0]), 1e-300))
        return high / 2, high / 2

    def search(self) -> None:
        """Adds random columns, to be filtered with the basis: a direction that it misses shows in them."""
        more = self.random.standard_normal((self.d, PROBES))
        self.basis = np.linalg.qr(np.column_stack([self.basis, more]))[0]


def components(blocks: DataFrame, centres: dict[int, Centre], variances: dict[int, float]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By vector length, eigenvalues and unit eigenvectors (columns) of the covariance, largest first."""
    spaces = {d: Subspace(d, variances[d]) for d in centres}

    def image(of: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
        def product(x: np.ndarray) -> np.ndarray:
            if x.shape[1] not in of:
                return np.zeros(0)
            y = centres[x.shape[1]].centred(x)
            return y.T @ (y @ of[x.shape[1]])

        sums = summed(blocks, product)
        return {d: sums[d].reshape(q.shape) / centres[d].n for d, q in of.items()}

    for d, got in image({d: s.basis for d, s in spaces.items()}).items():
        spaces[d].turn(got)
    for _ in range(ROUNDS):
        open_ = {}
        for d, s in spaces.items():
            if s.done and s.searched:
                continue
            if s.done:
                s.before = s.values[: s.wanted].copy()
                s.search()
            open_[d] = s
        if not open_:
            break
        middle, half = zip(*[s.interval() for s in open_.values()])
        middle, half = dict(zip(open_, middle)), dict(zip(open_, half))
        # The scaled Chebyshev recurrence, of value about one at the largest Ritz value.
        scale = {d: half[d] / max(float(s.values[0]) - middle[d], half[d]) for d, s in open_.items()}
        first, last = dict(scale), {d: s.basis for d, s in open_.items()}
        got = image(last)
        now = {d: (got[d] - middle[d] * last[d]) * (scale[d] / half[d]) for d in open_}
        for _ in range(DEGREE - 1):
            got = image(now)
            for d in open_:
                after = 1 / (2 / first[d] - scale[d])
                now[d], last[d] = (got[d] - middle[d] * now[d]) * (2 * after / half[d]) - scale[d] * after * last[d], now[d]
                scale[d] = after
        for d, s in open_.items():
            s.basis = np.linalg.qr(now[d])[0]
        for d, got in image({d: s.basis for d, s in open_.items()}).items():
            s = spaces[d]
            searching = s.done
            s.turn(got)
            if searching:
                # Certified if the search moved no wanted eigenvalue.
                moved = np.abs(s.values[: s.wanted] - s.before).max()
                s.searched = bool(moved <= 1e-10 * max(s.values[0], 1e-300))
    failed = [d for d, s in spaces.items() if not (s.done and s.searched)]
    if failed:
        raise ArithmeticError(f"components not certified after {ROUNDS} rounds for vectors of length {failed}")
    result = {}
    for d, s in spaces.items():
        real = np.flatnonzero(s.values[: s.wanted] > ZERO * max(s.values[0], 0) + 1e-12)
        result[d] = s.values[real], s.basis[:, real]
    return result


def whitened(vectors: DataFrame) -> DataFrame:
    """Each usable vector on up to COMPONENTS components: vec_id, component from 1, n, deviation,
    whitened, explained, identity_error.

    ``vectors`` has vec_id and embedding (an array of numbers). Vectors that are null or hold
    null or non-finite entries drop out; so do empty ones, which have no component. An entry
    becomes floor(64 * entry) + 1000000, where the floor stops at 2^52 either side. Repeated
    vectors count once in the fit, each of their rows is returned; null ids stay null. Vectors of each
    length are whitened apart, n being that of their length. Directions without variance are no
    components, so a length with one distinct vector has no rows, and an empty table none. A
    deviation that a long can't hold is null. Other columns are not read, whatever their names.
    """
    blocks = fit_blocks(vectors)
    centres = {d: Centre(sums) for d, sums in summed(blocks, counted, np.int64).items()}
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not centres:
        return vectors.sparkSession.createDataFrame([], schema)

    def spread(x: np.ndarray) -> np.ndarray:
        return (centres[x.shape[1]].centred(x) ** 2).sum(keepdims=True).ravel()

    variances = {d: float(v[0]) / centres[d].n for d, v in summed(blocks, spread).items()}
    found = components(blocks, centres, variances)
    scaled = {d: vectors_ / np.sqrt(values) for d, (values, vectors_) in found.items()}

    def moments(x: np.ndarray) -> np.ndarray:
        w = centres[x.shape[1]].centred(x) @ scaled[x.shape[1]]
        return np.concatenate([w.T @ w, w.sum(0, keepdims=True)])

    errors = {}
    for d, sums in summed(blocks, moments).items():
        k = scaled[d].shape[1]
        square, mean = sums.reshape(k + 1, k)[:k] / centres[d].n, sums.reshape(k + 1, k)[k] / centres[d].n
        errors[d] = float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max(initial=0))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in integers(batch.column(1)):
                d = x.shape[1]
                values, k = found[d][0], len(found[d][0])
                if not k:
                    continue
                share = values / variances[d]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(np.repeat(rows, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(len(rows) * k, centres[d].n)), pa.array([v for v in centres[d].deviations(x) for _ in range(k)], pa.int64()),
                    pa.array((centres[d].centred(x) @ scaled[d]).ravel()), pa.array(np.tile(share, len(rows))), pa.array(np.full(len(rows) * k, errors[d])),
                ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.select("vec_id", "embedding").mapInArrow(project, schema)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
