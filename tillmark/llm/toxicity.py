"""Toxicity of texts behind disguises: a noisy channel undone by a character language model.

Look-alike digits and signs, letters spelled apart and repeated letters form a lattice of
readings for a token. A Viterbi decoder picks the likeliest under a trigram model of the
letters, which counts over all documents. A linear model over the restored words then
scores the text. Its lexicon and its weights come from labelled training rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.llm.pieces import forget

#: At most so many labelled training rows fit the model, those with the smallest hash of their id.
MAX_TRAINING_ROWS = 20_000
#: Words enter the lexicon by how far their share of toxic documents lies above that of all, in deviations.
LEAST_Z, LEAST_DOCS = 6.0, 5
#: Bytes of remembered tokens of a task, and what an entry takes besides its text; beyond it the memory starts anew.
MEMORY, ENTRY = 48 << 20, 240
#: Tokens next to each other that one gap or two may have torn apart, and their letters.
TORN, TORN_LETTERS = 3, 24

# What a sign may stand for.
READS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l"}
# Signs that only keep letters apart, and one that hides a letter.
APART, HIDDEN = ".-_~'`,:;/\\", "*"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
OTHER, EDGE, N = 26, 27, 28
CODE = {c: i for i, c in enumerate(LETTERS)}
SUBSTITUTE, DROP, RARELY = math.log(0.3), math.log(0.5), math.log(0.05)

EDGES = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in "$@") + "«»“”„’‘…"
PLAIN = re.compile(r"[^\W\d_]+")
RUN = re.compile(r"(.)\1\1")
STRETCH = re.compile(r"(.)\1{3,}", re.DOTALL)
PARTS = re.compile("[" + re.escape(APART) + "]+")


def letter_counts(docs: DataFrame) -> DataFrame:
    """Letter trigrams (code, n) over every whole text; a bounded number of rows."""
    codes = bytes(CODE.get(chr(b).lower(), OTHER if chr(b).isalpha() else EDGE) for b in range(256))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(N**3, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                letters = np.frombuffer((" " + (text.as_py() or "").lower() + " ").encode("latin-1", "replace").translate(codes), dtype=np.uint8)
                wide = letters.astype(np.int32)
                wide = np.concatenate([[EDGE], wide])
                total += np.bincount((wide[:-2] * N + wide[1:-1]) * N + wide[2:], minlength=N**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["code", "n"])

    return docs.select("text").mapInArrow(count, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))


def letter_model(counts: list[tuple[int, int]]) -> np.ndarray:
    """log P(c | a, b), trigrams backed by bigrams and letters."""
    n = np.zeros(N**3)
    for code, times in counts:
        n[code] = times
    n = n.reshape(N, N, N)
    single = (n.sum((0, 1)) + 1) / (n.sum() + N)
    pair = (n.sum(0) + 20 * single) / (n.sum((0, 2))[:, None] + 20)
    return np.log((n + 20 * pair[None]) / (n.sum(2)[..., None] + 20))


class Decoder:
    """Restores disguised tokens."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()

    def lattice(self, token: str, alone: bool = False) -> list[list[tuple[str, float]]]:
        """For each run of a character, or for each ``alone``, the strings it may stand for, with their log weights."""
        steps: list[list[tuple[str, float]]] = []
        at = 0
        while at < len(token):
            sign, end = token[at], at
            while end < len(token) and token[end] == sign and (end == at or not alone):
                end += 1
            n, at = end - at, end
            if sign.isalpha():
                steps.append([(sign * n, 0.0)] if n < 3 else [(sign, DROP), (sign * 2, DROP)])
            elif sign in READS:
                steps.append([(letter * k, SUBSTITUTE) for letter in READS[sign] for k in ((1, 2) if n > 1 else (1,))])
            elif sign == HIDDEN:
                steps.append([("", RARELY)] + [(letter, DROP) for letter in LETTERS])
            else:
                steps.append([("", DROP)])
        return steps

    def restore(self, token: str) -> str:
        """The likeliest reading of a lower-case token."""
        best: dict[tuple[int, int], tuple[float, str]] = {(EDGE, EDGE): (0.0, "")}
        for step in self.lattice(token):
            after: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (weight, read) in best.items():
                for letters, cost in step:
                    w, x, y = weight + cost, a, b
                    for letter in letters:
                        c = CODE.get(letter, OTHER)
                        w += self.model[x][y][c]
                        x, y = y, c
                    if (x, y) not in after or w > after[x, y][0]:
                        after[x, y] = (w, read + letters)
            best = after
        return max((weight + self.model[a][b][EDGE], read) for (a, b), (weight, read) in best.items())[1]

    def weight(self, word: str) -> float:
        """The log probability of a word of letters and of its end."""
        x = y = EDGE
        total = 0.0
        for c in [*(CODE.get(letter, OTHER) for letter in word), EDGE]:
            total += self.model[x][y][c]
            x, y = y, c
        return total

    def segment(self, letters: str) -> list[str]:
        """The likeliest words behind letters spelled apart: at every gap one may end, as the letter model has it."""
        best: dict[tuple[int, int], tuple[float, str]] = {(EDGE, EDGE): (0.0, "")}
        for step in self.lattice(letters, alone=True):
            after: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (weight, read) in best.items():
                # The gap before this sign parts words, or only letters.
                for w, x, y, text in ((weight, a, b, read), (weight + self.model[a][b][EDGE], b, EDGE, read + " ")):
                    for found, cost in step:
                        v, p, q = w + cost, x, y
                        for letter in found:
                            c = CODE.get(letter, OTHER)
                            v += self.model[p][q][c]
                            p, q = q, c
                        if (p, q) not in after or v > after[p, q][0]:
                            after[p, q] = (v, text + found)
            best = after
        return max((weight + self.model[a][b][EDGE], read) for (a, b), (weight, read) in best.items())[1].split()

    def words(self, token: str) -> tuple[str, ...]:
        """The words that a lower-case token without white space may be: as written, restored, and its parts between separators.

        A token that begins with a blank is a run of letters spelled apart.
        """
        if token.startswith(" "):
            return tuple(dict.fromkeys([*self.words(token[1:]), *(word for word in self.segment(token[1:]) if len(word) > 1)]))
        token = STRETCH.sub(r"\1\1\1", token)
        core = token.strip(EDGES)
        plain = PLAIN.fullmatch(core)
        if plain and not RUN.search(core):
            return (core,)
        body = token if not core or not any(c.isalpha() for c in core) else core
        if not any(c.isalpha() for c in body):
            return (core,) if core else ()
        tail = token.rstrip(EDGES.replace("!", "").replace("|", "").replace("+", ""))
        parts = [part for part in PARTS.split(core) if len(part) > 2]
        inside = [word for part in parts if part != core for word in self.words(part)]
        return tuple(dict.fromkeys(word for word in (core, self.restore(core), self.restore(tail), *inside) if word))


def spelled_apart(tokens: list[str]) -> list[str]:
    """Runs of three or more tokens of one character each, signs at their edges apart, joined behind a blank."""
    joined, run = [], []
    for token in [*tokens, ""]:
        single = token if len(token) < 2 else token.strip(EDGES) if len(token) < 5 else ""
        if len(single) == 1:
            run.append(single)
        else:
            if len(run) > 2:
                joined.append(" " + "".join(run))
            run = []
    return joined


class Reader:
    """The distinct restored words of texts, with a memory of tokens."""

    def __init__(self, model: np.ndarray, weights: dict[str, float] | None = None):
        forget()
        self.decoder, self.weights, self.known, self.held = Decoder(model), weights, {}, 0
        # What a torn word of the lexicon may begin with.
        self.starts = {word[:n] for word in weights or () for n in range(1, len(word))}
        self.longest = max(map(len, weights or ()), default=0)

    def tokens(self, text: str) -> set[str]:
        listed = text.lower().split()
        found = set(listed)
        if sum(len(token) == 1 for token in found) > 1:
            found.update(spelled_apart(listed))
        self.listed = listed
        if self.held > MEMORY:
            self.known.clear()
            self.held = 0
        for token in found.difference(self.known):
            words = self.decoder.words(token)
            if token.startswith(" ") and self.weights:
                words = (*words, *self.spelled(token[1:]))
            self.held += ENTRY + 2 * len(token)
            self.known[token] = words if self.weights is None else tuple(word for word in words if word in self.weights)
        return found

    def words(self, text: str) -> set[str]:
        return {word for token in self.tokens(text) for word in self.known[token]}

    def spelled(self, run: str) -> set[str]:
        """Words of the lexicon in letters spelled apart, each sign read as any letter it may stand for.

        Next to other single letters the letter model may put the gap elsewhere, so these count as well.
        """
        found = set()
        for at in range(len(run)):
            reads = [""]
            for sign in run[at : at + self.longest]:
                letters = LETTERS if sign == HIDDEN else READS.get(sign, sign)
                reads = [read + letter for read in reads for letter in letters if read + letter in self.starts or read + letter in self.weights]
                found.update(read for read in reads if read in self.weights and len(read) > 2)
                if not reads:
                    break
        return found

    def torn(self, listed: list[str]) -> set[str]:
        """Words of the lexicon that gaps tear apart, where the letter model takes one word for likelier than its pieces."""
        found = set()
        for at, token in enumerate(listed):
            if token not in self.starts and token.lstrip(EDGES) not in self.starts:
                continue
            pieces = [part.strip(EDGES) for part in listed[at : at + TORN]]
            for n in range(2, len(pieces) + 1):
                word = "".join(pieces[:n])
                if word in self.weights and len(word) <= TORN_LETTERS and not any(piece in self.weights for piece in pieces[:n]):
                    if self.decoder.weight(word) > sum(map(self.decoder.weight, pieces[:n])):
                        found.add(word)
        return found

    def features(self, text: str) -> tuple[float, float]:
        """The sum and the largest of the weights of the text's words of the lexicon."""
        words = self.words(text)
        hits = [self.weights[word] for word in words | self.torn(self.listed)]
        return sum(hits), max(hits, default=0.0)


def fit(features: np.ndarray, labels: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton's method; the last weight is the bias."""
    x = np.column_stack([features, np.ones(len(features))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(len(w)), x.T @ (labels - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, dict[str, float], np.ndarray]:
    """The letter model (over all of ``docs``), the lexicon's weights and the linear model.

    ``labels`` has doc_id and toxic for training rows only. Rows with a null id or label
    are left out; of several labels of an id the largest counts, and copies of a text count
    once. Without labels the
    lexicon is empty and every score is one half.
    """
    counts = [(r.code, r.n) for r in letter_counts(docs).collect()]
    model = letter_model(counts)
    once = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sample = once.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TRAINING_ROWS)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("toxic", "text").dropDuplicates()

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            found = [(word, toxic) for toxic, text in zip(*(c.to_pylist() for c in batch.columns)) for word in [*reader.words(text or ""), ""]]
            word, toxic = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(toxic, pa.int32())], ["word", "toxic"])

    per_word = rows.mapInArrow(words, "word string, toxic int").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n"))
    # The empty word stands in every document and so counts them.
    n_toxic, n_all = next(((r.toxic, r.n) for r in per_word.where("word = ''").collect()), (0, 0))
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("n") - F.col("toxic") + 0.5) / (n_all - n_toxic + 1.0))
    rate = min(max(n_toxic / max(n_all, 1), 1e-6), 1 - 1e-6)
    z = (F.col("toxic") - F.col("n") * rate) / F.sqrt(F.col("n") * (rate * (1 - rate)))
    chosen = per_word.where(F.col("word") != "").withColumn("odds", odds).where((F.col("n") >= LEAST_DOCS) & (z >= LEAST_Z))
    weights = {r.word: r.odds for r in chosen.select("word", "odds").collect()}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model, weights)
        for batch in batches:
            toxic, text = (c.to_pylist() for c in batch.columns)
            total, most = zip(*[reader.features(t or "") for t in text]) if text else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array(total, pa.float64()), pa.array(most, pa.float64())], ["toxic", "total", "most"])

    seen = rows.mapInArrow(measure, "toxic int, total double, most double").collect()
    linear = fit(np.array([[r.total, r.most] for r in seen]), np.array([r.toxic for r in seen])) if seen else np.zeros(3)
    return model, weights, linear


def toxicity(docs: DataFrame, model: np.ndarray, weights: dict[str, float], linear: np.ndarray, name: str = "toxicity") -> DataFrame:
    """``docs`` with a column ``name``: the toxicity, 0 to 1, of every whole text.

    A null text counts as an empty one. Ids are not read, repeated rows get one score, an empty table
    gives none. All columns of ``docs`` pass through; one of that name is replaced.
    """
    docs = docs.drop(name)
    names = docs.columns
    at = names.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model, weights)
        for batch in batches:
            x = np.array([reader.features(text.as_py() or "") for text in batch.column(at)]).reshape(-1, 2)
            p = 1 / (1 + np.exp(-(x @ linear[:2] + linear[2])))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())], [*names, name])

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def held_out(column: str, folds: int) -> Column:
    """Whether an id's CRC-32 is divisible by ``folds``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % folds == 0, F.lit(False))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out("doc_id", 5))
    scored = toxicity(docs, *train(docs, labels))
    return scored.select(
        "doc_id", held_out("doc_id", 5).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted")
    )
