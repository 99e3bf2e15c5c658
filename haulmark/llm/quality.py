"""Quality classifier: random-indexing word vectors, pooled, and a small network with calibrated probabilities.

Method. Words, and their last bytes, are units hashed into ``BUCKETS`` places.
Each unit has a fixed sparse random index vector; a unit's vector is the sum of
the index vectors of the words around all its occurrences in the corpus, added
up by all workers and reduced in rounds. The table of vectors has a fixed size
whatever the corpus. A document is the mean and the spread of its words'
vectors. A network of two layers in numpy learns the labels of at most
``SAMPLE`` labelled documents (those with the smallest hash of their id), and a
temperature, fitted on labelled documents kept out of training, makes its
outputs probabilities.

Defined cases. A null text or one without words scores 0. Several labels of one
document count as their mean, rounded. Without any label every text with words
scores 0.5. Long texts are pooled whole. Repeated rows score alike. Empty
tables give no rows. Extra columns are ignored by ``scores``, kept by ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.llm.sums import SCHEMA, blocks, summed
from haulmark.llm.text import mix, pieces, stream, words

BUCKETS, SIZE = 1 << 14, 48
NONZERO, REACH, ENDING = 3, 2, 3
SAMPLE = 20_000
THRESHOLD = 0.3


def _units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each word, bucket of its last bytes, and where each text's words begin. Letter case counts."""
    hashes, starts, begin, end = words(data, offsets, fold=False)
    ending = np.zeros(len(begin), np.uint64)
    for k in range(1, ENDING + 1):
        at = end - k
        ending = ending * np.uint64(257) + np.where(at >= begin, data[np.maximum(at, 0)] if len(data) else 0, 0).astype(np.uint64)
    whole = (hashes % np.uint64(BUCKETS // 2)).astype(np.int64)
    return whole, (mix(ending) % np.uint64(BUCKETS // 2)).astype(np.int64) + BUCKETS // 2, starts


def _index_vectors() -> np.ndarray:
    """A fixed row per bucket with ``NONZERO`` entries of 1 or -1."""
    draw = stream(BUCKETS * NONZERO, 71).reshape(BUCKETS, NONZERO)
    out = np.zeros((BUCKETS, SIZE), np.float32)
    sign = np.where(draw >> np.uint64(63), 1, -1)
    for j in range(NONZERO):
        out[np.arange(BUCKETS), (draw[:, j] % np.uint64(SIZE)).astype(np.int64)] += sign[:, j]
    return out


def word_vectors(docs: DataFrame) -> np.ndarray:
    """BUCKETS x SIZE context sums over all texts, each row scaled to length 1, with the share of each bucket among all words as last column."""
    index = _index_vectors()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BUCKETS, SIZE + 1))
        for batch in batches:
            for _, _, data, offsets in pieces(batch.column("text")):
                whole, ending, starts = _units(data, offsets)
                if not len(whole):
                    continue
                doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
                around = np.zeros((len(whole), SIZE), np.float32)
                own = index[whole]
                for step in range(1, REACH + 1):
                    same = (doc[step:] == doc[:-step])[:, None]
                    around[step:] += own[:-step] * same
                    around[:-step] += own[step:] * same
                for unit in (whole, ending):
                    order = np.argsort(unit.astype(np.uint16), kind="stable")
                    at = np.flatnonzero(np.diff(unit[order], prepend=-1))
                    total[unit[order][at], :SIZE] += np.add.reduceat(around[order], at, axis=0)
                    total[:, SIZE] += np.bincount(unit, minlength=BUCKETS)
        yield blocks(total)

    total = summed(docs.select("text").mapInArrow(run, SCHEMA), BUCKETS * (SIZE + 1)).reshape(BUCKETS, SIZE + 1)
    length = np.sqrt((total[:, :SIZE] ** 2).sum(axis=1, keepdims=True))
    share = total[:, SIZE:] / max(total[:, SIZE].sum(), 1.0)
    return np.hstack([total[:, :SIZE] / np.maximum(length, 1e-9), share]).astype(np.float32)


def _pooled(column: pa.Array, table: np.ndarray) -> np.ndarray:
    """One row per text: mean and spread of its word vectors, mean and spread of its ending vectors, and whether it has words."""
    weight = 1e-3 / (1e-3 + table[:, SIZE])
    vectors = table[:, :SIZE] * weight[:, None]
    out = []
    for first, after, data, offsets in pieces(column):
        whole, ending, starts = _units(data, offsets)
        rows = np.zeros((after - first, 4 * SIZE + 1), np.float32)
        count = np.diff(starts)
        some = count > 0
        if some.any():
            for k, unit in enumerate((whole, ending)):
                v = vectors[unit]
                mean = np.add.reduceat(v, starts[:-1][some], axis=0) / count[some, None]
                square = np.add.reduceat(v * v, starts[:-1][some], axis=0) / count[some, None]
                rows[some, 2 * k * SIZE : (2 * k + 1) * SIZE] = mean
                rows[some, (2 * k + 1) * SIZE : (2 * k + 2) * SIZE] = np.sqrt(np.maximum(square - mean * mean, 0))
            rows[some, -1] = 1
        out.append(rows)
    return np.vstack(out) if out else np.zeros((0, 4 * SIZE + 1), np.float32)


class Network:
    """Two layers, trained by Adam on log loss; ``temperature`` divides the output before the logistic."""

    def __init__(self, hidden: int = 32, rounds: int = 40, seed: int = 3):
        self.hidden, self.rounds, self.seed, self.temperature = hidden, rounds, seed, 1.0
        self.weights: list[np.ndarray] = []

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return (x - self.middle) / self.spread

    def raw(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return (np.maximum(self._scaled(x) @ a + b, 0) @ c + d)[:, 0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x) / self.temperature, -30, 30)))

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Network":
        draw = np.random.default_rng(self.seed)
        aside = np.arange(len(y)) % 5 == 0 if len(y) >= 50 else np.ones(len(y), bool)
        fitted = ~aside if len(y) >= 50 else aside
        self.middle, self.spread = x[fitted].mean(axis=0), x[fitted].std(axis=0) + 1e-3
        z, t, n = self._scaled(x[fitted]), y[fitted], x.shape[1]
        self.weights = [draw.normal(0, n**-0.5, (n, self.hidden)), np.zeros(self.hidden), draw.normal(0, 0.1, (self.hidden, 1)), np.zeros(1)]
        first = [np.zeros_like(w) for w in self.weights]
        second = [np.zeros_like(w) for w in self.weights]
        step = 0
        for _ in range(self.rounds):
            order = draw.permutation(len(t))
            for rows in np.array_split(order, max(1, len(t) // 128)):
                a, b, c, d = self.weights
                h = np.maximum(z[rows] @ a + b, 0)
                e = (1 / (1 + np.exp(-np.clip((h @ c + d)[:, 0], -30, 30))) - t[rows])[:, None] / len(rows)
                back = (e @ c.T) * (h > 0)
                grads = [z[rows].T @ back + 1e-4 * a, back.sum(axis=0), h.T @ e + 1e-4 * c, e.sum(axis=0)]
                step += 1
                for i, g in enumerate(grads):
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    self.weights[i] = self.weights[i] - 0.003 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
        logits, target = self.raw(x[aside]), y[aside]
        tries = np.geomspace(0.25, 8, 41)
        loss = [np.mean(np.logaddexp(0, logits / t) - target * logits / t) for t in tries]
        self.temperature = float(tries[int(np.argmin(loss))])
        return self


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, table: np.ndarray, sample: int = SAMPLE) -> Network | None:
    """Fit on at most ``sample`` labelled documents that are not held out."""
    known = labels.where("quality is not null and doc_id is not null").where(~held_out(F.col("doc_id"), 5, 0))
    marks = known.groupBy("doc_id").agg(F.round(F.avg("quality")).cast("double").alias("mark"))
    chosen = marks.orderBy(F.xxhash64(F.lit(5), "doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [r.tobytes() for r in _pooled(batch.column("text"), table)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), pa.array(x, pa.binary())], names=["doc_id", "mark", "x"])

    got = rows.select("doc_id", "text", "mark").mapInArrow(run, "doc_id long, mark double, x binary").dropDuplicates(["doc_id"])
    got = got.orderBy(F.xxhash64(F.lit(6), "doc_id")).toArrow()
    if not got.num_rows:
        return None
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float32).reshape(got.num_rows, -1)
    return Network().fit(x.astype(np.float64), got.column("mark").to_numpy())


def scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from ``THRESHOLD``) for every document row."""
    return scored(docs.select("doc_id", "text"), docs, labels, sample).select(
        "doc_id",
        held_out(F.col("doc_id"), 5, 0).alias("held_out"),
        F.col("__score").alias("score"),
        (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def scored(rows: DataFrame, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, name: str = "__score") -> DataFrame:
    """``rows`` (with a column text) plus the score as ``name``, by vectors of ``docs`` and a network fitted on ``labels``."""
    table = word_vectors(docs)
    network = train(docs, labels, table, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _pooled(batch.column("text"), table)
            known = x[:, -1] > 0
            score = np.where(known, network.probability(x) if network else 0.5, 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], names=[*batch.schema.names, name])

    return rows.mapInArrow(run, rows.select("*", F.lit(0.0).alias(name)).schema)


def keep(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` without the rows that the classifier rejects; all columns stay."""
    name, taken = "__score", {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return scored(docs, docs, labels, sample, name).where(F.col(name) >= THRESHOLD).select(*docs.columns)
