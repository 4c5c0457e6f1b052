"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

A document's whole text becomes hashed counts of byte pairs and of character-shape triples (lower letter,
capital, digit, other letter, or the sign itself) and the number of words, over three, that repeat the one before, log-scaled, weighted by inverse document frequency in the
fit sample and projected by a truncated singular value decomposition. The labelled vectors (at most
``per_label`` of each label) are broadcast: their number and width are parameters, so their size is bounded
at any input size. Every document is multiplied with all of them, block by block, and its ``neighbours``
nearest vote with their cosine, raised to ``sharpness``, as weight; votes are scaled to the labels' shares.

Only ``text`` enters a score. Edge cases: null or empty text has a zero vector and takes the share of label 1
as its score; repeated rows are scored each by itself; labels of null quality, of held-out rows and of missing
documents are not learnt; of several labels of a document the smallest counts, of several texts the first in order; without any label every
score is 0.5; an empty table gives no rows; other columns are carried along only by ``split``.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm import textarray as ta
from casebook.llm.frames import fold

PAIRS, SHAPES = 1024, 1024
WIDE = PAIRS + SHAPES + 1
REPEATS = 8  # weight of the one count of repeated words against the many others
SHAPE = np.arange(256, dtype=np.uint32)
SHAPE[48:58] = 48
SHAPE[65:91] = 65
SHAPE[97:123] = 97
SHAPE[128:] = 128


def _bins(n: np.ndarray, width: int) -> np.ndarray:
    return ((n * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64) % width


PAIR_BIN = _bins(np.arange(1 << 16, dtype=np.uint32), PAIRS).astype(np.int32)


def counts(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Log-scaled feature counts, one row per text."""
    n = len(off) - 1
    out = np.zeros((n, WIDE), np.float32)
    start, end, doc = ta.words_of(buf, off, ta.SPACE)
    h = ta.hash_words(buf, start, end)
    out[:, -1] = np.maximum(np.bincount(doc[1:][(h[1:] == h[:-1]) & (doc[1:] == doc[:-1])], minlength=n) - 3, 0)
    for i in range(n):
        b = buf[off[i] : off[i + 1]]
        if len(b) < 3:
            b = np.concatenate([b, np.full(3 - len(b), 32, np.uint8)]) if len(b) else b
        if not len(b):
            continue
        for at in range(0, len(b) - 2, 1 << 20):
            piece = b[at : at + (1 << 20) + 2]
            w = piece.astype(np.uint16)
            out[i, :PAIRS] += np.bincount(PAIR_BIN[w[:-1] << np.uint16(8) | w[1:]], minlength=PAIRS)
            s = SHAPE[piece]
            out[i, PAIRS:-1] += np.bincount(_bins(s[:-2] * np.uint32(65599) + s[1:-1] * np.uint32(257) + s[2:], SHAPES), minlength=SHAPES)
    out = np.log1p(out)
    out[:, -1] *= REPEATS
    return out


@dataclass
class Model:
    weight: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    shares: np.ndarray  # of labels 0 and 1 among all learnable labels
    neighbours: int
    sharpness: float

    def vector(self, x: np.ndarray) -> np.ndarray:
        x = x * self.weight
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        x = x @ self.basis
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(x), 0.5)
        v = self.vector(x)
        near = v @ self.vectors.T
        k = min(self.neighbours, near.shape[1])
        at = np.argpartition(-near, k - 1, axis=1)[:, :k]
        w = np.maximum(np.take_along_axis(near, at, 1), 0).astype(np.float64) ** self.sharpness
        label = self.labels[at]
        held = np.array([max((self.labels == 0).sum(), 1), max((self.labels == 1).sum(), 1)])
        zero, one = ((w * (label == y)).sum(1) * self.shares[y] / held[y] for y in (0, 1))
        total = zero + one
        return np.where(total > 0, one / np.where(total > 0, total, 1), self.shares[1])


def fit(x: np.ndarray, y: np.ndarray, shares: np.ndarray, width: int, neighbours: int, sharpness: float) -> Model:
    if not len(y):
        return Model(np.ones(WIDE, np.float32), np.zeros((WIDE, 1), np.float32), np.zeros((0, 1), np.float32), y, shares, neighbours, sharpness)
    weight = np.log((1 + len(x)) / (1 + (x > 0).sum(0))).astype(np.float32) + 1
    z = x * weight
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
    gram = (z.T @ z).astype(np.float64)
    _, basis = np.linalg.eigh(gram)
    basis = basis[:, ::-1][:, : min(width, len(x))]
    m = Model(weight, np.ascontiguousarray(basis, np.float32), np.zeros((0, 1), np.float32), y, shares, neighbours, sharpness)
    m.vectors = m.vector(x)
    return m


def learn(
    docs: DataFrame, labels: DataFrame, *, per_label: int = 1500, width: int = 32, neighbours: int = 15, sharpness: float = 8.0
) -> Model:
    """Fit on at most ``per_label`` documents of each label, those with the smallest hashed ids."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & (fold(3) != 1))
        .groupBy("doc_id")
        .agg(F.min("y").alias("y"))
    )
    share = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    shares = np.array([share.get(0, 0), share.get(1, 0)], float)
    shares /= max(shares.sum(), 1)
    order = F.xxhash64("doc_id")
    picked = known.where("y = 0").orderBy(order, "doc_id").limit(per_label).unionByName(known.where("y = 1").orderBy(order, "doc_id").limit(per_label))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in ta.gathered(batches, 2, 1 << 20):
            x = counts(*ta.texts_of(t.column(2)))
            yield pa.RecordBatch.from_arrays(
                [t.column(0).combine_chunks(), t.column(1).combine_chunks(), pa.array([r.astype(np.float16).tobytes() for r in x], pa.binary())], names=["doc_id", "y", "x"]
            )

    def fitted(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("doc_id")
        x = np.array([np.frombuffer(r, np.float16) for r in rows["x"].to_pylist()], np.float32).reshape(len(rows), WIDE)
        model = fit(x, rows["y"].to_numpy().astype(np.int64), shares, width, neighbours, sharpness)
        return pa.table({"model": pa.array([pickle.dumps(model)], pa.binary())})

    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .join(F.broadcast(picked), "doc_id")  # at most 2 * per_label rows
        .groupBy("doc_id", "y")
        .agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))  # one text of an id that repeats
        .mapInArrow(run, "doc_id long, y int, x binary")
    )
    # at most 2 * per_label rows of fixed width: one task fits them, so the driver's memory holds the small model only
    found = rows.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(fitted, "model binary").first()
    if found is None:
        return fit(np.zeros((0, WIDE), np.float32), np.zeros(0, np.int64), shares, width, neighbours, sharpness)
    return pickle.loads(found["model"])


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in ta.gathered(batches, 1, 1 << 20):
            buf, off = ta.texts_of(t.column(1))
            for i in range(0, len(off) - 1, 512):
                part = off[i : i + 513]
                score = held.value.score(counts(buf[part[0] : part[-1]], part - part[0])).clip(0, 1)
                yield pa.RecordBatch.from_arrays([t.column(0).slice(i, len(part) - 1).combine_chunks(), pa.array(score)], names=["doc_id", "score"])

    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .mapInArrow(run, "doc_id long, score double")
        .select("doc_id", (fold(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
    )


def split(docs: DataFrame, model: Model, keep: float = 0.5) -> DataFrame:
    """The rows of ``docs``, unchanged and with all their columns, whose score is at least ``keep``."""
    held, schema, names = docs.sparkSession.sparkContext.broadcast(model), docs.schema, docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for b in batches:
            buf, off = ta.texts_of(b.column(at))
            score = np.concatenate([held.value.score(counts(buf[off[i] : off[j]], off[i : j + 1] - off[i])) for i, j in ta.slices(off, 1 << 20)] or [np.empty(0)])
            yield b.filter(pa.array(score >= keep))

    return docs.mapInArrow(run, schema)
