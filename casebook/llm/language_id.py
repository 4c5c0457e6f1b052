"""Language identification with a bidirectional gated recurrent network over bytes.

The network reads bytes in windows of ``WINDOW`` bytes (state starts at zero in each window, so a text of any
length is a batch of windows). Two gated recurrent layers, one per direction, feed a softmax that labels every
byte position; a document's probabilities are the mean over all its positions. One gate both resets and
updates: ``f = sigmoid(E_f[byte] + U_f h)``, ``c = tanh(E_c[byte] + f * U_c h)``, ``h = h + f * (c - h)``.
Weights are trained here, in numpy, by backpropagation through time with Adam.

The fit uses at most ``per_language`` windows of each language, drawn by hashed doc_id (a documented bound);
prediction covers every byte of every document. Only ``text`` enters a prediction.

Edge cases: null text and text without a letter give ``und`` with score 0; without any language to learn from
every text is ``und``; repeated rows are predicted each by itself; an empty table gives no rows; other columns
are ignored; invalid or rare characters are just bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casebook.llm import textarray as ta
from casebook.llm.frames import fold

WINDOW, HIDDEN = 128, 8


def _tanh(x: np.ndarray, scratch: np.ndarray) -> np.ndarray:
    """A rational tanh in place (error under 0.025, exact limits); training uses the same function.

    x (27 + x^2) / (27 + 9 x^2) = x (1/9 + (8/3) / (3 + x^2))
    """
    np.clip(x, -3, 3, out=x)
    np.multiply(x, x, out=scratch)
    scratch += 3
    np.divide(np.float32(8 / 3), scratch, out=scratch)
    scratch += np.float32(1 / 9)
    x *= scratch
    return x


def _tanh_slope(y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Derivative of the rational tanh at pre-activation ``x`` with value ``y``."""
    q = 27 + 9 * x * x
    slope = ((27 + 3 * x * x) - y * 18 * x) / q
    return np.where(np.abs(x) < 3, slope, 0)


@dataclass
class Network:
    languages: list[str]
    embed: list[np.ndarray]  # by direction: 256 x 2H
    inner: list[np.ndarray]  # by direction: H x 2H
    out: np.ndarray  # 2H + 1 by languages

    def states(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hidden states (time, batch, H) of windows ``x`` (time, batch): read from the start, and from the end."""
        steps, n = x.shape
        H = self.inner[0].shape[0]
        E = np.concatenate(self.embed)  # rows 256 and up: the other direction
        Ef, Ec = np.ascontiguousarray(E[:, :H] * 0.5), np.ascontiguousarray(E[:, H:])
        Uf, Uc = [np.ascontiguousarray(U[:, :H] * 0.5) for U in self.inner], [np.ascontiguousarray(U[:, H:]) for U in self.inner]
        at = np.concatenate([x.astype(np.intp), x[::-1].astype(np.intp) + 256], 1)
        out = np.empty((steps, 2 * n, H), np.float32)
        h = np.zeros((2 * n, H), np.float32)
        f, c, e, s = (np.empty((2 * n, H), np.float32) for _ in range(4))
        for t in range(steps):
            for way, rows in ((0, slice(0, n)), (1, slice(n, 2 * n))):
                np.matmul(h[rows], Uf[way], out=f[rows])
                np.matmul(h[rows], Uc[way], out=c[rows])
            np.take(Ef, at[t], axis=0, out=e, mode="clip")
            f += e
            _tanh(f, s)
            f += 1
            f *= 0.5
            np.take(Ec, at[t], axis=0, out=e, mode="clip")
            c *= f
            c += e
            _tanh(c, s)
            c -= h
            c *= f
            h = np.add(h, c, out=out[t])
        return out[:, :n], out[::-1, n:]

    def position_scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities (time, batch, language) of every byte position."""
        H, (ahead, back) = self.inner[0].shape[0], self.states(x)
        z = ahead @ self.out[:H]
        z += back @ self.out[H:-1]
        z += self.out[-1]
        np.exp(np.clip(z, -40, 40, out=z), out=z)
        z /= z @ np.ones((z.shape[-1], z.shape[-1]), np.float32)
        return z

    def pooled(self, buf: np.ndarray, off: np.ndarray, tile: int = 512) -> np.ndarray:
        """Mean probabilities (text, language) over all positions of each text; empty texts get zeros."""
        n = np.diff(off)
        windows = -(-n // WINDOW)
        doc = np.repeat(np.arange(len(n)), windows)
        start = ta.ragged(np.zeros(len(n), np.int64), windows) * WINDOW + np.repeat(off[:-1], windows)
        size = np.minimum(np.repeat(off[1:], windows) - start, WINDOW)
        total = np.zeros((len(n), len(self.languages)))
        order = np.argsort(size, kind="stable")
        padded = np.concatenate([buf, np.zeros(WINDOW, np.uint8)])
        for i in range(0, len(order), tile):
            o = order[i : i + tile]
            steps = int(size[o].max())
            x = padded[start[o] + np.arange(steps)[:, None]]
            if size[o[0]] < steps:
                here = np.arange(steps)[:, None] < size[o]
                x[~here] = 32
                p = np.einsum("tbl,tb->bl", self.position_scores(x), here.astype(np.float32))
            else:
                p = self.position_scores(x).sum(0)
            for k in range(p.shape[1]):
                total[:, k] += np.bincount(doc[o], weights=p[:, k], minlength=len(n))
        return total / np.maximum(n, 1)[:, None]


def train(
    x: np.ndarray, size: np.ndarray, y: np.ndarray, languages: list[str], *, rounds: int = 200, batch: int = 128, steps: int = 64, rate: float = 0.02, seed: int = 7
) -> Network:
    """Backpropagation through time over the first ``steps`` of ``x`` (n, WINDOW) windows of ``size`` bytes with language numbers ``y``."""
    x, size = x[:, :steps], np.minimum(size, steps)
    rng, H, L = np.random.default_rng(seed), HIDDEN, len(languages)
    p = [rng.normal(0, 0.3, (256, 2 * H)), rng.normal(0, 0.3, (256, 2 * H)), rng.normal(0, 0.3, (H, 2 * H)), rng.normal(0, 0.3, (H, 2 * H)), rng.normal(0, 0.1, (2 * H + 1, L))]
    p = [a.astype(np.float32) for a in p]
    p[0][:, :H] -= 1
    p[1][:, :H] -= 1  # gates start nearly closed, so memory is long from the beginning
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    by = [np.flatnonzero(y == k) for k in range(L)]
    for r in range(1, rounds + 1 if L > 1 else 1):
        at = np.concatenate([rng.choice(b, max(1, batch // L)) for b in by if len(b)])  # a language may have no text to learn from
        xb, n = x[at].T, size[at]
        steps = int(n.max())
        xb, here = xb[:steps], (np.arange(steps)[:, None] < n)
        xb = np.where(here, xb, 32)
        g = [np.zeros_like(a) for a in p]
        ways = []
        for way in (0, 1):
            E, U = p[way], p[2 + way]
            h, kept = np.zeros((len(at), H), np.float32), {}
            for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
                a, e = h @ U, E[xb[t]]
                pre_f = 0.5 * (a[:, :H] + e[:, :H])
                th = _tanh(pre_f.copy(), np.empty_like(pre_f))
                f = 0.5 * (th + 1)
                pre_c = e[:, H:] + f * a[:, H:]
                c = _tanh(pre_c.copy(), np.empty_like(pre_c))
                new = h + f * (c - h)
                kept[t] = (h, a[:, H:], pre_f, th, f, pre_c, c, new)
                h = new
            ways.append(kept)
        hs = np.stack([np.concatenate([ways[0][t][-1], ways[1][t][-1], np.ones((len(at), 1), np.float32)], 1) for t in range(steps)])
        z = hs @ p[4]
        z = np.exp(z - z.max(-1, keepdims=True))
        z /= z.sum(-1, keepdims=True)
        z[:, np.arange(len(at)), y[at]] -= 1
        z *= here[:, :, None] / here.sum()
        g[4] = np.einsum("tbh,tbl->hl", hs, z)
        back = z @ p[4].T
        for way in (0, 1):
            E, U, kept = p[way], p[2 + way], ways[way]
            dh = np.zeros((len(at), H), np.float32)
            for t in range(steps - 1, -1, -1) if way == 0 else range(steps):
                h, uc, pre_f, th, f, pre_c, c, _ = kept[t]
                dh = dh + back[t][:, way * H : (way + 1) * H]
                dc = dh * f * _tanh_slope(c, pre_c)
                df = (dh * (c - h) + dc * uc) * 0.25 * _tanh_slope(th, pre_f)
                da = np.concatenate([df, dc * f], 1)
                np.add.at(g[way], xb[t], np.concatenate([df, dc], 1))
                g[2 + way] += h.T @ da
                dh = dh * (1 - f) + da @ U.T
        norm = np.sqrt(sum((a * a).sum() for a in g))
        step = rate * min(1, r / 20) * (1 - 0.9 * r / rounds)
        for k, a in enumerate(g):
            a = a * min(1, 1 / max(norm, 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * a
            v[k] = 0.99 * v[k] + 0.01 * a * a
            p[k] = (p[k] - step * (m[k] / (1 - 0.9**r)) / (np.sqrt(v[k] / (1 - 0.99**r)) + 1e-8)).astype(np.float32)
    return Network(languages, [p[0], p[1]], [p[2], p[3]], p[4])


def learn(docs: DataFrame, *, per_language: int = 1500, **settings) -> Network:
    """Train on at most ``per_language`` windows of each language, from documents outside the held-out fold.

    Each drawn document gives one window, at a place drawn by the hash of its id.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang")).where(F.col("lang").isNotNull() & (fold(5) != 0))
    languages = sorted(r["lang"] for r in ids.select("lang").distinct().collect())  # the network's outputs
    if not languages:
        return train(np.empty((0, WINDOW), np.uint8), np.empty(0, np.int64), np.empty(0, np.int64), [], **settings)
    # One pass for all languages: every task keeps its first ids of each before the shuffle.
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    drawn = ids.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_language)
    drawn = drawn.select("doc_id", "lang").distinct()  # ids only: the texts are read once, below
    place = F.pmod(F.xxhash64("doc_id", F.lit("place")), F.greatest(F.length("text") - WINDOW // 2, F.lit(1))).cast("int") + 1
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = (
        texts.where("text IS NOT NULL")
        .join(F.broadcast(drawn), ["doc_id", "lang"])  # at most per_language rows of each language
        .select("doc_id", "lang", F.col("text").substr(place, F.lit(WINDOW)).alias("text"))
        .groupBy("doc_id", "lang")
        .agg(F.min("text").alias("text"))  # one text of an id that repeats
        .orderBy("lang", "doc_id")
        .collect()  # as many rows, each of one window
    )
    x, size, y = np.full((len(rows), WINDOW), 32, np.uint8), np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    for i, r in enumerate(rows):
        b = np.frombuffer(r["text"].encode()[:WINDOW], np.uint8)
        x[i, : len(b)], size[i], y[i] = b, len(b), languages.index(r["lang"])
    full = size > 0
    if len(set(y[full])) < len(languages):  # only empty texts in some language: nothing to learn it from
        languages = [lang for k, lang in enumerate(languages) if (y[full] == k).any()]
        y = np.array([languages.index(r["lang"]) if r["lang"] in languages else 0 for r in rows], np.int64)
    return train(x[full], size[full], y[full], languages, **settings)


def identify(docs: DataFrame, net: Network) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (pooled probability of that language)."""
    held = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = held.value
        for t in ta.gathered(batches, 1, 1 << 20):
            buf, off = ta.texts_of(t.column(1))
            lettered = t.column(2).to_numpy()
            for i, j in ta.slices(off, 1 << 20):
                if net.languages:
                    p = net.pooled(buf[off[i] : off[j]], off[i : j + 1] - off[i])
                    best = p.argmax(1)
                    score, lang = p[np.arange(j - i), best], np.array(net.languages, object)[best]
                else:
                    score, lang = np.zeros(j - i), np.full(j - i, "und", object)
                known = lettered[i:j]
                yield pa.RecordBatch.from_arrays(
                    [t.column(0).slice(i, j - i).combine_chunks(), pa.array(np.where(known, lang, "und"), pa.string()), pa.array(np.where(known, score, 0.0).clip(0, 1))],
                    names=["doc_id", "lang_pred", "score"],
                )

    text = F.col("text").cast("string")
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
        .mapInArrow(run, "doc_id long, lang_pred string, score double")
        .select("doc_id", (fold(5) == 0).alias("held_out"), "lang_pred", "score")
    )
