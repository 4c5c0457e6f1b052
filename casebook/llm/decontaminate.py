"""Benchmark decontamination by a BM25 inverted index of test items, searched with block-max WAND.

The test items are indexed: for each word its postings (item, BM25 impact) in blocks of ``BLOCK`` items with the
greatest impact of each block. Every passage of every training document (overlapping windows of words, long enough
that any item lies whole in one) is a query over its distinct words and retrieves all items whose score reaches the
item's threshold. An item is split into question and answer (its last sentence); a retrieved item is a leak if the
passage overlaps both by ``overlap`` at least. A part's overlap is the share of its five-word shingles that the passage
holds. One changed word costs up to five shingles, so a part of fewer than ``FEW`` shingles may also match by its words
in order: one less the edits (changed, missing and inserted words) to the nearest run of the passage, for each word.

The thresholds lose nothing: a passage with that overlap lacks at most as many words of a part as it may lack shingles
or have edits, so the item's own score less that many of its greatest impacts is a lower bound of its score.

The index is broadcast. Items are taken in shards of at most ``shard_items``, one after another: each shard's index is
built, searched with all passages, and released, so what is held is bounded whatever the size of the benchmark.

Words are runs of ASCII letters and digits and of non-ASCII characters; A-Z count as a-z. Edge cases: null or empty
texts, and items without words, match nothing; items and documents that repeat are matched each by itself, with
one row for each pair of ids (the best); null ids are carried along; empty tables give no rows; other columns
are ignored by ``leaks`` and kept by ``clean``, which returns the input rows whose document has no leak.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm import textarray as ta
from casebook.llm.frames import stored

K1, B = 1.2, 0.75
BLOCK = 16
SHINGLE = 5
FEW = 25  # shingles: from here on, five of them may be missing
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
SCHEMA = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def word_hashes(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, word offsets of the texts)."""
    start, end, doc = ta.words_of(buf, off, ~ta.LATIN_WORD)
    return ta.hash_words(ta.LOWER[buf], start, end), np.searchsorted(doc, np.arange(len(off)))


def shingles(words: np.ndarray) -> np.ndarray:
    """Distinct hashes of the runs of SHINGLE words; a shorter text is one shingle."""
    if not len(words):
        return np.empty(0, np.uint64)
    n = min(SHINGLE, len(words))
    h = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        h = ta.mix(h * ta.M1 + words[k : len(words) - n + 1 + k])
    return np.unique(h)


def words_in(text: str) -> np.ndarray:
    return word_hashes(*ta.texts_of(pa.array([text])))[0]


class Part:
    """Words and shingles of a question or an answer."""

    def __init__(self, text: str):
        self.words = words_in(text)
        self.shingles = shingles(self.words)

    def most_lost(self, overlap: float) -> int:
        """Words that a passage with this overlap can lack."""
        few = len(self.words) if len(self.shingles) < FEW else 0
        return int((1 - overlap) * max(len(self.shingles), few) + 1e-9)

    def overlap(self, passage: np.ndarray, have: np.ndarray, enough: float) -> float:
        if not len(self.words):
            return 1.0
        share = float(np.isin(self.shingles, have).mean())
        if share < enough and len(self.shingles) < FEW:
            share = max(share, 1 - edits(self.words, passage) / len(self.words))
        return share


def edits(words: np.ndarray, passage: np.ndarray) -> int:
    """The least number of changed, missing and inserted words between ``words`` and a run of ``passage``."""
    place = np.arange(len(passage) + 1)
    cost = np.zeros(len(passage) + 1, np.int64)
    for k, w in enumerate(words):
        step = np.empty_like(cost)
        step[0] = k + 1
        step[1:] = np.minimum(cost[:-1] + (passage != w), cost[1:] + 1)
        cost = np.minimum.accumulate(step - place) + place
    return int(cost.min())


@dataclass
class Index:
    """Postings of ``items`` by word, and what verification needs. Term ``t`` has postings ``post[t] .. post[t + 1]``
    and blocks ``blocks[t] .. blocks[t + 1]``."""

    items: list[tuple[int | None, "Part", "Part"]]  # id, question and answer
    terms: np.ndarray  # sorted word hashes
    post: np.ndarray
    post_item: np.ndarray
    post_impact: np.ndarray
    blocks: np.ndarray
    block_id: np.ndarray
    block_max: np.ndarray
    term_max: np.ndarray
    floor: np.ndarray  # threshold of each item
    block_floor: np.ndarray
    longest: int

    def search(self, terms: np.ndarray) -> list[tuple[int, float]]:
        """All (item, score) whose score reaches the item's threshold.

        Block-max WAND, a block of items at a time: with terms in order of their greatest impact, an item that passes
        has a term from the pivot on, where the sum of greatest impacts first reaches the least threshold. Only blocks
        of those terms are looked at, and only blocks whose block maxima add up to their threshold are scored.
        """
        terms = terms[np.argsort(self.term_max[terms])]
        pivot = int(np.searchsorted(np.cumsum(self.term_max[terms]), self.floor.min()))
        if pivot == len(terms):
            return []
        first, many = self.blocks[terms], self.blocks[terms + 1] - self.blocks[terms]
        at = ta.ragged(first, many)
        bound = np.bincount(self.block_id[at], weights=self.block_max[at], minlength=len(self.block_floor))
        pivotal = np.zeros(len(bound), bool)
        pivotal[self.block_id[ta.ragged(first[pivot:], many[pivot:])]] = True
        passing = pivotal & (bound >= self.block_floor)
        if not passing.any():
            return []
        at = ta.ragged(self.post[terms], self.post[terms + 1] - self.post[terms])
        at = at[passing[self.post_item[at] // BLOCK]]
        score = np.bincount(self.post_item[at], weights=self.post_impact[at], minlength=len(self.floor))
        return [(int(k), float(score[k])) for k in np.flatnonzero(passing[np.arange(len(score)) // BLOCK] & (score >= self.floor))]


def build(rows: list[tuple[int | None, str]], overlap: float) -> Index | None:
    """Index of (item_id, text) rows; None if no item has a word."""
    items, words = [], []
    for item_id, text in rows:
        parts = [p for p in SENTENCE.split(text or "") if len(words_in(p))]
        w = words_in(text or "")
        if len(w):
            question, answer = (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (" ".join(parts), "")
            items.append((item_id, Part(question), Part(answer)))
            words.append(w)
    if not items:
        return None
    n, mean = len(items), np.mean([len(w) for w in words])
    counted = [np.unique(w, return_counts=True) for w in words]
    terms, df = np.unique(np.concatenate([t for t, _ in counted]), return_counts=True)
    idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
    rows_t, rows_k, rows_x = [], [], []
    floor = np.empty(n)
    for k, ((t, tf), w) in enumerate(zip(counted, words, strict=True)):
        at = np.searchsorted(terms, t)
        impact = idf[at] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(w) / mean))
        rows_t.append(at)
        rows_k.append(np.full(len(at), k))
        rows_x.append(impact)
        lost = sum(part.most_lost(overlap) for part in items[k][1:])
        floor[k] = np.sort(impact)[: len(impact) - lost].sum() * (1 - 1e-9) if lost < len(impact) else 0.0
    t, k, x = map(np.concatenate, (rows_t, rows_k, rows_x))
    order = np.lexsort((k, t))
    t, k, x = t[order], k[order], x[order]
    new = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (k[1:] // BLOCK != k[:-1] // BLOCK)]))
    block_max, edge = np.maximum.reduceat(x, new), np.arange(len(terms) + 1)
    post, blocks = np.searchsorted(t, edge), np.searchsorted(t[new], edge)
    block_floor = np.minimum.reduceat(floor, np.arange(0, n, BLOCK))
    return Index(items, terms, post, k, x, blocks, k[new] // BLOCK, block_max, np.maximum.reduceat(x, post[:-1]), floor, block_floor, max(map(len, words)))


def search_batch(index: Index, ids: list, buf: np.ndarray, off: np.ndarray, overlap: float) -> Iterator[tuple]:
    """Leaks of a batch of texts, as rows of ``SCHEMA``."""
    h, begin = word_hashes(buf, off)
    stride = max(32, int(np.ceil(index.longest / overlap)))  # a run with inserted words is longer than its item
    at = np.minimum(np.searchsorted(index.terms, h), len(index.terms) - 1)
    known = np.flatnonzero(index.terms[at] == h)
    if not len(known):
        return
    doc = np.searchsorted(begin, known, "right") - 1
    place = (known - begin[doc]) // stride
    windows = np.maximum(-(-np.diff(begin) // stride) - 1, 1)  # a window is two strides, and starts at each
    first = np.cumsum(windows) - windows
    here = first[doc] + np.minimum(place, windows[doc] - 1)
    before = place > 0
    # a word lies in the window that starts at its stride and in the one before
    pairs = np.concatenate([here, (first[doc] + place - 1)[before]]) * len(index.terms) + np.concatenate([at[known], at[known][before]])
    pairs = np.unique(pairs)
    window, term = np.divmod(pairs, len(index.terms))
    starts = np.flatnonzero(np.concatenate([[True], window[1:] != window[:-1]]))
    bound = np.add.reduceat(index.term_max[term], starts)
    sizes = np.diff(np.append(starts, len(term)))
    live = np.flatnonzero(bound >= index.floor.min())
    text = np.repeat(np.arange(len(windows)), windows)
    for i in live:
        t = term[starts[i] : starts[i] + sizes[i]]
        found = index.search(t)
        if not found:
            continue
        w = int(window[starts[i]])
        d = int(text[w])
        a = begin[d] + (w - first[d]) * stride
        passage = h[a : min(a + 2 * stride, begin[d + 1])]
        have = shingles_of_window(passage)
        for item, score in found:
            item_id, question, answer = index.items[item]
            q_part = question.overlap(passage, have, overlap)
            if q_part >= overlap and (a_part := answer.overlap(passage, have, overlap)) >= overlap:
                yield ids[d], item_id, score, q_part, a_part


def shingles_of_window(words: np.ndarray) -> np.ndarray:
    """Shingles of every length up to SHINGLE, for parts of items shorter than a shingle."""
    out = []
    for n in range(1, min(SHINGLE, len(words)) + 1):
        h = np.zeros(len(words) - n + 1, np.uint64)
        for k in range(n):
            h = ta.mix(h * ta.M1 + words[k : len(words) - n + 1 + k])
        out.append(h)
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def leaks(docs: DataFrame, benchmark: DataFrame, *, overlap: float = 0.8, shard_items: int = 20_000) -> DataFrame:
    """One row for each leaked pair: doc_id, item_id, score, question_overlap, answer_overlap."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    shards = max(1, -(-items.count() // shard_items))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for k in range(shards):
        part = items if shards == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == k)
        index = build(sorted((tuple(r) for r in part.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1])), overlap)
        if index is None:
            continue
        held = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for t in ta.gathered(batches, 1, 1 << 20):
                names, (buf, off) = t.column(0).to_pylist(), ta.texts_of(t.column(1))
                for i, j in ta.slices(off, 1 << 20):
                    rows = list(search_batch(held.value, names[i:j], buf[off[i] : off[j]], off[i : j + 1] - off[i], overlap))
                    if rows:
                        cols, types = zip(*rows, strict=True), [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=[x.split()[0] for x in SCHEMA.split(", ")])

        more = stored(texts.mapInArrow(run, SCHEMA), "leaks-of-shard")
        held.destroy()
        found = more if found is None else found.unionByName(more)
    if found is None:
        found = texts.where("false").select("doc_id", F.lit(0).cast("long").alias("item_id"), *[F.lit(0.0).alias(c) for c in ("score", "question_overlap", "answer_overlap")])
    return found.groupBy("doc_id", "item_id").agg(F.max("score").alias("score"), F.max("question_overlap").alias("question_overlap"), F.max("answer_overlap").alias("answer_overlap"))


def clean(docs: DataFrame, benchmark: DataFrame, *, overlap: float = 0.8) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose document holds no test item."""
    bad = stored(leaks(docs, benchmark, overlap=overlap).select(F.col("doc_id").alias("_leaked")).distinct(), "leaks")
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["_leaked"]), "left_anti")
