"""Collocation mining by multikey quicksort over suffix pointers.

Texts are lower-cased (A-Z) and split at ``[.,;:!?\\x0A-\\x0D]`` into pieces, and those into words ``[^\\x20\\x09]+``.
A suffix is a word with what follows in its piece, up to ``longest`` words. The count of a phrase is the number of
suffixes that begin with it, which is the size of one equal partition of a three-way quicksort by words:

1. words and leading word pairs are counted, combined in each task before the shuffle;
2. every task drops suffixes that can't hold a frequent phrase: a suffix ends where its next word pair is infrequent,
   as a filter of the frequent pairs proves. Equal suffixes of a task become one with a multiplicity;
3. the rest is routed globally by leading words to buckets of about ``bucket_rows`` suffixes. A bucket sorts pointers
   to its suffixes: each round partitions every open segment around a pivot word into less, equal and greater; an equal
   partition is counted and opened at the next word, and a partition of fewer than ``min_count`` suffixes is abandoned.
   Suffixes that begin with a very frequent pair are routed by all their words instead: their partitions below full
   depth are parts, all kept, and Spark adds them up.

Both filters are bit fields of at most ``filter_bits`` bits. Their false positives cost routed suffixes, never results.
Words travel as 64-bit ids of (lang, word); the word table proves that no two words share an id, and the seed of the ids
is changed until none do. Nothing else is broadcast or gathered, and a task holds one chunk of text or one bucket.

A candidate is a phrase of 2 to ``longest`` words that occurs ``min_count`` times. Its score is that of its
lowest-scoring cut; candidates that lie inside a longer one of at least ``share`` percent of their count are dropped.
All arithmetic is in integers and decimals.

Edge cases: null text counts as empty; null lang as ``und``; repeated rows each count; texts of any length are taken
whole; a lang without candidates gives no rows; an empty table gives no rows; further columns are ignored. A lang's
counts are its own; langs are compared as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casebook.llm import textarray as ta
from casebook.llm.frames import stored, text_column

BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
BLANK = BREAK.copy()
BLANK[[0x20, 0x09]] = True
CHUNK = 2 << 20  # bytes of text whose words are in hand at once, unless one text is longer
HELD = 1 << 18  # suffixes of a task that wait to be combined


# --- suffixes of a task's texts ---


def word_ids(lang: str, words: pa.Array, seed: int) -> np.ndarray:
    head = f"{seed}:{len(lang)}:{lang}".encode()
    ids = [int.from_bytes(hashlib.blake2b(head + w, digest_size=8).digest(), "little", signed=True) or 1 for w in words.to_pylist()]
    return np.array(ids, np.int64)  # 0 stands for the end of a suffix


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    """(lang, texts) of about ``CHUNK`` bytes."""
    for lang in batch["lang"].unique().to_pylist():
        texts = batch["text"].filter(pa.compute.equal(batch["lang"], lang))
        size = np.asarray(pa.compute.binary_length(texts)).cumsum()
        cuts = np.searchsorted(size, np.arange(CHUNK, size[-1], CHUNK), "right") if len(size) else []
        ends = sorted({*(int(c) for c in cuts), len(texts)} - {0})
        for a, b in zip([0, *ends], ends):
            yield lang, texts[a:b]


def suffixes(texts: pa.Array, longest: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, word number at each place, words left there in its piece, ``longest`` at most)."""
    buf, off = ta.texts_of(texts)
    buf = ta.LOWER[buf]
    start, end, text = ta.words_of(buf, off, BLANK)
    if not len(start):
        return pa.array([], pa.large_binary()), np.empty(0, np.int32), np.empty(0, np.int8)
    offsets = np.r_[0, np.cumsum(end - start)].astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(buf[~BLANK[buf]]))]).dictionary_encode()
    piece = np.cumsum(BREAK[buf], dtype=np.int32)[start]
    goes_on = np.r_[(text[1:] == text[:-1]) & (piece[1:] == piece[:-1]), False]
    left, run = np.ones(len(start), np.int8), goes_on.copy()
    for _ in range(longest - 1):
        left += run
        run = goes_on & np.r_[run[1:], False]
    return words.dictionary, np.asarray(words.indices), left


def _count_words(seed: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, texts in _chunks(b):
                words, codes, _ = suffixes(texts, 1)
                n = np.bincount(codes, minlength=len(words)).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(words), pa.string()), "word": words.cast(pa.large_string()).cast(pa.string()), "id": word_ids(lang, words, seed), "n": n})

    return run


def _count_pairs(seed: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, texts in _chunks(b):
                words, codes, left = suffixes(texts, 2)
                ids = word_ids(lang, words, seed)
                at = np.flatnonzero(left > 1)
                pairs, n = np.unique(codes[at].astype(np.int64) << 32 | codes[at + 1], return_counts=True)
                yield pa.RecordBatch.from_pydict({"w1": ids[pairs >> 32], "w2": ids[pairs & 0xFFFFFFFF], "n": n.astype(np.int64)})

    return run


# --- filters of word pairs ---


def _hash(*words: np.ndarray) -> np.ndarray:
    h = np.zeros(len(words[0]), np.uint64)
    for w in words:
        h = ta.mix(h * ta.M1 + w.view(np.uint64) + ta.M2)
    return h


class PairFilter:
    """A set of word pairs as bits; may hold more pairs than were put in, never fewer."""

    def __init__(self, pairs: DataFrame, most_bits: int):
        n = pairs.count()
        self.size = min(most_bits, 1 << max(15, (16 * n).bit_length()))
        places = self.places

        def spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for p in places(np.asarray(b["w1"]), np.asarray(b["w2"])):
                    yield pa.RecordBatch.from_pydict({"spot": p + 1})

        fields = pairs.select("w1", "w2").mapInArrow(spots, "spot long").groupBy(F.bitmap_bucket_number("spot").alias("bucket"))
        self.bits = np.zeros(self.size >> 3, np.uint8)
        for bucket, bits in fields.agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot"))).collect():  # ``size`` bits in all
            self.bits[(bucket - 1) << 12 : bucket << 12] = np.frombuffer(bits, np.uint8)[: self.size >> 3]

    def __getstate__(self):
        return {"size": self.size, "bits": getattr(self, "bits", None)}

    def places(self, w1: np.ndarray, w2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = _hash(w1, w2)
        return tuple((x & np.uint64(self.size - 1)).astype(np.int64) for x in (h, h >> np.uint64(32)))

    def holds(self, w1: np.ndarray, w2: np.ndarray) -> np.ndarray:
        a, b = self.places(w1, w2)
        return ((self.bits[a >> 3] >> (a & 7)) & (self.bits[b >> 3] >> (b & 7)) & 1).astype(bool)


# --- routing ---


def combined(rows: np.ndarray) -> np.ndarray:
    """Equal suffixes as one row; the last column is the multiplicity."""
    rows = rows[np.lexsort(rows[:, -2::-1].T)]
    first = np.flatnonzero(np.r_[True, (rows[1:, :-1] != rows[:-1, :-1]).any(1)]) if len(rows) else np.empty(0, np.int64)
    out = rows[first]
    out[:, -1] = np.add.reduceat(rows[:, -1], first) if len(rows) else 0
    return out


def _route(seed: int, longest: int, frequent, hot, buckets: int) -> Callable:
    """Arrow function: texts to (bucket, suffixes as bytes). Hot pairs' suffixes have buckets of their own, from ``buckets`` on."""

    def cut(lang: str, texts: pa.Array) -> np.ndarray:
        words, codes, left = suffixes(texts, longest)
        ids = np.r_[word_ids(lang, words, seed), 0]
        following = np.r_[codes[1:], len(words)]
        pair = np.zeros(len(codes) + longest, bool)  # the words here and next are a frequent pair
        at = np.flatnonzero(left > 1)
        pair[at] = frequent.value.holds(ids[codes[at]], ids[following[at]])
        depth, run = np.where(pair[: len(codes)], 2, 0), pair[: len(codes)]
        for k in range(2, longest):
            run = run & pair[k - 1 : k - 1 + len(codes)] & (left > k)
            depth += run
        at = np.flatnonzero(depth)
        rows = np.zeros((len(at), longest + 1), np.int64)
        for k in range(longest):
            inside = depth[at] > k
            rows[inside, k] = ids[codes[at[inside] + k]]
        rows[:, -1] = 1
        return rows

    def dealt(rows: np.ndarray) -> pa.RecordBatch:
        rows = combined(rows)
        bucket = (_hash(rows[:, 1], rows[:, 0]) % np.uint64(buckets)).astype(np.int64)
        wide = hot.value.holds(rows[:, 0], rows[:, 1])
        bucket[wide] = buckets + (_hash(*rows[wide, :-1].T.copy()) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(bucket[order]) > 0])
        data = [x.tobytes() for x in np.split(rows[order], starts[1:])]
        return pa.RecordBatch.from_pydict({"bucket": bucket[order][starts], "data": pa.array(data, pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            for lang, texts in _chunks(b):
                rows = combined(cut(lang, texts))
                held.append(rows)
                n += len(rows)
                if n >= HELD:
                    yield dealt(np.concatenate(held))
                    held, n = [], 0
        if n:
            yield dealt(np.concatenate(held))

    return run


# --- sorting a bucket ---


def multikey_quicksort(words: np.ndarray, n: np.ndarray, min_count: int, parts: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(phrases of one length, their counts) from suffixes ``words`` (0 where a suffix has ended) with multiplicities ``n``.

    All open segments are partitioned in one round. With ``parts``, counts of shorter phrases may be parts of the whole
    and none is abandoned.
    """
    longest = words.shape[1]
    pointers, size, depth = np.arange(len(words)), np.array([len(words)]), np.zeros(1, np.int64)
    while len(pointers):
        first = np.cumsum(size) - size
        segment = np.repeat(np.arange(len(size)), size)
        key = words[pointers, depth[segment]]
        a, b, c = key[first], key[first + size // 2], key[first + size - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))
        side = (key >= pivot[segment]).astype(np.int64) + (key > pivot[segment])  # 0 less, 1 equal, 2 greater
        group = 3 * segment + side
        sizes = np.bincount(group, minlength=3 * len(size)).reshape(-1, 3)
        starts = (np.cumsum(sizes) - sizes.ravel()).reshape(-1, 3)
        moved = np.empty_like(pointers)
        for s in range(3):
            mine = np.flatnonzero(side == s)
            before = np.cumsum(sizes[:, s]) - sizes[:, s]
            at = segment[mine]
            moved[starts[at, s] + np.arange(len(mine)) - before[at]] = pointers[mine]
        size, starts = sizes.ravel(), starts.ravel()
        depth = (depth[:, None] + np.array([0, 1, 0])).ravel()
        equal = np.arange(len(size)) % 3 == 1
        there = np.flatnonzero(size)
        count = np.zeros(len(size), np.int64)
        count[there] = np.add.reduceat(n[moved], starts[there])
        ended = equal & (np.repeat(pivot, 3) == 0)
        least = np.where(depth < longest, 1, min_count) if parts else min_count
        enough = (size > 0) & (count >= least) & ~ended
        whole = enough & equal & (depth > 1)
        for d in range(2, longest + 1):
            found = np.flatnonzero(whole & (depth == d))
            if len(found):
                yield words[moved[starts[found]], :d], count[found]
        going = enough & (depth < longest)
        pointers = moved[np.repeat(going, size)]
        size, depth = size[going], depth[going]


def _sort(longest: int, min_count: int, buckets: int) -> Callable[[pa.Table], pa.Table]:
    def sort(bucket: pa.Table) -> pa.Table:
        rows = np.concatenate([np.frombuffer(x, np.int64).reshape(-1, longest + 1) for x in bucket["data"].to_pylist()])
        phrases, counts = [pa.array([], pa.list_(pa.int64()))], [np.empty(0, np.int64)]
        for p, c in multikey_quicksort(rows[:, :-1], rows[:, -1], min_count, bucket["bucket"][0].as_py() >= buckets):
            phrases.append(pa.ListArray.from_arrays(np.arange(0, p.size + 1, p.shape[1], dtype=np.int32), p.ravel()))
            counts.append(c)
        return pa.table({"phrase": pa.concat_arrays(phrases), "n": np.concatenate(counts)})

    return sort


# --- the operator ---


def counts(docs: DataFrame, *, longest: int = 4, min_count: int = 30, bucket_rows: int = 500_000, filter_bits: int = 1 << 27) -> tuple[DataFrame, DataFrame]:
    """(words: lang, word, id, n), (phrases: ids, n): all words, and the phrases of 2 to ``longest`` words that are frequent."""
    sc = docs.sparkSession.sparkContext
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_column().alias("text"))
    seed = 0
    while True:
        words = texts.mapInArrow(_count_words(seed), "lang string, word string, id long, n long").groupBy("lang", "word", "id").agg(F.sum("n").alias("n"))
        words = stored(words, "collocation-words")
        if words.groupBy("id").count().where("count > 1").isEmpty():
            break
        seed += 1
    pairs = texts.mapInArrow(_count_pairs(seed), "w1 long, w2 long, n long").groupBy("w1", "w2").agg(F.sum("n").alias("n"))
    pairs = stored(pairs.where(F.col("n") >= min_count), "collocation-pairs")
    total = pairs.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-total // bucket_rows), min(2 * sc.defaultParallelism, total >> 15))
    frequent, hot = sc.broadcast(PairFilter(pairs, filter_bits)), sc.broadcast(PairFilter(pairs.where(F.col("n") > bucket_rows // 4), filter_bits))
    routed = texts.mapInArrow(_route(seed, longest, frequent, hot, buckets), "bucket long, data binary")
    found = routed.groupBy("bucket").applyInArrow(_sort(longest, min_count, buckets), "phrase array<long>, n long")
    phrases = found.groupBy("phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    phrases = stored(phrases, "collocation-phrases")
    frequent.destroy()
    hot.destroy()
    return words, phrases


def scored(words: DataFrame, phrases: DataFrame, *, share: int = 80) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the candidates that aren't dropped."""
    known = phrases.select("phrase", "n").unionByName(words.join(phrases.select(F.explode("phrase").alias("id")).distinct(), "id").select(F.array("id").alias("phrase"), "n"))
    size = F.size("phrase")
    cuts = phrases.select("phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumns({"left": F.slice("phrase", F.lit(1), F.col("k")), "right": F.slice("phrase", F.col("k") + 1, size - F.col("k"))})
    cuts = cuts.join(known.select(F.col("phrase").alias("left"), F.col("n").alias("l")), "left").join(known.select(F.col("phrase").alias("right"), F.col("n").alias("r")), "right")
    score = F.expr("(CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0))) div (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))")
    best = cuts.withColumn("score", score).groupBy("phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("cut"))
    parts = phrases.select(F.col("n"), "phrase", F.explode(F.sequence(F.lit(1), size - 1)).alias("start")).where(size > 2)
    parts = parts.select("n", F.explode(F.transform(F.sequence(F.lit(2), F.least(size - 1, size - F.col("start") + 1)), lambda m: F.slice("phrase", F.col("start"), m))).alias("phrase"))
    longer = parts.groupBy("phrase").agg(F.max("n").alias("longer"))
    kept = best.join(longer, "phrase", "left").where(F.col("longer").isNull() | F.expr(f"100 * CAST(longer AS DECIMAL(19,0)) < {share} * CAST(cut.a AS DECIMAL(19,0))"))
    spelt = kept.select("phrase", F.posexplode("phrase").alias("at", "id")).join(words.select("lang", "word", "id"), "id")
    spelt = spelt.groupBy("phrase").agg(F.first("lang").alias("lang"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("text"))
    return kept.join(spelt, "phrase").select("lang", F.col("text").alias("phrase"), "cut.a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, *, top: int = 2000, longest: int = 4, min_count: int = 30, share: int = 80, bucket_rows: int = 500_000, filter_bits: int = 1 << 27) -> DataFrame:
    """Each lang's first ``top`` collocations: lang, rank, phrase, a, l, r, n, score."""
    words, phrases = counts(docs, longest=longest, min_count=min_count, bucket_rows=bucket_rows, filter_bits=filter_bits)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored(words, phrases, share=share).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    n = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
