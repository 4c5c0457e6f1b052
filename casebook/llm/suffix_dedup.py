"""Removal of repeated byte strings by blockwise suffix sorting with cover-sample ranks.

Every byte covered by a ``LENGTH``-byte string that also starts earlier (smaller doc_id, or earlier in the same
document) is removed; strings are judged on the input and never cross documents.

All suffixes of a corpus don't fit one task, so they are dealt to buckets and one bucket is sorted at a time:

1. *Dealing.* A suffix's first ``LENGTH`` bytes name an anchor: the leftmost ``GRAM``-byte piece of least hash. Equal
   strings have the same anchor at the same place, so they meet in the bucket of the anchor's hash. Neighbouring
   suffixes share an anchor and travel as one span of text (about 45 suffixes in 144 bytes); spans are packed
   into one compressed block for each task step and bucket. Equal spans of a step collapse before the shuffle:
   only the earliest travels with its text.
2. *Sorting.* A bucket's spans are aligned at their anchors, which makes any two suffixes that could tie congruent
   modulo the cover's period; so one residue per period is a difference cover for them. The sample suffixes at that
   residue are ranked first (``LENGTH - PERIOD`` bytes each). Then the bucket's suffixes are sorted block by block by
   their first ``PERIOD`` bytes, and ties are resolved by the precomputed rank of the next sample suffix and the last
   bytes, never by comparing on. In a tied class all but the earliest suffix are marked.
3. *Cutting.* Marked runs are gathered by document and cut out.

Memory is bounded by the block and bucket sizes, whose number grows with the input; of a string that occurs in
each task step, a bucket holds one span a step.

Edge cases: null text counts as empty; texts shorter than ``LENGTH`` stay whole; a null doc_id is smaller than all
others; rows that repeat a doc_id with other text are separate documents with the same place in the order, so
neither makes the other's string at the same offset a later one, and rows that repeat both keep the same bytes; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm import textarray as ta
from casebook.llm.textarray import U64

LENGTH, GRAM, PERIOD = 100, 12, 16
STEP = 1 << 20  # bytes anchored at once
LONGEST = 8 << 20  # longer texts are dealt in overlapping pieces
EMIT = 12 << 20  # bytes of text between two outputs of a task
BLOCK = 4 << 20  # bytes of spans sorted at once
BUCKET = 32 << 20  # aimed-at bytes of spans in a bucket
SPREAD = 3.4  # bytes of spans for each byte of text
LEAST_ID = -(1 << 63)


class Spans:
    """Columns of spans: document key, offset of the first suffix, number of suffixes, place of the anchor, text."""

    def __init__(self, doc, row, off, cnt, anc, base, buf):
        self.doc, self.row, self.off, self.cnt, self.anc, self.base, self.buf = doc, row, off, cnt, anc, base, buf

    def take(self, at: np.ndarray) -> "Spans":
        return Spans(self.doc[at], self.row[at], self.off[at], self.cnt[at], self.anc[at], self.base[at], self.buf)

    @property
    def size(self) -> np.ndarray:
        return self.cnt + (LENGTH - 1)

    def __len__(self) -> int:
        return len(self.doc)

    def packed(self) -> "Spans":
        """The same with its texts side by side."""
        buf = self.buf[ta.ragged(self.base, self.size)]
        return Spans(self.doc, self.row, self.off, self.cnt, self.anc, np.cumsum(self.size) - self.size, buf)


def anchors(buf: np.ndarray) -> np.ndarray:
    """For each suffix start: hash (upper 40 bits) and place (lower 24) of the anchor of the next LENGTH bytes."""
    n = len(buf) - GRAM + 1
    view = ta.eight(buf)
    h = view[:n] * ta.M1
    h ^= h >> U64(29)
    tail = view[GRAM - 8 : GRAM - 8 + n] * ta.M3
    tail ^= tail >> U64(31)
    h += tail
    h *= ta.M2
    h ^= h >> U64(32)
    h &= U64(0xFFFFFFFFFF000000)
    h |= np.arange(n, dtype=U64)
    window, reach = LENGTH - GRAM + 1, 1
    while reach * 2 <= window:
        h = np.minimum(h[:-reach], h[reach:])
        reach *= 2
    rest = window - reach
    return np.minimum(h[:-rest], h[rest:]) if rest else h


def spans_of(doc: np.ndarray, row: np.ndarray, shift: np.ndarray, buf: np.ndarray, off: np.ndarray) -> tuple[Spans, np.ndarray]:
    """All spans of some texts, and their anchors' hashes; ``shift`` is added to offsets."""
    many = np.maximum(np.diff(off) - LENGTH + 1, 0)
    p = ta.ragged(off[:-1], many)
    if not len(p):
        z = np.empty(0, np.int64)
        return Spans(z, z, z, z, z, z, buf), np.empty(0, U64)
    key = anchors(buf)[p]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    start, cnt = p[first], np.diff(np.append(first, len(p)))
    place = (key[first] & U64(0xFFFFFF)).astype(np.int64)
    text = np.repeat(np.arange(len(many)), many)[first]
    return Spans(doc[text], row[text], start - off[text] + shift[text], cnt, place - start, start, buf), key[first] >> U64(24)


def combined(s: Spans) -> tuple[np.ndarray, np.ndarray]:
    """(indices of the earliest span of each content, indices of later equal spans). 128 bits stand for the content."""
    if not len(s):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a = ta.hash_words(s.buf, s.base, s.base + s.size)
    b = ta.hash_words(s.buf, s.base + 1, s.base + s.size - 3) ^ (s.anc.astype(U64) * ta.M1)
    order = np.lexsort((s.off, s.doc, b, a))
    new = np.ones(len(s), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    head = order[np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))]
    later = (s.doc[order] != s.doc[head]) | (s.off[order] != s.off[head])  # the same place is not earlier
    return np.sort(order[new]), order[~new & later]


def _planes(x: np.ndarray, width: int) -> bytes:
    """Numbers as byte planes, which compress well where they are small or sorted."""
    return np.ascontiguousarray(x.astype(f"<i{width}")).view(np.uint8).reshape(-1, width).T.tobytes()


def _unplanes(data: memoryview, n: int, width: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, n * width).reshape(width, n).T).view(f"<i{width}").ravel().astype(np.int64)


FIELDS = (("doc", 8), ("row", 8), ("off", 8), ("cnt", 1), ("anc", 1))


def to_block(s: Spans, known: Spans) -> bytes:
    """Spans with text, and ``known`` ones, already found to be later copies, without."""
    parts = [np.array([len(s), len(known)], "<i8").tobytes()]
    for x in (s, known):
        parts += [_planes(np.diff(getattr(x, f), prepend=0) if f == "doc" else getattr(x, f), w) for f, w in FIELDS]
    return zstandard.ZstdCompressor(level=3).compress(b"".join([*parts, s.packed().buf.tobytes()]))


def from_block(block: bytes) -> tuple[Spans, Spans]:
    data = memoryview(zstandard.ZstdDecompressor().decompress(block))
    out, at = [], 16
    for n in np.frombuffer(data[:16], "<i8").tolist():
        got = {}
        for f, w in FIELDS:
            got[f] = _unplanes(data[at : at + n * w], n, w)
            at += n * w
        got["doc"] = np.cumsum(got["doc"])
        size = got["cnt"] + LENGTH - 1
        out.append(Spans(**got, base=np.cumsum(size) - size, buf=None))
    out[0].buf = np.frombuffer(data[at:], np.uint8)
    return out[0], out[1]


def deal(buckets: int):
    """Arrow task: texts to (bucket, block) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[Spans, np.ndarray]] = []

        def emit() -> Iterator[pa.RecordBatch]:
            s, where = joined([x for x, _ in held]), np.concatenate([w for _, w in held]).astype(np.int64)
            held.clear()
            first, later = combined(s)
            texts, known = [], []
            for at, out in ((first, texts), (later, known)):
                order = at[np.lexsort((s.off[at], s.doc[at], where[at]))]
                out += np.split(order, np.searchsorted(where[order], np.arange(1, buckets)))
            used = [k for k in range(buckets) if len(texts[k]) or len(known[k])]
            for i in range(0, len(used), 64):
                part = used[i : i + 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int32()), pa.array([to_block(s.take(texts[k]), s.take(known[k])) for k in part], pa.binary())], names=["bucket", "block"]
                )

        waiting = 0
        for t in ta.gathered(batches, 2, STEP):
            doc, row = (t.column(c).to_numpy().astype(np.int64) for c in (0, 1))
            buf, off = ta.texts_of(t.column(2))
            for i, j in ta.slices(off, STEP):
                if off[j] - off[i] <= LONGEST:
                    pieces = [(doc[i:j], row[i:j], np.zeros(j - i, np.int64), buf[off[i] : off[j]], off[i : j + 1] - off[i])]
                else:
                    cuts = range(0, int(off[j] - off[i]), LONGEST)
                    pieces = []
                    for c in cuts:
                        b = buf[off[i] + c : min(off[i] + c + LONGEST + LENGTH - 1, off[j])]
                        pieces.append((doc[i:j], row[i:j], np.array([c]), b, np.array([0, len(b)])))
                for piece in pieces:
                    s, h = spans_of(*piece)
                    if len(s):
                        held.append((s, h % U64(buckets)))
                        waiting += len(piece[3])
                    if waiting >= EMIT:
                        yield from emit()
                        waiting = 0
        if held:
            yield from emit()

    return run


def joined(some: list[Spans]) -> Spans:
    shift = np.cumsum([0] + [len(x.buf) for x in some])
    cols = {f: np.concatenate([getattr(x, f) for x in some]) for f, _ in FIELDS}
    return Spans(**cols, base=np.concatenate([x.base + d for x, d in zip(some, shift, strict=False)]), buf=np.concatenate([x.buf for x in some]))


def ranks(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): a sort of the rows by all columns, equal rows side by side, and where a new class begins.

    Rows are sorted by a 64-bit mix of the columns; neighbours are then compared in full, and should two
    differing rows share a mix, the columns themselves are sorted.
    """
    h = np.zeros(len(columns[0]), U64)
    for c in columns:
        h = (h ^ c) * ta.M1
        h ^= h >> U64(32)
    order = np.argsort(h)
    h = h[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    same = np.flatnonzero(~new)
    if any((c[order[same]] != c[order[same - 1]]).any() for c in columns):
        order = np.lexsort(columns)
        new[1:] = np.any([c[order][1:] != c[order][:-1] for c in columns], axis=0)
    return order, new


def later_suffixes(s: Spans) -> np.ndarray:
    """Marks (one for each suffix, span after span) of suffixes whose LENGTH bytes also start earlier.

    Spans come sorted by anchor, then place, so the least index of a class is its earliest suffix.
    """
    s = s.packed()
    view = ta.eight(np.concatenate([s.buf, np.zeros(PERIOD, np.uint8)]))
    residue = s.anc % PERIOD
    samples = np.maximum(-(-(s.cnt - 1 - residue) // PERIOD), 0) + 1
    at = np.repeat(s.base + residue, samples) + ta.ragged(np.zeros(len(s), np.int64), samples) * PERIOD
    cover = LENGTH - PERIOD
    order, new = ranks([view[at + k] for k in [*range(0, cover - 7, 8), cover - 8]])
    rank = np.empty(len(at), np.int64)
    rank[order] = np.cumsum(new)
    i = ta.ragged(np.zeros(len(s), np.int64), s.cnt)
    p = np.repeat(s.base, s.cnt) + i
    gap = (np.repeat(residue, s.cnt) - i) % PERIOD
    sample = np.repeat(np.cumsum(samples) - samples, s.cnt) + (i + gap - np.repeat(residue, s.cnt)) // PERIOD
    order, new = ranks([view[p], view[p + 8], (rank[sample] * PERIOD + gap).astype(U64), view[p + LENGTH - 16], view[p + LENGTH - 8]])
    begins = np.flatnonzero(new)
    first = np.empty(len(p), np.int64)
    first[order] = np.repeat(np.minimum.reduceat(order, begins), np.diff(np.append(begins, len(p))))
    span = np.repeat(np.arange(len(s)), s.cnt)
    place = s.off[span] + i
    return (s.doc[span] != s.doc[span[first]]) | (place != place[first])


def runs(s: Spans, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc, row, start, stop) of the bytes that runs of marked suffixes cover, span by span."""
    span = np.repeat(np.arange(len(s)), s.cnt)
    i = ta.ragged(np.zeros(len(s), np.int64), s.cnt)
    edge = np.ones(len(marks), bool)
    edge[1:] = ~marks[:-1] | (i[1:] == 0)
    begin = np.flatnonzero(marks & edge)
    edge[:-1] = ~marks[1:] | (i[1:] == 0)
    edge[-1:] = True
    end = np.flatnonzero(marks & edge)
    k = span[begin]
    return s.doc[k], s.row[k], s.off[k] + i[begin], s.off[k] + i[end] + LENGTH


def sort_bucket(table: pa.Table) -> pa.Table:
    """All blocks of a bucket to the covered byte ranges of its later suffixes."""
    texts, known = zip(*(from_block(b.as_py()) for b in table.column("block")), strict=True)
    s = joined(list(texts))
    first, later = combined(s)
    copies = [*known, s.take(later)]
    out = [tuple(np.concatenate(c) for c in zip(*[(x.doc, x.row, x.off, x.off + x.size) for x in copies], strict=True))]
    s = s.take(first)
    anchor = ta.hash_words(s.buf, s.base + s.anc, s.base + s.anc + GRAM)
    order = np.lexsort((s.off, s.doc, anchor))
    s, anchor = s.take(order), anchor[order]
    new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])) if len(s) else np.empty(0, np.int64)
    many = np.diff(np.append(new, len(s)))
    live = np.repeat(many > 1, many)  # a single span's suffixes can only tie with its own neighbours' spans
    s, many = s.take(np.flatnonzero(live)), many[many > 1]
    ends = np.cumsum(many)
    filled = np.cumsum(s.size)
    i = 0
    while i < len(ends):
        begin = ends[i] - many[i]
        before = filled[begin - 1] if begin else 0
        j = max(i + 1, int(np.searchsorted(filled[ends - 1], before + BLOCK, "right")))
        part = s.take(np.arange(begin, ends[j - 1]))
        out.append(runs(part, later_suffixes(part)))
        i = j
    cols = [np.concatenate(c) for c in zip(*out, strict=True)]
    return pa.table([pa.array(c, pa.int64()) for c in cols], names=["_id", "_row", "start", "stop"])


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the ranges to remove, to digests and the remaining bytes."""
    for b in batches:
        buf, off = ta.texts_of(b.column(1))
        rows = []
        for k, (starts, stops) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)):
            text = buf[off[k] : off[k + 1]]
            if not starts:
                rows.append((len(text), 0, 0, text.tobytes()))
                continue
            order = np.argsort(starts, kind="stable")
            lo, hi = np.array(starts)[order], np.maximum.accumulate(np.array(stops)[order])
            first = np.concatenate([[True], lo[1:] > hi[:-1]])  # ranges that touch are one maximal run
            lo, hi = lo[first], hi[np.append(np.flatnonzero(first)[1:] - 1, len(hi) - 1)]
            edges = np.concatenate([[0], np.column_stack([lo, hi]).ravel(), [len(text)]])
            left = b"".join(text[x:y].tobytes() for x, y in edges.reshape(-1, 2))
            rows.append((len(text), int((hi - lo).sum()), len(lo), left))
        n, gone, spans, left = zip(*rows, strict=True) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), *[pa.array(x, pa.int64()) for x in (n, gone, spans)], pa.array([hashlib.sha256(x).hexdigest() for x in left], pa.string()), pa.array(left, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the remaining bytes)."""
    doc_id = F.col("doc_id").cast("long")
    texts = docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(LEAST_ID)).alias("_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    repeated = not texts.groupBy("_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    texts = texts.withColumn("_row", F.xxhash64("text") if repeated else F.lit(0).cast("long"))
    buckets = max(8, int(total * SPREAD) // BUCKET)
    gone = (
        texts.select("_id", "_row", "text")
        .where(F.octet_length("text") >= LENGTH)
        .mapInArrow(deal(buckets), "bucket int, block binary")
        .groupBy("bucket")
        .applyInArrow(sort_bucket, "_id long, _row long, start long, stop long")
        .groupBy("_id", "_row")
        .agg(F.collect_list(F.struct("start", "stop")).alias("_gone"))
    )
    return (
        texts.join(gone, ["_id", "_row"], "left")
        .select("doc_id", "text", F.col("_gone.start").alias("starts"), F.col("_gone.stop").alias("stops"))
        .mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    )
