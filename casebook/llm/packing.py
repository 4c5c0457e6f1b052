"""Hierarchical multi-length packing of tokenised documents.

Each document becomes its token ids followed by an end id. Within a task, documents are gathered
into groups of about ``group_tokens`` tokens. A group is packed by size tiers:

1. a document is cut into full windows of the largest tier; its rest goes to the smallest tier that holds it;
2. each tier, from the longest, opens a window for its longest waiting piece and fills the gap with the
   longest pieces of the same and shorter tiers that fit, then with a cut of the shortest piece that does not;
3. what is left when pieces run out is closed at powers of two down to ``least``, so that only the last
   window of a group can hold padding;
4. windows are dealt to step groups, longest first, each to the step group with the fewest tokens.

Nothing is shuffled: memory is bounded by one group, and a retried task gives the same pieces and ids,
since sequence ids combine the partition number with a running number.

Edge cases: null or empty text gives the end id alone; repeated rows are packed each by itself; a null
doc_id is carried along; an empty table gives no rows; other columns of the input are ignored. A text of any
length is tokenised whole. The tokenizer's vocabulary file is a parameter and is read on the workers.
"""

from __future__ import annotations

import bisect
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm import textarray as ta

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, tier long, step_group long"
)
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0D]] = True
# Letters never share a token with other ASCII signs here. The apostrophe (contractions) and the signs of special tokens keep their neighbours.
KIND = np.zeros(256, np.uint8)
KIND[33:127] = 2
KIND[65:91] = KIND[97:123] = 1
KIND[[ord(c) for c in "'<|>"]] = 0
SEPARATORS = "жשあ한ღ"  # letters tried as separators between unknown words; a batch uses one that none of its words has

PROBES = [  # texts on which splits at blanks, case and signs would show
    "The QUICK brown Fox's fox doesn't, isn't; can't",
    "a-b c_d e.f 3.14 1,000 x=y (z) [q] {r} <s> #t @u",
    "  two  blanks\tand\nlines\r\n end ",
    "Éric ÉTÉ straße ÜBER naïve İ 日本語 \U0001f600 é́ \u00a0x",
    "abc123 123abc ABC...!?? 'quoted' \"double\" it's",
    "",
]

_coders: dict[str, "Coder"] = {}


class Coder:
    """Ids of texts. White space always splits this kind of vocabulary's words, so each distinct word is encoded once.

    The memo is bounded by ``most`` words and kept by the Python worker from task to task.
    """

    def __init__(self, path: str, most: int = 2_000_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.clear()
        self.by_word = True
        self.by_word = self._agrees()

    def _agrees(self) -> bool:
        """Whether encoding word by word gives this vocabulary's ids of whole texts. Else texts are encoded whole."""
        raw = [x.encode() for x in PROBES]
        ids, off = self.batch(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), 0)
        same = all(ids[a : b - 1].tolist() == x for a, b, x in zip(off[:-1], off[1:], self._plain(PROBES), strict=True))
        self.clear()
        return same

    def whole(self, buf: np.ndarray, off: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        raw = buf.tobytes()
        each = self._plain([raw[a:b].decode("utf-8", "replace") for a, b in zip(off[:-1], off[1:], strict=True)])
        ids = [np.array([*x, end_id], np.uint32) for x in each]
        return np.concatenate([np.empty(0, np.uint32), *ids]), np.cumsum([0, *map(len, ids)])

    def clear(self) -> None:
        self.keys = np.empty(0, np.uint64)  # sorted word hashes
        self.begin, self.count = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids, self.used = np.empty(1 << 16, np.uint32), 0

    def _plain(self, words: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, their number) of all words; words are joined by a one-id separator, far cheaper than a call a word."""
        text = "".join(words)
        mark = next((m[0] for s in SEPARATORS if s not in text and len(m := self._plain([s])[0]) == 1 and (sign := s)), None)
        ids, count = [], []
        for i in range(0, len(words), 1000):
            part = words[i : i + 1000]
            if mark is not None:
                got = np.array(self._plain([f" {sign} ".join(part)])[0], np.int64)
                cut = np.flatnonzero(got == mark)
                if len(cut) == len(part) - 1:
                    ids.append(got[got != mark])
                    count.append(np.diff(cut, prepend=-1, append=len(got)) - 1)
                    continue
            each = self._plain(part)
            ids.append(np.array([i for x in each for i in x], np.int64))
            count.append(np.array([len(x) for x in each], np.int64))
        return np.concatenate(ids), np.concatenate(count)

    def learn(self, keys: np.ndarray, words: list[str]) -> None:
        flat, count = self.encode(words)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        self.ids[self.used : self.used + len(flat)] = flat
        begin = self.used + np.cumsum(count) - count
        self.used += len(flat)
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.begin = np.insert(self.begin, at, begin)
        self.count = np.insert(self.count, at, count)

    def batch(self, buf: np.ndarray, off: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, token offsets) of all texts of a batch, each followed by ``end_id``."""
        if not self.by_word:
            return self.whole(buf, off, end_id)
        if b"<|" in (raw := buf.tobytes()):  # may spell a special token: leave case and signs alone
            start, end, doc = ta.words_of(buf, off, BLANK)
        else:
            buf = ta.LOWER[buf]  # the vocabulary lowers all letters
            raw = buf.tobytes()
            start, end, doc = ta.words_of(buf, off, BLANK, KIND)
        keys, first, inverse = np.unique(ta.hash_words(buf, start, end), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.most:
            self.clear()
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        new = np.ones(len(keys), bool) if not len(self.keys) else self.keys[at] != keys
        if new.any():
            f = first[new]
            self.learn(keys[new], [raw[a:b].decode("utf-8", "replace") for a, b in zip(start[f], end[f], strict=True)])
            at = np.searchsorted(self.keys, keys)
        at = at[inverse] if len(keys) else np.empty(0, np.int64)
        count = self.count[at] if len(at) else np.empty(0, np.int64)
        n = np.bincount(doc, weights=count, minlength=len(off) - 1).astype(np.int64) if len(doc) else np.zeros(len(off) - 1, np.int64)
        ends = np.cumsum(n + 1)
        out = np.full(int(ends[-1]) if len(ends) else 0, end_id, np.uint32)
        place = np.ones(len(out), bool)
        place[ends - 1] = False
        out[place] = self.ids[ta.ragged(self.begin[at], count)] if len(at) else 0
        return out, np.concatenate([[0], ends])


def coder(path: str) -> Coder:
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def pack_lengths(lengths: list[int], tiers: tuple[int, ...], least: int) -> list[list[tuple[int, int, int]]]:
    """Windows of (document, start, length) pieces over documents of the given lengths (see the module text)."""
    top = tiers[-1]
    windows: list[list[tuple[int, int, int]]] = []
    waiting: list[list[tuple[int, int, int]]] = [[] for _ in tiers]  # by tier, sorted (length, document, start)

    def put(length: int, doc: int, start: int) -> None:
        if length:
            bisect.insort(waiting[bisect.bisect_left(tiers, length)], (length, doc, start))

    first: list[list[tuple[int, int, int]]] = [[] for _ in tiers]
    for doc, n in enumerate(lengths):
        for start in range(0, n - top + 1, top):
            windows.append([(doc, start, top)])
        if rest := n % top:
            first[bisect.bisect_left(tiers, rest)].append((rest, doc, n - rest))
    for k, pieces in enumerate(first):
        waiting[k] = sorted(pieces)
    for k in range(len(tiers) - 1, -1, -1):
        while waiting[k]:
            size = tiers[k]
            length, doc, start = waiting[k].pop()
            window, gap = [(doc, start, length)], size - length
            while gap:
                fits = None
                for t in range(min(k, bisect.bisect_left(tiers, gap)), -1, -1):  # the longest piece that fits
                    if i := bisect.bisect_right(waiting[t], (gap, len(lengths), 0)):
                        fits = t, i - 1
                        break
                if fits:
                    length, doc, start = waiting[fits[0]].pop(fits[1])
                    window.append((doc, start, length))
                    gap -= length
                    continue
                longer = next((t for t in range(min(k, bisect.bisect_left(tiers, gap)), k + 1) if waiting[t]), None)
                if longer is None:
                    break
                length, doc, start = waiting[longer].pop(0)  # all wait with more than the gap: cut the shortest
                window.append((doc, start, gap))
                put(length - gap, doc, start + gap)
                gap = 0
            windows += [window] if not gap else close(window, least)
    return windows


def close(window: list[tuple[int, int, int]], least: int) -> list[list[tuple[int, int, int]]]:
    """Split an unfilled window into full power-of-two windows and at most one padded rest below ``least``."""
    out: list[list[tuple[int, int, int]]] = []
    total = sum(x[2] for x in window)
    todo = list(reversed(window))
    while total:
        size = 1 << (total.bit_length() - 1)
        size = size if size >= least else total
        total -= size
        part: list[tuple[int, int, int]] = []
        while size:
            doc, start, length = todo.pop()
            took = min(size, length)
            part.append((doc, start, took))
            if took < length:
                todo.append((doc, start + took, length - took))
            size -= took
        out.append(part)
    return out


def step_groups(sizes: list[int], step_tokens: int) -> list[int]:
    """The step group of each window: longest window first, each to the group with the fewest tokens."""
    n = max(1, -(-sum(sizes) // step_tokens))
    heap = [(0, g) for g in range(n)]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        held, g = heapq.heappop(heap)
        out[i] = g
        heapq.heappush(heap, (held + sizes[i], g))
    return out


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    end_id: int = 2,
    tiers: tuple[int, ...] = (512, 1024, 2048, 4096),
    group_tokens: int = 1 << 21,
    step_tokens: int = 1 << 16,
    least: int = 64,
) -> DataFrame:
    """Pack ``docs`` (doc_id, text): one row per piece, see ``SCHEMA``.

    ``start`` counts the document's ids before the piece, ``offset`` is its place in the sequence,
    ``tier`` the smallest power of two that holds the sequence, ``step_group`` its step group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, base, held = coder(tokenizer), (TaskContext.get() or _Zero).partitionId() << 32, [0, 0]
        ids_held: list[np.ndarray] = []
        docs_held: list[tuple[int | None, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            windows = pack_lengths([len(x) for _, x in docs_held], tiers, least)
            steps = step_groups([sum(p[2] for p in w) for w in windows], step_tokens)
            rows: list[tuple] = []
            for w, step in zip(windows, steps, strict=True):
                at, total = 0, sum(p[2] for p in w)
                for doc, start, length in w:
                    doc_id, ids = docs_held[doc]
                    crc = zlib.crc32(ids[start : start + length].astype("<u4").tobytes())
                    rows.append((doc_id, start, length, crc, len(ids), base + held[0], at, 1 << (total - 1).bit_length(), base + held[1] + step))
                    at += length
                held[0] += 1
            held[1] += max(steps, default=-1) + 1
            docs_held.clear()
            ids_held.clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=[x.split()[0] for x in SCHEMA.split(", ")])

        waiting = 0
        for t in ta.gathered(batches, 1, 1 << 20):
            names, (buf, off) = t.column(0).to_pylist(), ta.texts_of(t.column(1))
            for i, j in ta.slices(off, 1 << 20):
                ids, ends = code.batch(buf[off[i] : off[j]], off[i : j + 1] - off[i], end_id)
                for k in range(j - i):
                    docs_held.append((names[i + k], ids[ends[k] : ends[k + 1]]))
                waiting += len(ids)
                if waiting >= group_tokens:
                    yield from flush()
                    waiting = 0
        yield from flush()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


class _Zero:
    """Stands in for the task context where a test calls the function outside Spark."""

    @staticmethod
    def partitionId() -> int:
        return 0
