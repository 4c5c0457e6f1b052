"""Vectorised helpers over a batch of texts, used inside Arrow tasks.

A batch of texts is one ``uint8`` array plus offsets (text ``i`` is
``buf[off[i]:off[i + 1]]``), as Arrow stores it; nothing here loops per word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
M1, M2, M3 = U64(0x9E3779B97F4A7C15), U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LATIN_WORD = np.zeros(256, bool)  # letters, digits and every byte of a non-ASCII character
LATIN_WORD[48:58] = LATIN_WORD[65:91] = LATIN_WORD[97:123] = LATIN_WORD[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads all 64 bits (splitmix64)."""
    x = (x ^ (x >> U64(30))) * M2
    x = (x ^ (x >> U64(27))) * M3
    return x ^ (x >> U64(31))


def texts_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(buf, off) of a string or binary Arrow column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = pc.fill_null(pc.cast(column, pa.large_binary()), b"")
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    off = np.frombuffer(offs, np.int64, len(column) + 1, column.offset * 8)
    buf = np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[off[0] : off[-1]]
    return buf, off - off[0]


def words_of(
    buf: np.ndarray, off: np.ndarray, separator: np.ndarray, kind: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number) of each maximal run of bytes that are not separators.

    ``kind`` (byte to small number) also ends a word between bytes whose kinds are 1 and 2, in either order.
    """
    if not len(buf):
        z = np.empty(0, np.int64)
        return z, z, z
    keep = ~separator[buf]
    full = off[:-1] < off[1:]
    first = np.zeros(len(buf) + 1, bool)
    first[off[:-1][full]] = True
    first[off[1:][full]] = True
    joins = np.zeros(len(buf) + 1, bool)  # joins[i]: bytes i-1 and i belong to one word
    joins[1:-1] = keep[1:] & keep[:-1] & ~first[1:-1]
    if kind is not None:
        k = kind[buf]
        joins[1:-1] &= (k[1:] | k[:-1]) != 3
    start = np.flatnonzero(keep & ~joins[:-1])
    end = np.flatnonzero(keep & ~joins[1:]) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


def eight(buf: np.ndarray) -> np.ndarray:
    """A view whose element ``i`` is bytes ``i .. i + 7`` as one little-endian number (zeros past the end)."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    return np.ndarray((len(buf) + 1,), "<u8", buffer=padded.data, strides=(1,))


MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], U64)


def hash_words(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes and length."""
    view, n = eight(buf), end - start
    h = mix(n.astype(U64) * M1 + M2)
    live = np.arange(len(start))
    at = 0
    while len(live):
        left = n[live] - at
        got = view[start[live] + at] & MASKS[np.minimum(left, 8)]
        h[live] = mix((h[live] ^ got) * M1 + M3)
        at += 8
        live = live[left > 8]
    return h


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Concatenated ``arange(start[i], start[i] + length[i])``."""
    total = int(length.sum())
    if not total:
        return np.empty(0, np.int64)
    begin = np.cumsum(length) - length
    return np.repeat(start - begin, length) + np.arange(total)


def slices(off: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts whose bytes stay under ``most`` (a longer single text stands alone)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def gathered(batches: Iterable[pa.RecordBatch], column: int, most: int) -> Iterator[pa.Table]:
    """Join small record batches until they hold about ``most`` bytes."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.column(column).nbytes
        if size >= most:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)
