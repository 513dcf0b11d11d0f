"""Array kernels: words, n-grams and winnowed anchors of Arrow text batches.

All functions work on numpy arrays over the raw UTF-8 bytes of a batch, so
no Python object is made per word.  Hashes are 64-bit; every symbol passes a
mixer together with its place, so no word pattern cancels out by algebra (as
Thue-Morse words do in polynomial sums modulo 2**64).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one array step handles (a longer document is one step).
STEP_BYTES = 1 << 20

U64 = np.uint64
_rng = np.random.default_rng(20240229)
BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | U64(1)
GRAM_WEIGHT = _rng.integers(1, 2**63, 64, dtype=np.uint64) | U64(1)
BASE = U64(0x9E3779B97F4A7C15)
SECOND = U64(0xC2B2AE3D27D4EB4F)
#: Mask of the first k bytes of eight.
FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (in place on its own copy)."""
    h = h ^ (h >> U64(30))
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def byte_set(pattern_bytes: bytes) -> np.ndarray:
    """Boolean table of 256 entries, true for the given bytes."""
    out = np.zeros(256, bool)
    out[list(pattern_bytes)] = True
    return out


#: Separators of words ``[^\x20\x09-\x0D]+``.
WHITE = byte_set(bytes([0x20, 9, 10, 11, 12, 13]))
#: Separators of words made of ASCII letters, digits and any non-ASCII byte.
NOT_ALNUM = byte_set(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
#: Lower case of the ASCII letters.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string column; null is empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets


def steps(offsets: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose bytes stay under the limit (or a single row)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def words(data: np.ndarray, bounds: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and word offsets per document.

    ``bounds`` are the documents' byte offsets within ``data`` (from 0).
    """
    inside = ~separator[data]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    edges = bounds[:-1][bounds[:-1] < len(data)]
    before[edges] = False
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    edges = bounds[1:]
    after[edges[edges > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(start, bounds).astype(np.int64)


def _blocks(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eight-byte blocks of the spans in a row (the last one of a span filled
    up with zeros), each block's number in its span, and each span's first block."""
    count = (length + 7) >> 3
    first = np.concatenate(([0], np.cumsum(count)[:-1]))
    number = np.arange(int(count.sum())) - np.repeat(first, count)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data),), "<u8", padded, strides=(1,))
    left = np.minimum(np.repeat(length, count) - 8 * number, 8)
    return eight[np.repeat(start, count) + 8 * number] & FIRST_BYTES[left], number, first


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span (none empty): the sum of its mixed
    eight-byte blocks, each mixed once more with its number."""
    if not len(start):
        return np.zeros(0, U64)
    length = end - start
    block, number, first = _blocks(data, start, length)
    block = mix(mix(block) + (number + 1).astype(U64) * BASE)
    return mix(np.add.reduceat(block, first) + length.astype(U64) * SECOND)


def same_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, other: np.ndarray, other_end: np.ndarray) -> bool:
    """Are all spans equal to the other ones, byte by byte?"""
    length = end - start
    if not np.array_equal(length, other_end - other):
        return False
    return not len(start) or np.array_equal(_blocks(data, start, length)[0], _blocks(data, other, length)[0])


def grams(symbols: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive symbols, document bounds not regarded."""
    m = len(symbols) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    total = symbols[:m] * GRAM_WEIGHT[0]
    for j in range(1, n):
        total += symbols[j: j + m] * GRAM_WEIGHT[j]
    return mix(total)


def pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two hashes in order."""
    h = left * BASE
    h += ((right << U64(32)) | (right >> U64(32))) * SECOND
    h ^= h >> U64(29)
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(32)
    return h


def window_hashes(symbols: np.ndarray, *sizes: int) -> list[np.ndarray]:
    """Hashes of every ``size`` consecutive symbols, per size: windows of
    powers of two pair up, and two of them cover a window."""
    out: dict[int, np.ndarray] = {}
    level, have = symbols, 1
    while True:
        for size in sizes:
            if have <= size < 2 * have:
                n = max(len(symbols) - size + 1, 0)
                out[size] = pair(level[:n], level[size - have: size - have + n])
        if 2 * have > max(sizes):
            return [out[size] for size in sizes]
        level = pair(level[: max(len(level) - have, 0)], level[have:])
        have *= 2


def sliding_min(keys: np.ndarray, w: int) -> np.ndarray:
    """Least key of each w consecutive keys (block prefix and suffix minima)."""
    n = len(keys)
    if n < w:
        return np.zeros(0, keys.dtype)
    padded = np.full(-(-n // w) * w, np.iinfo(keys.dtype).max, keys.dtype)
    padded[:n] = keys
    rows = padded.reshape(-1, w)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - w + 1], left[w - 1: n])


def runs(symbols: np.ndarray, bounds: np.ndarray, window: int, gram: int, contents: bool = True) -> dict[str, np.ndarray]:
    """Runs of consecutive windows that share their anchor (super-k-mers).

    Every window of ``window`` symbols selects the n-gram of ``gram``
    symbols with the smallest hash in it, the leftmost of equals; equal
    windows select the same one.  Consecutive windows with the same anchor
    form a run, of at most ``window`` windows, so its first and last window
    cover it.  Returns per run: doc (index), start (symbol within the
    document), n (windows), anchor (hash of the n-gram) and content (hash of
    the symbols the run covers; left out without ``contents``).
    """
    out: list[tuple] = []
    size, w = 1 << 19, window - gram + 1
    total = len(symbols)
    at = 0
    while at + window <= total:
        part = symbols[at: at + size + window - 1]
        hashes, *whole = window_hashes(part, gram, window) if contents else window_hashes(part, gram)
        index = np.arange(len(hashes))
        least = sliding_min((hashes & ~U64((1 << 20) - 1)) | index.astype(U64), w)
        anchor = (least & U64((1 << 20) - 1)).astype(np.int64)
        begin = np.arange(len(anchor)) + at
        doc = np.searchsorted(bounds, begin, "right") - 1
        valid = begin + window <= bounds[doc + 1]
        begin, doc, anchor = begin[valid], doc[valid], anchor[valid]
        if len(begin):
            new = np.ones(len(begin), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | (begin[1:] != begin[:-1] + 1)
            first = np.flatnonzero(new)
            count = np.diff(np.append(first, len(begin)))
            lo = begin[first] - at
            out.append((doc[first], begin[first] - bounds[doc[first]], count, hashes[anchor[first]],
                        *(mix(pair(x[lo], x[lo + count - 1]) + count.astype(U64)) for x in whole)))
        at += size
    names = ["doc", "start", "n", "anchor", *(["content"] if contents else [])]
    if not out:
        out = [tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, U64, U64)[: len(names)])]
    return dict(zip(names, map(np.concatenate, zip(*out, strict=True)), strict=True))
