"""Benchmark items inside documents: size-partitioned MinHash containment.

Items are few and short, documents many and long.  Items are partitioned by
size (shingles, up to u = 8, 16, 32, ...).  For a partition the documents are
cut into windows of 2u shingles that step by u, so a passage of one item
lies within one window and containment turns into a Jaccard similarity of
about a fifth or more.  Window minima are built from minima of 8 shingles, so
the documents are hashed once for all sizes.  A window and an item that have
one of ``HASHES`` MinHash values in common are a candidate, and a candidate
is verified by exact shingle containment in the whole document.  An item of
at most ``FEW`` shingles would be too small a part of its window; every
document that holds any of its shingles is a candidate.

The items are a stored table of shingles and keys (a key is a MinHash value
with its size and band); they never pass the driver or a closure.  The tasks
get a bit filter of all these hashes, of ``FILTER_BITS`` bits at most: a
MinHash value stands for one shingle, so a document without a shingle in the
filter shares no value with any item.  What passes the filter by chance or
because the filter is full costs rows, never results.  The documents are
mapped once; only those with a key in the filter are stored, with their keys
and their shingles in the filter, and joined with the items: by key for the
candidates, by (document, shingle) for the verification.  A passage or item
that many documents hold is dealt out over ``SALTS`` parts of its key.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z in
lower case; a shingle is five of them, compared by its 64-bit hash.  An item
of fewer than five words is one shingle of all its words.  An item without
words, a null or empty text: no match.  A very long text is one array step.
Repeated rows match alike, documents of one id are told apart, every item row
is matched on its own; an empty table on either side gives an empty result;
further columns are not read (``drop_contaminated`` keeps them, whatever their
names).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from txrisk.llm import tokens as K
from txrisk.llm.common import stored

SHINGLE = 5
HASHES = 64
CONTAINMENT = 0.8
LEAST_WINDOW = 8
#: Items of at most so many shingles are looked up by the shingles themselves.
FEW = 4
#: Largest filter sent to the tasks (32 MB), and bits per hash below that.
FILTER_BITS = 1 << 28
BITS_PER_HASH = 1024
#: Parts over which the documents of one key or item are dealt.
SALTS = 16
#: Bits of one row of the filter while it is aggregated.
FILTER_ROW = 1 << 15

_MULTIPLIER = np.random.default_rng(7).integers(1, 2**63, HASHES, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
#: Inverses modulo 2**64: a MinHash value times its inverse is the shingle.
_INVERSE = np.array([pow(int(m), -1, 1 << 64) for m in _MULTIPLIER], np.uint64)


def _tagged(x: np.ndarray, tag: int) -> np.ndarray:
    """Hash of a shingle with a tag (its width, or the size and band of a key)."""
    return K.pair(x, np.full(len(x), (tag * 0x9E3779B97F4A7C15 + 1) & (2**64 - 1), np.uint64))


def _band(size: int, j: int) -> int:
    """Tag of the keys of band ``j`` in the partition ``size`` (below: widths and few)."""
    return size * HASHES + j


_FEW_TAG = SHINGLE


def _shingles(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word shingles and their offsets per document."""
    start, end, at = K.words(data, offsets, K.NOT_ALNUM)
    every = K.grams(K.span_hashes(K.LOWER[data], start, end), n)
    count = np.maximum(np.diff(at) - n + 1, 0)
    first = np.concatenate(([0], np.cumsum(count)))
    pick = np.arange(int(first[-1])) + np.repeat(at[:-1] - first[:-1], count)
    return every[pick], first


def _describe(text: str | None) -> tuple[int, np.ndarray, np.ndarray] | None:
    """Partition, shingles and keys of an item; None without words.

    The partition is the size u, 0 for few shingles, minus the width for an
    item shorter than a shingle."""
    raw = (text or "").encode()
    data, offsets = np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
    n = len(K.words(data, offsets, K.NOT_ALNUM)[0])
    if not n:
        return None
    width = min(n, SHINGLE)
    found = np.unique(_shingles(data, offsets, width)[0])
    if width < SHINGLE:
        found = _tagged(found, width)
        return -width, found, found
    if len(found) <= FEW:
        return 0, found, _tagged(found, _FEW_TAG)
    u = LEAST_WINDOW
    while u < len(found):
        u *= 2
    keys = [_tagged(np.array([(found * m).min() * inverse]), _band(u, j))
            for j, (m, inverse) in enumerate(zip(_MULTIPLIER, _INVERSE, strict=True))]
    return u, found, np.concatenate(keys)


def _lists(values: list[np.ndarray]) -> pa.Array:
    """List column of 64-bit hashes (as signed numbers)."""
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


class _Numbers:
    """Numbers of the rows that one task writes, unique in a stored table."""

    def __init__(self) -> None:
        self.next = TaskContext.get().partitionId() << 40

    def take(self, n: int) -> pa.Array:
        self.next += n
        return pa.array(np.arange(self.next - n, self.next))


def item_table(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Stored table (item, item_id, size, n_item, shingles, keys) of all items with words."""
    def describe(batches):
        numbers = _Numbers()
        for batch in batches:
            found = [(i, *d) for i, t in enumerate(batch.column(1).to_pylist()) if (d := _describe(t))]
            if found:
                at, size, shingles, keys = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [numbers.take(len(found)), batch.column(0).take(pa.array(at)), pa.array(size, pa.int64()),
                     pa.array([len(s) for s in shingles], pa.int64()), _lists(list(shingles)), _lists(list(keys))],
                    ["item", "item_id", "size", "n_item", "shingles", "keys"])
    kind = items.schema[item_id].dataType.simpleString()
    return stored(items.select(item_id, text).mapInArrow(
        describe, f"item long, item_id {kind}, size long, n_item long, shingles array<long>, keys array<long>"))


class Filter:
    """Which hashes may belong to an item: two bits a hash, no false negatives."""

    def __init__(self, bits: np.ndarray, sizes: list[int]) -> None:
        self.bits, self.mask = bits, np.uint64(8 * len(bits) - 1)
        self.sizes = sorted(s for s in sizes if s > 0)
        self.widths = sorted(-s for s in sizes if s < 0)
        self.few = 0 in sizes

    def has(self, x: np.ndarray) -> np.ndarray:
        out = self._bit(x & self.mask)
        out[out] = self._bit((x[out] >> np.uint64(32)) & self.mask)
        return out

    def _bit(self, p: np.ndarray) -> np.ndarray:
        return (self.bits[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def item_filter(table: DataFrame) -> Filter:
    """The filter of a table of items; only its bits and the few sizes (one per
    power of two) are collected."""
    n = table.agg(F.sum(F.size("shingles") + F.size("keys"))).first()[0] or 0
    wanted = 1 << 20
    while wanted < min(n * BITS_PER_HASH, FILTER_BITS):
        wanted *= 2
    value = table.select(F.explode(F.concat("shingles", "keys")).alias("v"))
    place = value.select(F.explode(F.array("v", F.shiftrightunsigned("v", 32))).alias("v")).select(
        F.col("v").bitwiseAND(F.lit(wanted - 1)).alias("p"))
    rows = place.groupBy(F.shiftright("p", 15).alias("part")).agg(
        F.bitmap_construct_agg(F.col("p").bitwiseAND(F.lit(FILTER_ROW - 1))).alias("bits"))
    bits = np.zeros(wanted // 8, np.uint8)
    for part, raw in rows.toLocalIterator():
        bits[part * FILTER_ROW // 8: part * FILTER_ROW // 8 + len(raw)] = np.frombuffer(raw, np.uint8)
    return Filter(bits, [r[0] for r in table.select("size").distinct().collect()])


def _window_keys(known: Filter, x: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, key) of the windows' MinHash values that the filter has, per size and band."""
    count = np.diff(first)
    blocks = -(-count // LEAST_WINDOW)
    at = np.concatenate(([0], np.cumsum(blocks)))
    doc = np.repeat(np.arange(len(count)), blocks)
    starts = first[doc] + (np.arange(int(at[-1])) - at[doc]) * LEAST_WINDOW
    levels, u, d = [], LEAST_WINDOW, doc
    for size in known.sizes:  # which minima to merge, the same for all bands
        merges = []
        while u < size:
            keep = np.flatnonzero((np.arange(len(d)) - np.searchsorted(d, d)) % 2 == 0)
            merges.append(keep)
            d, u = d[keep], 2 * u
        levels.append((size, merges, d, d[1:] == d[:-1]))
    product = np.empty_like(x)
    for j in range(HASHES):
        np.multiply(x, _MULTIPLIER[j], out=product)
        least = np.minimum.reduceat(product, starts)
        for size, merges, d, same in levels:
            for keep in merges:
                least = np.minimum.reduceat(least, keep)
            window = least.copy()
            window[:-1] = np.where(same, np.minimum(least[:-1], least[1:]), least[:-1])
            shingle = window * _INVERSE[j]
            hits = np.flatnonzero(known.has(shingle))
            keys = _tagged(shingle[hits], _band(size, j))
            found = known.has(keys)
            yield d[hits[found]], keys[found]


def _distinct(pairs: list[tuple[np.ndarray, np.ndarray]], rows: int) -> list[np.ndarray]:
    """Distinct values per document."""
    doc = np.concatenate([p[0] for p in pairs]) if pairs else np.zeros(0, np.int64)
    value = np.concatenate([p[1] for p in pairs]) if pairs else np.zeros(0, np.uint64)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    doc, value = doc[new], value[new]
    return np.split(value, np.searchsorted(doc, np.arange(1, rows)))


def _suspects(known: Filter, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Documents with any key in the filter, their keys and their shingles in it."""
    rows = len(offsets) - 1
    keys, shingles = [], []
    for width in known.widths:
        y, first = _shingles(data, offsets, width)
        y = _tagged(y, width)
        hits = np.flatnonzero(known.has(y))
        found = np.searchsorted(first, hits, "right") - 1, y[hits]
        keys.append(found)
        shingles.append(found)
    if known.sizes or known.few:
        x, first = _shingles(data, offsets, SHINGLE)
        hits = np.flatnonzero(known.has(x))
        doc = np.searchsorted(first, hits, "right") - 1
        shingles.append((doc, x[hits]))
        if known.few:
            few = _tagged(x[hits], _FEW_TAG)
            found = known.has(few)
            keys.append((doc[found], few[found]))
        if known.sizes and len(hits):
            some = np.unique(doc)
            count = np.diff(first)[some]
            bounds = np.concatenate(([0], np.cumsum(count)))
            pick = np.arange(int(bounds[-1])) + np.repeat(first[some] - bounds[:-1], count)
            keys += [(some[d], k) for d, k in _window_keys(known, x[pick], bounds)]
    keys, shingles = _distinct(keys, rows), _distinct(shingles, rows)
    at = np.flatnonzero([len(k) for k in keys])
    return at, [keys[i] for i in at], [shingles[i] for i in at]


def _batch_suspects(known: Filter, column: pa.Array) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    data, offsets = K.column_bytes(column)
    where, keys, shingles = [np.zeros(0, np.int64)], [], []
    for i, j in K.steps(offsets):
        at, some, held = _suspects(known, data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i])
        where.append(i + at)
        keys += some
        shingles += held
    return np.concatenate(where), keys, shingles


def _suspect_table(docs: DataFrame, known, text: str = "text") -> DataFrame:
    """Stored table (hit, row, keys, shingles) of the documents with any key."""
    place = docs.columns.index(text)

    def search(batches):
        numbers = _Numbers()
        for batch in batches:
            at, keys, shingles = _batch_suspects(known.value, batch.column(place))
            if len(at):
                some = batch.take(pa.array(at))
                row = pa.StructArray.from_arrays(some.columns, fields=list(some.schema))
                yield pa.RecordBatch.from_arrays([numbers.take(len(at)), row, _lists(keys), _lists(shingles)],
                                                 ["hit", "row", "keys", "shingles"])
    hashes = ArrayType(LongType())
    schema = StructType([StructField("hit", LongType()), StructField("row", docs.schema),
                         StructField("keys", hashes), StructField("shingles", hashes)])
    return stored(docs.mapInArrow(search, schema))


def _verified(suspects: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """(hit, item, n_shared, n_item) of all candidates that hold enough of the item."""
    parts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salt = F.pmod(F.xxhash64("hit"), F.lit(SALTS)).cast("int").alias("salt")
    keys = suspects.select("hit", salt, F.explode("keys").alias("key"))
    mine = items.select("item", "n_item", F.explode("keys").alias("key")).select("*", parts)
    candidates = keys.join(mine, ["key", "salt"]).select("hit", "salt", "item", "n_item").distinct()
    wanted = items.select("item", F.explode("shingles").alias("shingle")).select("*", parts)
    held = suspects.select("hit", F.explode("shingles").alias("shingle"))
    shared = candidates.join(wanted, ["item", "salt"]).join(held, ["hit", "shingle"]).groupBy(
        "hit", "item", "n_item").agg(F.count("*").alias("n_shared"))
    return shared.where(F.col("n_shared") >= threshold * F.col("n_item"))


def _prepared(docs: DataFrame, items: DataFrame):
    """Table of items, their filter as a broadcast, table of suspects."""
    table = item_table(items)
    known = docs.sparkSession.sparkContext.broadcast(item_filter(table))
    return table, known, _suspect_table(docs, known)


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment) of every pair whose
    document contains at least ``threshold`` of the item's shingles."""
    table, _, suspects = _prepared(docs.select("doc_id", "text"), items)
    found = _verified(suspects, table, threshold)
    return found.join(suspects.select("hit", "row.doc_id"), "hit").join(table.select("item", "item_id"), "item").select(
        "doc_id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """Filter: the rows of ``docs``, columns unchanged, without any match.

    Documents without a key pass in a second map over ``docs``; only the
    stored suspects are joined."""
    table, known, suspects = _prepared(docs, items)
    place = docs.columns.index("text")

    def keep(batches):
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            clean[_batch_suspects(known.value, batch.column(place))[0]] = False
            yield batch.filter(pa.array(clean))
    cleared = suspects.join(_verified(suspects, table, threshold).select("hit").distinct(), "hit", "left_anti")
    return docs.mapInArrow(keep, docs.schema).unionByName(cleared.select("row.*"))
