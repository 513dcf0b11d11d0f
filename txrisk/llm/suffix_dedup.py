"""Exact repeated byte strings through suffix arrays of anchored blocks.

No suffix array of a corpus fits a machine, but suffixes that share 200
bytes share the anchor of those bytes.  So the runs of windows (see
``repeats``) are the partitions of a distributed suffix sort: copies of a
whole run collapse to a head, and the heads whose anchor has several
contents are sorted in blocks of whole anchors.  A block's text gets its
suffix array by prefix doubling up to the match length; in that order equal
neighbours share the full length.  Lengths of factors are not computed, only
whether they reach it: a previous factor of full length marks a later copy, a
next factor an earlier one; ``keep`` says which of them go:

* ``"none"`` (the contract's query): every byte of a repeated string goes;
* ``"first"``: the first place of a repeated string stays.

An anchor with more than ``BLOCK_HEADS`` contents would outgrow a block; its
windows are dealt by their own hash and counted instead, which is exact too.

Matches never cross documents.  Null and empty texts have no bytes.  Rows
that repeat doc_id and text are one document in several places: with
``"none"`` they match each other.  An empty table gives an empty result;
further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm import repeats as R
from txrisk.llm import tokens as K
from txrisk.llm.common import stored

LENGTH = 200
ANCHOR_BYTES = 48
#: Contents of one anchor that a block takes, and bytes of a block's text.
BLOCK_HEADS = 2048
BLOCK_BYTES = 2 << 20


def byte_symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return K.BYTE_VALUE[data], offsets


def _order(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Order of the pairs of two small numbers (ties in any order)."""
    n, most, wide = len(first), int(first.max(initial=0)), int(second.max(initial=0)).bit_length()
    place = n.bit_length()
    if most.bit_length() + wide + place > 63:
        return np.argsort(first << wide | second)
    # the place in the lowest bits: sorting values is faster than sorting places
    packed = np.sort((first << wide | second) << place | np.arange(n))
    return packed & ((1 << place) - 1)


def suffix_order(text: np.ndarray, depth: int, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of their first ``depth`` bytes, ties by
    position, and the rank of each position: the place in that order of the
    first one with the same bytes.  The text's end counts as zeros.  With
    ``wanted`` (a mask) both hold for the wanted positions only.

    Prefix doubling; a position that shares its rank with no other one keeps
    it and is not sorted again, nor one that no wanted position looks up."""
    n = len(text)
    levels = [min(8, depth)]
    while levels[-1] < depth:
        levels.append(min(2 * levels[-1], depth))
    needed = [wanted]  # per level, from the last
    if wanted is not None:
        for have, then in zip(levels[-2::-1], levels[:0:-1], strict=True):
            here = needed[-1].copy()
            here[then - have:] |= needed[-1][: max(n - (then - have), 0)]
            needed.append(here)
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for j in range(levels[0]):
        key = key << np.uint64(8) | padded[j: j + n]
    order = np.argsort(key)
    key = key[order]
    place, at = np.arange(n), order  # places in the order that are still sorted, and their positions
    new, rank = np.append(True, key[1:] != key[:-1])[:n], np.empty(n, np.int64)
    for k, have in enumerate(levels):
        first = np.maximum.accumulate(np.where(new, place, 0))
        rank[at] = first
        if wanted is not None:
            keep = needed[len(levels) - 1 - k][at]
            place, at, first = place[keep], at[keep], first[keep]
            new = np.append(True, first[1:] != first[:-1])[: len(at)]
        shared = ~new
        shared[:-1] |= ~new[1:]
        place, at, group = place[shared], at[shared], np.cumsum(new[shared])
        if have == depth or not len(at):
            break
        step = levels[k + 1] - have
        ahead = np.zeros(len(at), np.int64)
        inside = at + step < n
        ahead[inside] = rank[at[inside] + step] + 1
        by = _order(group, ahead)
        at, group, ahead = at[by], group[by], ahead[by]
        order[place] = at
        new = np.append(True, (group[1:] != group[:-1]) | (ahead[1:] != ahead[:-1]))
    order[place] = at[_order(group, at)]
    return order, rank


def full_factors(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Per position: does its longest previous factor reach ``depth``, does
    its longest next factor.  Among suffixes of equal depth the order is by
    position, so the previous smaller position is the neighbour before and
    the next larger one the neighbour behind."""
    order, rank = suffix_order(text, depth)
    same = rank[order[1:]] == rank[order[:-1]]
    previous, following = np.zeros(len(text), bool), np.zeros(len(text), bool)
    previous[order[1:][same]] = True
    following[order[:-1][same]] = True
    return previous, following


def _block_factors(text: np.ndarray, bounds: np.ndarray, group: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``full_factors`` for a block of strings: positions with fewer than
    ``depth`` bytes left in their string take no part."""
    string = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    whole = np.arange(len(text)) + depth <= bounds[string + 1]
    order, rank = suffix_order(text, depth, whole)
    order = order[whole[order]]
    same = (rank[order[1:]] == rank[order[:-1]]) & (group[string[order[1:]]] == group[string[order[:-1]]])
    previous, following = np.zeros(len(text), bool), np.zeros(len(text), bool)
    previous[order[1:][same]] = True
    following[order[:-1][same]] = True
    return previous, following


def _head_strings(depth: int):
    """mapInArrow function: ``with_text`` rows -> each head with its bytes."""
    def run(batches):
        for batch in batches:
            data, offsets = K.column_bytes(batch.column(2))
            row, head = R.head_rows(batch)
            at = offsets[row] + head["start"]
            for a in range(0, len(row), 4096):
                pick = np.arange(a, min(a + 4096, len(row)))
                texts = [data[p: p + n + depth - 1].tobytes() for p, n in zip(at[pick], head["n"][pick], strict=True)]
                take = pa.array(row[pick])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(head["anchor"][pick]), pa.array(head["copies"][pick]), batch.column(0).take(take),
                     batch.column(1).take(take), pa.array(head["start"][pick].astype(np.int32)), pa.array(texts, pa.binary())],
                    ["anchor", "copies", "doc_id", "th", "start", "bytes"])
    return run


def _sorted_blocks(depth: int, keep: str):
    """mapInArrow function over heads that come anchor by anchor (in order of
    their places): spans (doc_id, th, start, end) to remove."""
    def spans(table: pa.Table) -> pa.RecordBatch:
        strings = table["bytes"].to_pylist()
        bounds = np.concatenate(([0], np.cumsum([len(s) for s in strings])))
        previous, following = _block_factors(np.frombuffer(b"".join(strings), np.uint8), bounds, table["anchor"].to_numpy(), depth)
        hit = np.flatnonzero(previous if keep == "first" else previous | following)
        string = np.searchsorted(bounds, hit, "right") - 1
        new = np.append(True, (np.diff(hit) > 1) | (np.diff(string) > 0)) if len(hit) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(hit)) - 1 if len(first) else first
        base = table["start"].to_numpy()[string[first]] - bounds[string[first]]
        take = pa.array(string[first])
        return pa.RecordBatch.from_arrays(
            [table["doc_id"].combine_chunks().take(take), table["th"].combine_chunks().take(take),
             pa.array((hit[first] + base).astype(np.int64)), pa.array((hit[last] + base + depth).astype(np.int64))],
            ["doc_id", "th", "start", "end"])

    def run(batches):
        waiting: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            anchor = batch.column(0).to_numpy()
            size += batch.nbytes
            if size >= BLOCK_BYTES and waiting:
                same = np.flatnonzero(anchor != waiting[-1].column(0)[-1].as_py())
                edge = int(same[0]) if len(same) else len(anchor)
                if edge < len(anchor):  # whole anchors only
                    yield spans(pa.Table.from_batches([*waiting, batch.slice(0, edge)]))
                    waiting, batch = [], batch.slice(edge)
                    size = batch.nbytes
            waiting.append(batch)
        if waiting:
            yield spans(pa.Table.from_batches(waiting))
    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR_BYTES, keep: str = "none") -> DataFrame:
    """(doc_id, th, start, end) of byte ranges to remove (they may overlap)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs if docs.columns == ["doc_id", "_th", "text"] else R.identified(docs)
    shared, heavy = R.shared_places(docs, byte_symbols, length, anchor)
    known = R.contents(shared, heavy)
    whole = shared.join(known.where("copies > 1").select("anchor", "content", "n", "head"), ["anchor", "content", "n"])
    if keep == "first":
        whole = whole.where(~F.struct("doc_id", "th", "start").eqNullSafe(F.col("head")))
    whole = whole.select("doc_id", "th", F.col("start").cast("long").alias("start"),
                         (F.col("start") + F.col("n") + (length - 1)).cast("long").alias("end"))
    ragged = known.where("kinds > 1")
    columns = ["anchor", "content", "copies", "n"]
    strings = R.with_text(ragged.where(F.col("kinds") <= BLOCK_HEADS), docs, columns).mapInArrow(
        _head_strings(length), f"anchor long, copies long, doc_id {kind}, th long, start int, bytes binary")
    blocks = strings.repartition("anchor").dropDuplicates(["anchor", "doc_id", "th", "start"]).sortWithinPartitions("anchor", "doc_id", "th", "start").mapInArrow(
        _sorted_blocks(length, keep), f"doc_id {kind}, th long, start long, end long")
    windows = stored(R.head_windows(R.with_text(ragged.where(F.col("kinds") > BLOCK_HEADS), docs, columns), byte_symbols, length))
    where = F.struct("doc_id", "th", (F.col("start") + F.col("i")).alias("start"))
    again = windows.groupBy("anchor", "code").agg(F.sum("copies").alias("m"), F.min(where).alias("first")).where("m > 1")
    crowded = windows.join(again, ["anchor", "code"])
    if keep == "first":
        crowded = crowded.where(~where.eqNullSafe(F.col("first")))
    crowded = crowded.select("doc_id", "th", (F.col("start") + F.col("i")).cast("long").alias("start"),
                             (F.col("start") + F.col("i") + length).cast("long").alias("end"))
    return whole.unionByName(blocks).unionByName(crowded)


def remove(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): the bytes outside the spans."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            data, offsets = K.column_bytes(batch.column(1))
            size, removed, count, kept = np.diff(offsets), [], [], []
            for a, b, found in zip(offsets[:-1], offsets[1:], batch.column(2).to_pylist(), strict=True):
                part = data[a:b]
                if not found:
                    removed.append(0)
                    count.append(0)
                    kept.append(part.tobytes())
                    continue
                lost = R.covered(b - a, np.array([x["start"] for x in found]), np.array([x["end"] for x in found]))
                removed.append(int(lost.sum()))
                count.append(int(lost[0]) + int((lost[1:] & ~lost[:-1]).sum()))
                kept.append(part[~lost].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return R.spans_per_document(docs, spans).mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    known = R.identified(docs)
    return remove(known, repeated_spans(known)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
