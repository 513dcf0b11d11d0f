"""N-gram Jaccard self-join by banded MinHash, verified exactly.

1. Each text becomes the set of its five-word shingles.  Texts of equal sets
   collapse to one representative with a number of copies.
2. A representative has ``TREES`` keys (bands), each the hash of as many
   MinHash values as ``matched_prefix`` gives: the most, up to ``DEPTH``, with
   which a pair at the threshold shares a key with at least the target recall.
   The number follows from the constants alone; no trie is built, and nothing
   is shortened against the data.  Representatives that share a key are linked
   to the bucket's least one (a star, never all pairs), and components of the
   stars are the candidate groups.
3. Groups are verified exactly.  A group is dealt into blocks of bounded
   weight, every two blocks of it meet in one task, and the task counts the
   common shingles of all its pairs at once.  It returns per representative
   its number of links and one edge to its local root, not the pairs.
4. Components of the verified edges are the classes.

Links therefore hold exactly the pairs of Jaccard >= threshold inside the
candidate groups; a pair is missed only if no chain of shared keys joins
it (probability below 1 - ``RECALL`` at the threshold, less above it).

Words are ``[^\x20\x09-\x0D]+`` unchanged; a text of one to four words has
one shingle of all its words; null, empty and blank texts have none, are in
a class of their own and have no links.  Rows that repeat count as copies.
A null doc_id is a document like others (it sorts first).  Further columns
are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm import tokens as K
from txrisk.llm.common import cut
from txrisk.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
TREES = 32
DEPTH = 8
RECALL = 0.9999
#: Weight of a block: shingles, and so much for each representative.
BLOCK_WEIGHT = 1 << 20
ROW_WEIGHT = 512


def matched_prefix(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """Longest prefix whose match in any tree reaches the target recall."""
    for prefix in range(depth, 1, -1):
        if 1 - (1 - threshold ** prefix) ** trees >= recall:
            return prefix
    return 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each document, and their offsets."""
    start, end, at = K.words(data, offsets, K.WHITE)
    word = K.span_hashes(data, start, end)
    every, sets = K.grams(word, SHINGLE), []
    for d in range(len(at) - 1):
        a, b = int(at[d]), int(at[d + 1])
        if b - a >= SHINGLE:
            sets.append(np.unique(every[a: b - SHINGLE + 1]))
        elif b > a:
            sets.append(K.grams(word[a:b], b - a) ^ np.uint64(b - a))
        else:
            sets.append(np.zeros(0, np.uint64))
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int64)


def _signatures(prefix: int, trees: int):
    """mapInArrow function: (.., text) -> (.., set, n, keys)."""
    multiplier = np.random.default_rng(11).integers(1, 2**63, (trees, prefix), dtype=np.uint64) << np.uint64(1) | np.uint64(1)

    def run(batches):
        for batch in batches:
            data, offsets = K.column_bytes(batch.column(2))
            names, size, keys = [], [], []
            for i, j in K.steps(offsets):
                x, first = shingle_sets(data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i])
                count = np.diff(first)
                full = np.flatnonzero(count)
                label = np.zeros((len(count), trees), np.uint64)
                product = np.empty_like(x)
                for t in range(trees if len(full) else 0):
                    total = np.full(len(full), t + 1, np.uint64)
                    for r in range(prefix):
                        np.multiply(x, multiplier[t, r], out=product)
                        total = K.mix(total * K.BASE + np.minimum.reduceat(product, first[full]))
                    label[full, t] = total
                names += [hashlib.md5(x[a:b].tobytes()).digest() for a, b in zip(first[:-1], first[1:], strict=True)]
                size.append(count)
                keys.append(label)
            n = batch.num_rows
            flat = np.concatenate(keys).view(np.int64).ravel() if n else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(names, pa.binary()),
                pa.array(np.concatenate(size) if n else np.zeros(0, np.int64)),
                pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * trees), pa.array(flat))],
                ["doc_id", "th", "set", "n", "keys"])
    return run


def _shingle_bytes(batches):
    """mapInArrow function: (node, copies, comp, nb, n, text) -> shingles in place of the text."""
    for batch in batches:
        data, offsets = K.column_bytes(batch.column(5))
        out = []
        for i, j in K.steps(offsets):
            x, first = shingle_sets(data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i])
            out += [x[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(out, pa.binary())],
                                         ["node", "copies", "comp", "nb", "n", "shingles"])


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of common elements of all pairs (few-holder elements as pair
    codes, many-holder elements as a product of incidence blocks)."""
    m = len(sets)
    size = np.array([len(s) for s in sets])
    who = np.repeat(np.arange(m), size)
    order = np.argsort(flat := np.concatenate(sets), kind="stable")
    flat, who = flat[order], who[order]
    first = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
    held = np.diff(np.append(first, len(flat)))
    common = np.zeros(m * m, np.float32)
    for c in range(2, 17):
        at = first[held == c]
        if len(at):
            for p in range(c):
                for q in range(p + 1, c):
                    np.add.at(common, who[at + p] * m + who[at + q], 1)
    common = common.reshape(m, m)
    common += common.T
    many, width = np.flatnonzero(held > 16), 2048
    for k in range(0, len(many), width):
        part = many[k: k + width]
        inside = np.zeros((m, len(part)), np.float32)
        column = np.repeat(np.arange(len(part)), held[part])
        at = np.repeat(first[part], held[part]) + np.arange(len(column)) - np.repeat(np.cumsum(held[part]) - held[part], held[part])
        inside[who[at], column] = 1
        common += inside @ inside.T
    return common


def _verify(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        order = np.argsort(group["node"].to_numpy(), kind="stable")
        group = group.take(pa.array(order))
        node, copies = group["node"].to_numpy(), group["copies"].to_numpy()
        block, low, high = (group[c].to_numpy() for c in ("block", "low", "high"))
        sets = [np.frombuffer(b, np.uint64) for b in group["shingles"].to_pylist()]
        size = np.array([len(s) for s in sets], np.float64)
        common = common_counts(sets)
        linked = common >= threshold / (1 + threshold) * (size[:, None] + size[None, :]) - 1e-6
        np.fill_diagonal(linked, False)
        if low[0] != high[0]:  # pairs within a block belong to that block's own task
            linked &= block[:, None] != block[None, :]
        root = np.arange(len(node))
        while True:
            near = np.where(linked, root[None, :], len(node)).min(axis=1, initial=len(node))
            now = np.minimum(root, near)
            now = now[now]
            if (now == root).all():
                break
            root = now
        return pa.table({"node": node, "root": node[root], "links": linked @ copies.astype(np.int64),
                         "text_links": linked.sum(axis=1)})
    return run


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, th, class_id, n_links, n_text_links, first) per document.

    class_id is the smallest doc_id of the class; n_links counts all other
    documents at or above the threshold (copies included), n_text_links the
    other distinct shingle sets; ``first`` marks one row of the class (the
    smallest doc_id, then the smallest text hash)."""
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    prefix = matched_prefix(threshold)
    signed = cut(rows.mapInArrow(_signatures(prefix, TREES), f"doc_id {id_type}, th long, set binary, n long, keys array<long>"))
    reps = cut(signed.where("n > 0").groupBy("set").agg(
        F.min(F.struct("doc_id", "th")).alias("rep"), F.count("*").alias("copies"), F.first("n").alias("n"),
        F.first("keys").alias("keys")).withColumn("node", F.monotonically_increasing_id()))
    keyed = reps.select("node", F.explode("keys").alias("key"))
    buckets = keyed.groupBy("key").agg(F.min("node").alias("least"), F.count("*").alias("m")).where("m > 1")
    stars = keyed.join(buckets, "key").where("node != least").select("node", "least")
    groups = components(stars)
    members = cut(groups.join(reps.drop("keys"), "node").select("node", F.col("root").alias("comp"), "rep", "copies", "n"))
    weights = members.groupBy("comp").agg(
        F.ceil(F.sum(F.col("n") + ROW_WEIGHT) / F.lit(BLOCK_WEIGHT)).cast("int").alias("nb"))
    dealt = members.join(weights, "comp")
    texts = rows.join(dealt.select("node", "comp", "copies", "nb", "n", "rep.doc_id", "rep.th")
                      .withColumnsRenamed({"doc_id": "rep_id", "th": "rep_th"}),
                      F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("th") == F.col("rep_th"))) \
        .select("node", "copies", "comp", "nb", "n", "text")
    shingles = texts.mapInArrow(_shingle_bytes, "node long, copies long, comp long, nb int, n long, shingles binary") \
        .dropDuplicates(["node"])
    block = F.pmod(F.xxhash64("node"), F.col("nb")).cast("int")
    meeting = shingles.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))) \
        .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")).drop("other", "nb", "n")
    verified = cut(meeting.groupBy("comp", "low", "high").applyInArrow(
        _verify(threshold), "node long, root long, links long, text_links long"))
    joined = components(verified.select("node", "root"))
    counted = verified.groupBy("node").agg(F.sum("links").alias("links"), F.sum("text_links").alias("text_links"))
    found = reps.select("node", "set", "rep", "copies").join(joined, "node", "left").join(counted, "node", "left") \
        .withColumn("root", F.coalesce("root", "node"))
    heads = found.groupBy("root").agg(F.min("rep").alias("head"))
    judged = found.join(heads, "root").select(
        "set", "head", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("text_links", F.lit(0)).alias("n_text_links"))
    every = signed.select("doc_id", "th", "n", "set").join(judged, "set", "left")
    empty = F.col("n") == 0
    return every.select(
        "doc_id", "th", F.when(empty, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"),
        F.when(empty, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        F.when(empty, F.lit(0)).otherwise(F.col("n_text_links")).cast("long").alias("n_text_links"),
        (empty | (F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("th") == F.col("head.th")))).alias("first"))


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, n_text_links."""
    return classes(docs).select("doc_id", "class_id", "n_links", "n_text_links")


def keep_first(docs: DataFrame) -> DataFrame:
    """Filter: one row of each class stays, columns unchanged.

    The rows of the kept key may repeat, so one of them is picked."""
    keys = classes(docs).where("first").select(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).distinct()
    packed = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_d"),
                         F.xxhash64(F.coalesce("text", F.lit(""))).alias("_t"))
    kept = packed.join(keys, F.col("_d").eqNullSafe(F.col("_id")) & (F.col("_t") == F.col("_th")), "left_semi")
    return kept.groupBy("_d", "_t").agg(F.first("_row").alias("_row")).select("_row.*")
