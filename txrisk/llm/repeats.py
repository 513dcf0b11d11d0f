"""Repeated windows of a corpus, found through winnowed anchors.

A window is a fixed number of consecutive symbols (bytes or words) of one
document.  Every window selects an anchor, an n-gram of it, by content alone,
so equal windows have equal anchors.  Consecutive windows with one anchor
form a run (a super-k-mer).  Only runs whose anchor occurs again anywhere
can hold a repeated window; the others are dropped before anything wide is
shuffled.  Runs with the same content are copies as a whole and collapse to
a head (their first place) and a count.  Anchors with several contents are
"ragged": copies begin or end inside their runs, and single windows must be
compared, of one head per content.

A document is the pair (doc_id, ``th``): rows that repeat doc_id and text are
one document that stands in several places.  ``th`` is 0 where no doc_id has
two texts, else a 64-bit hash of the text that was checked not to join two
texts of one doc_id (compared by MD5), or taken with another seed.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm import tokens as K
from txrisk.llm.common import stored

#: (data, offsets) of a batch -> symbols and their offsets per document.
Symbols = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


SEEDS = 4
#: An anchor with more than one in so many of the places is heavy (so there are
#: fewer heavy anchors than this), and the parts over which its rows are dealt.
HEAVY = 1000
PARTS = 32


def _joined(rows: DataFrame, *keys: str) -> bool:
    """Do some rows with equal keys have different texts?"""
    return rows.groupBy(*keys).agg((F.min("md5") != F.max("md5")).alias("several")).where("several").limit(1).count() > 0


def identified(docs: DataFrame, code: Callable[[Column, int], Column] = lambda text, seed: F.xxhash64(F.lit(seed), text)) -> DataFrame:
    """(doc_id, _th, text): documents with their key (runs one small job)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    coded = rows.select("doc_id", "text", F.md5("text").alias("md5"))
    if not _joined(coded.select("doc_id", "md5"), "doc_id"):
        return rows.select("doc_id", F.lit(0).cast("long").alias("_th"), "text")
    for seed in range(SEEDS):
        key = code(F.col("text"), seed).cast("long")
        if not _joined(coded.select("doc_id", "md5", key.alias("th")), "doc_id", "th"):
            return rows.select("doc_id", key.alias("_th"), "text")
    raise ValueError("text hashes of one doc_id collide under every seed")


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, th, text) of documents or of what ``identified`` made of them."""
    known = docs if docs.columns == ["doc_id", "_th", "text"] else identified(docs)
    return known.select("doc_id", F.col("_th").alias("th"), "text")


def same_document(left: str, right: str) -> Column:
    return F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id")) & (F.col(f"{left}.th") == F.col(f"{right}.th"))


def places(docs: DataFrame, symbols: Symbols, window: int, gram: int) -> DataFrame:
    """(doc_id, th, anchor, content, start, n) of every run."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            data, offsets = K.column_bytes(batch.column(2))
            for i, j in K.steps(offsets):
                values, bounds = symbols(data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i])
                found = K.runs(values, bounds, window, gram)
                at = pa.array(found["doc"] + i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(found["anchor"].view(np.int64)),
                     pa.array(found["content"].view(np.int64)), pa.array(found["start"].astype(np.int32)),
                     pa.array(found["n"].astype(np.int32))],
                    ["doc_id", "th", "anchor", "content", "start", "n"])
    return keyed(docs).mapInArrow(run, f"doc_id {kind}, th long, anchor long, content long, start int, n int")


def anchors(docs: DataFrame, symbols: Symbols, window: int, gram: int) -> DataFrame:
    """(anchor, times): the anchors of ``places``, those of a batch counted;
    nothing else of a run is computed."""
    def run(batches):
        for batch in batches:
            data, offsets = K.column_bytes(batch.column(0))
            for i, j in K.steps(offsets):
                values, bounds = symbols(data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i])
                anchor, times = np.unique(K.runs(values, bounds, window, gram, contents=False)["anchor"], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(times.astype(np.int64))], ["anchor", "times"])
    return keyed(docs).select("text").mapInArrow(run, "anchor long, times long")


def heavy_anchors(counts: DataFrame) -> DataFrame:
    """The anchors that hold more than 1 / ``HEAVY`` of all places, from a
    stored table (anchor, m): fewer than ``HEAVY`` rows, whatever the input."""
    total = counts.agg(F.sum("m")).first()[0] or 0
    return counts.where(F.col("m") * HEAVY > total).select("anchor")


def with_anchor_totals(rows: DataFrame, totals: DataFrame, heavy: DataFrame, *dealt_by: str) -> DataFrame:
    """``rows`` joined with the ``totals`` of their anchors, a heavy anchor's
    rows dealt over ``PARTS`` by a hash of ``dealt_by``."""
    flag = F.broadcast(heavy.select("anchor", F.lit(True).alias("heavy")))
    part = F.when(F.col("heavy"), F.pmod(F.xxhash64(*dealt_by), F.lit(PARTS)).cast("int")).otherwise(F.lit(0))
    parts = F.when(F.col("heavy"), F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))
    dealt = rows.join(flag, "anchor", "left").withColumn("part", part).drop("heavy")
    each = totals.join(flag, "anchor", "left").withColumn("part", F.explode(parts)).drop("heavy")
    return dealt.join(each, ["anchor", "part"]).drop("part")


def shared_places(docs: DataFrame, symbols: Symbols, window: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """The places whose anchor stands in two places at least, stored, and the
    heavy ones among these anchors."""
    every = places(docs, symbols, window, gram)
    again = stored(anchors(docs, symbols, window, gram).groupBy("anchor").agg(F.sum("times").alias("m")).where("m > 1"))
    heavy = heavy_anchors(again)
    shared = with_anchor_totals(every, again.select("anchor"), heavy, "doc_id", "th", "start")
    return stored(shared.select("doc_id", "th", "anchor", "content", "start", "n")), heavy


def place() -> Column:
    """Order of places: doc_id (nulls first), text hash, start."""
    return F.struct("doc_id", "th", "start")


def contents(shared: DataFrame, heavy: DataFrame) -> DataFrame:
    """(anchor, content, n, copies, head, kinds, m): each content once, with
    its first place and the number of contents of its anchor; stored."""
    each = shared.groupBy("anchor", "content", "n").agg(F.count("*").alias("copies"), F.min(place()).alias("head"))
    kinds = each.groupBy("anchor").agg(F.count("*").alias("kinds"))
    return stored(with_anchor_totals(each, kinds, heavy, "content", "n"))


def with_text(heads: DataFrame, docs: DataFrame, columns: list[str]) -> DataFrame:
    """(doc_id, th, text, heads): documents that hold heads, each with the
    array of its heads (struct of start and ``columns``).  Rows that repeat
    a document give its heads again; their contents have several copies
    anyway, so no count of "twice or more" changes."""
    per_doc = heads.groupBy(F.col("head.doc_id").alias("doc_id"), F.col("head.th").alias("th")).agg(
        F.collect_list(F.struct(F.col("head.start").alias("start"), *columns)).alias("heads"))
    return keyed(docs).alias("d").join(per_doc.alias("h"), same_document("d", "h")) \
        .select("d.doc_id", "d.th", "d.text", "h.heads")


def head_rows(batch: pa.RecordBatch) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Row of each head in a batch of ``with_text`` and its fields."""
    lists = batch.column(3)
    row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    flat = lists.flatten()
    return row, {f.name: flat.field(i).to_numpy(zero_copy_only=False) for i, f in enumerate(flat.type)}


def head_windows(texts: DataFrame, symbols: Symbols, window: int) -> DataFrame:
    """(anchor, content, copies, doc_id, th, start, i, code): every window i
    of every head, with a hash of its symbols."""
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            data, offsets = K.column_bytes(batch.column(2))
            row, head = head_rows(batch)
            for i, j in K.steps(offsets):
                values, bounds = symbols(data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i])
                mine = np.flatnonzero((row >= i) & (row < j))
                n = head["n"][mine].astype(np.int64)
                if not len(mine):
                    continue
                size = n + window - 1                  # symbols of each head, laid end to end
                head_at = np.cumsum(size) - size
                part = np.arange(int(size.sum())) - np.repeat(head_at, size)
                symbols_of = values[np.repeat(bounds[row[mine] - i] + head["start"][mine], size) + part]
                own = np.repeat(mine, n)
                step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                code = K.window_hashes(symbols_of, window)[0][np.repeat(head_at, n) + step]
                take = pa.array(row[own])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(head["anchor"][own]), pa.array(head["content"][own]), pa.array(head["copies"][own]),
                     batch.column(0).take(take), batch.column(1).take(take), pa.array(head["start"][own].astype(np.int32)),
                     pa.array(step.astype(np.int32)), pa.array(code.view(np.int64))],
                    ["anchor", "content", "copies", "doc_id", "th", "start", "i", "code"])
    return texts.mapInArrow(run, f"anchor long, content long, copies long, doc_id {kind}, th long, start int, i int, code long")


def spans_per_document(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc_id, text, spans): every row of ``docs`` with the array of its
    spans (struct of start, end; null for none)."""
    per_doc = spans.groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return keyed(docs).alias("d").join(per_doc.alias("s"), same_document("d", "s"), "left").select("d.doc_id", "d.text", "s.spans")


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n symbols lie in any span."""
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, ends, -1)
    return np.cumsum(marks[:-1]) > 0
