"""Repeated passages by compacting a De Bruijn graph of token k-mers.

The edges of the graph are the k-mers (windows of ``K_WORDS`` words).  Runs
of edges that share an anchor are compacted where they are read (as in
minimizer-bucketed assemblers); runs that branch inside are split back into
single edges.  What occurs twice or more is a piece.  Joins over source
coordinates then find each piece's successors: where every occurrence of a
piece goes on with the same next piece, and that one is always entered from
it, the path does not branch and the pieces compact into one passage.  A
passage's occurrences are read off the source coordinates, which also say
which one is the first; all later ones are spans to remove.

Words are ``[^\x20\x09-\x0D]+`` unchanged.  Null and empty texts have no
words.  Rows that repeat doc_id and text are one document (none of them is
earlier).  Documents are ordered by doc_id (null first), then text hash.  An
empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txrisk.llm import repeats as R
from txrisk.llm import tokens as K
from txrisk.llm.common import stored

K_WORDS = 20
ANCHOR_WORDS = 6


def word_symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start, end, at = K.words(data, offsets, K.WHITE)
    return K.span_hashes(data, start, end), at


def pieces(docs: DataFrame, k: int = K_WORDS, anchor: int = ANCHOR_WORDS) -> DataFrame:
    """(doc_id, th, start, n, piece, later): occurrences of repeated pieces,
    n edges from word ``start``; ``later`` if an equal piece stands earlier.

    Of a ragged run only the head needs its single edges: every other
    occurrence of the same content is later as a whole."""
    docs = docs if docs.columns == ["doc_id", "_th", "text"] else R.identified(docs)
    shared, heavy = R.shared_places(docs, word_symbols, k, anchor)
    known = R.contents(shared, heavy)
    whole = shared.alias("p").join(known.alias("c"), ["anchor", "content", "n"]).where("c.copies > 1").select(
        "p.doc_id", "p.th", "p.start", "n", "anchor", "content", "head", "kinds") \
        .withColumn("is_head", F.struct("doc_id", "th", "start").eqNullSafe(F.col("head")))
    copies = whole.where((F.col("kinds") == 1) | ~F.col("is_head")).select(
        "doc_id", "th", "start", "n", F.xxhash64("anchor", "content").alias("piece"), (~F.col("is_head")).alias("later"))
    texts = R.with_text(known.where("kinds > 1"), docs, ["anchor", "content", "copies", "n"])
    edges = stored(R.head_windows(texts, word_symbols, k))
    first = edges.groupBy("anchor", "code").agg(
        F.sum("copies").alias("m"), F.min(F.struct("doc_id", "th", (F.col("start") + F.col("i")).alias("start"))).alias("first")) \
        .where("m > 1")
    single = edges.join(first, ["anchor", "code"]).select(
        "doc_id", "th", (F.col("start") + F.col("i")).alias("start"), F.lit(1).alias("n"),
        F.xxhash64("anchor", "code").alias("piece"), "first") \
        .withColumn("later", ~F.struct("doc_id", "th", "start").eqNullSafe(F.col("first"))).drop("first")
    return copies.unionByName(single)


def compacted(found: DataFrame) -> DataFrame:
    """(piece, passage, at): the nonbranching path that a piece lies on and
    its word offset there.

    A piece goes on with another if every occurrence of it does and the other
    has no further occurrences.  Along the first occurrences, which stand in
    the same order in their source, such steps chain the pieces."""
    in_order = Window.partitionBy("doc_id", "th").orderBy("start")
    linked = found.withColumn("next", F.when(F.lead("start").over(in_order) == F.col("start") + F.col("n"),
                                             F.lead("piece").over(in_order)))
    nodes = linked.groupBy("piece").agg(
        F.count("*").alias("m"), F.when((F.count("next") == F.count("*")) & (F.min("next") == F.max("next")), F.min("next")).alias("next"),
        F.min(F.struct("doc_id", "th", "start", "n")).alias("head"))
    steps = nodes.where("next is not null").select(F.col("next").alias("piece"), F.col("m").alias("before"))
    chained = nodes.join(steps.groupBy("piece").agg(F.max("before").alias("before")), "piece", "left") \
        .select("piece", "head.*", F.when(F.col("before") == F.col("m"), 0).otherwise(1).alias("opens"))
    running = in_order.rowsBetween(Window.unboundedPreceding, 0)
    opening = F.when(F.col("opens") == 1, F.struct("start", "piece"))
    return chained.withColumn("first", F.last(opening, ignorenulls=True).over(running)).select(
        "piece", F.coalesce("first.piece", "piece").alias("passage"), (F.col("start") - F.coalesce("first.start", "start")).alias("at"))


def passages(docs: DataFrame, k: int = K_WORDS, anchor: int = ANCHOR_WORDS, later_only: bool = False) -> DataFrame:
    """(doc_id, th, passage, begin, start, end, later): occurrences of the
    pieces of repeated passages, words [start, end) of their documents; rows
    that agree in passage and begin are one occurrence of the passage."""
    found = stored(pieces(docs, k, anchor))
    wanted = found.where("later") if later_only else found
    return wanted.join(compacted(found), "piece").select(
        "doc_id", "th", "passage", (F.col("start") - F.col("at")).alias("begin"), "start",
        (F.col("start") + F.col("n") + (k - 1)).alias("end"), "later")


def spans(occurrences: DataFrame) -> DataFrame:
    """(doc_id, th, start, end): verified spans, the pieces of one passage
    occurrence joined by their source coordinates."""
    return occurrences.groupBy("doc_id", "th", "passage", "begin").agg(F.min("start").alias("start"), F.max("end").alias("end"))


def keep_words(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): the words outside the spans, joined
    by one space."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            data, offsets = K.column_bytes(batch.column(1))
            total, removed, kept = [], [], []
            lists = batch.column(2).to_pylist()
            for i, j in K.steps(offsets):
                part = data[offsets[i]: offsets[j]]
                raw = part.tobytes()
                start, end, at = K.words(part, offsets[i: j + 1] - offsets[i], K.WHITE)
                for d in range(j - i):
                    a, b = int(at[d]), int(at[d + 1])
                    s, e, gone = start[a:b], end[a:b], 0
                    if lists[i + d]:
                        lost = R.covered(b - a, np.array([x["start"] for x in lists[i + d]]), np.array([x["end"] for x in lists[i + d]]))
                        gone = int(lost.sum())
                        s, e = s[~lost], e[~lost]
                    total.append(b - a)
                    removed.append(gone)
                    kept.append(b" ".join([raw[x:y] for x, y in zip(s.tolist(), e.tolist(), strict=True)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                ["doc_id", "n_words", "n_removed", "kept"])
    return R.spans_per_document(docs, spans).mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept binary")


def deduplicate(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept binary) per document."""
    known = R.identified(docs)
    return keep_words(known, spans(passages(known, later_only=True)))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    return deduplicate(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
