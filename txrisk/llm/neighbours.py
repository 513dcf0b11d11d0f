"""Quality by nearest-neighbour voting over latent-semantic vectors.

A text is described by counts of byte pairs and of a few shapes of words,
hashed to ``FEATURES`` columns, damped by a logarithm and weighted by inverse
document frequency; a truncated SVD of the labelled texts gives ``TOPICS``
latent dimensions.  The model is fitted on at most ``PER_CLASS`` labelled
documents a class, picked by a hash of their id (this bound is the size of
what is broadcast: 2 * PER_CLASS vectors); votes are weighted by how many
labelled documents of its class a picked one stands for.

Every document is then compared with every labelled vector, in blocks: one
matrix product of cosines, the ``NEIGHBOURS`` nearest, and a vote weighted
by a power of the similarity.  The documents are mapped, never shuffled.
Cosines are rounded to ``DIGITS`` places, and every vector as near as the last
of the nearest votes too, so ties need no order and a score does not depend on
the batch that a document comes in.

Null and empty texts have no features; their score is the share of good ones
among the labelled texts without features, or the overall share where there
are none.  Without any labels every score is 0.5.  Rows that repeat are scored
alike; of labelled rows that share a doc_id the smallest text is learned from.
Labels, lang, source and doc_id are no inputs of a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm import tokens as K

FEATURES = 1024
TOPICS = 64
PER_CLASS = 2048
NEIGHBOURS = 25
SHARPNESS = 8
CUT = 0.7
BLOCK = 512
DIGITS = 5
#: Shape features appended to the hashed pairs.
SHAPES = 8
_PAIR = (np.random.default_rng(3).permutation(1 << 16) % FEATURES).astype(np.int64)
_CLASS = np.zeros(256, np.int64)          # 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 mark, 6 non-ASCII
_CLASS[0x61:0x7B], _CLASS[0x41:0x5B], _CLASS[0x30:0x3A], _CLASS[0x80:] = 1, 2, 3, 6
_CLASS[[9, 10, 11, 12, 13, 32]] = 4
_CLASS[[ord(c) for c in "#*$%&|<>!"]] = 5


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Damped counts, one row a document."""
    n, width = len(offsets) - 1, FEATURES + SHAPES
    out = np.zeros((n, width), np.float32)
    for i, j in K.steps(offsets):
        part, at = data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i]
        if not len(part):
            continue
        size = np.diff(at)
        doc = np.repeat(np.arange(j - i), size)
        pair = _PAIR[part[:-1].astype(np.int64) << 8 | part[1:]]
        same = doc[1:] == doc[:-1]
        counts = np.bincount(doc[:-1][same] * FEATURES + pair[same], minlength=(j - i) * FEATURES).reshape(j - i, FEATURES)
        share = counts / np.maximum(size, 1)[:, None]
        out[i:j, :FEATURES] = np.log1p(1000 * share)
        shape = np.bincount(doc * SHAPES + _CLASS[part], minlength=(j - i) * SHAPES).reshape(j - i, SHAPES) / np.maximum(size, 1)[:, None]
        start, end, word_at = K.words(part, at, K.WHITE)
        if len(start):  # how often three consecutive words come again
            grams = K.grams(K.span_hashes(part, start, end), 3)
            owner = np.searchsorted(word_at, np.arange(len(grams)), "right") - 1
            _, first, count = np.unique(grams ^ K.mix(owner.astype(np.uint64)), return_index=True, return_counts=True)
            again = np.bincount(owner[first[count > 1]], count[count > 1], minlength=j - i)
            shape[:, SHAPES - 1] = again / np.maximum(np.diff(word_at), 1)
        out[i:j, FEATURES:] = 4 * np.sqrt(shape)
    return out


@dataclass
class Model:
    weight: np.ndarray      # idf of the features
    topics: np.ndarray      # features x topics
    vectors: np.ndarray     # labelled vectors of unit length
    labels: np.ndarray
    mass: np.ndarray        # labelled documents that a vector stands for
    prior: float
    empty: float            # score of a text without features

    def project(self, x: np.ndarray) -> np.ndarray:
        y = (x * self.weight) @ self.topics
        return y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-9)

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.prior)
        if not len(self.labels):
            return out
        k = min(NEIGHBOURS, len(self.labels))
        for a in range(0, len(x), BLOCK):
            block = np.zeros((BLOCK, x.shape[1]), np.float32)
            n = len(x[a: a + BLOCK])
            block[:n] = x[a: a + BLOCK]
            cosine = np.round(self.project(block) @ self.vectors.T, DIGITS)[:n]
            last = np.partition(cosine, len(self.labels) - k, axis=1)[:, len(self.labels) - k]
            row, near = np.nonzero(cosine >= np.maximum(last, 10.0 ** -DIGITS)[:, None])
            vote = cosine[row, near].astype(np.float64) ** SHARPNESS * self.mass[near]
            total = np.bincount(row, vote, n)
            good = np.bincount(row, vote * self.labels[near], n)
            out[a: a + n] = np.where(total > 1e-9, (good + 1e-3 * self.prior) / (total + 1e-3), self.prior)
        out[~x.any(axis=1)] = self.empty
        return np.clip(out, 0, 1)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> Model:
    """Model from the labelled texts; at most ``per_class`` of each class.

    A document labelled twice counts twice; null labels and ids do not count."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    if not total:
        none = np.zeros((0, TOPICS), np.float32)
        width = FEATURES + SHAPES
        return Model(np.ones(width, np.float32), np.zeros((width, TOPICS), np.float32), none, np.zeros(0), np.zeros(0), 0.5, 0.5)
    picked = None
    for value in sorted(counts):
        some = known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = some if picked is None else picked.union(some)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")) \
        .join(F.broadcast(picked.select("doc_id").distinct()), "doc_id", "left_semi") \
        .groupBy("doc_id").agg(F.min("text").alias("text")).join(F.broadcast(picked), "doc_id").select("label", "text")

    def vectors(batches):
        for batch in batches:
            x = features(*K.column_bytes(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x], pa.binary())], ["label", "x"])
    rows = texts.mapInArrow(vectors, "label int, x binary").collect()
    rows.sort(key=lambda r: (r["label"], bytes(r["x"])))
    x = np.frombuffer(b"".join(r["x"] for r in rows), np.float32).reshape(len(rows), FEATURES + SHAPES)
    y = np.array([r["label"] for r in rows])
    mass = np.array([counts[v] / max((y == v).sum(), 1) for v in y])
    prior, blank = counts.get(1, 0) / total, ~x.any(axis=1)
    empty = float((mass * y)[blank].sum() / mass[blank].sum()) if blank.any() else prior
    weight = (np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))) + 1).astype(np.float32)
    weighted = x * weight
    values, topics = np.linalg.eigh((weighted.T @ weighted).astype(np.float64))
    model = Model(weight, topics[:, ::-1][:, :TOPICS].astype(np.float32), None, y,
                  mass, prior, empty)
    model.vectors = model.project(x).astype(np.float32)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            x = features(*K.column_bytes(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.scores(x), pa.float64())], ["doc_id", "score"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= ``CUT``)."""
    model = fit(docs, labels.where(~held_out("doc_id")))
    return score(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score",
                                     (F.col("score") >= CUT).cast("int").alias("predicted"))
