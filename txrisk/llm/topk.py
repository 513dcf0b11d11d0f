"""Exact top-k search by inner product in norm-bucketed blocks.

Vectors become integers (``floor(scale * x)``).  The candidates are sorted by
length over the whole cluster and cut into buckets of neighbouring lengths;
the queries are cut into blocks.  A first pass scores every block against the
bucket of the longest vectors: its (k+1)-th best score bounds a query's answer
from below.  The second pass meets a block only with buckets that the bound
leaves open (|query| * longest of the bucket >= bound), and inside a bucket
each query takes the cheaper pruning at its local cosine threshold
``bound / (|query| * longest)``:

* length: only the bucket's prefix of vectors that are long enough;
* coordinates: with an angle of at most ``arccos(threshold)`` between both
  vectors, each unit coordinate of the candidate lies within that angle of
  the query's; the narrowest interval of the query's ``FOCUS`` largest
  coordinates is looked up in the sorted coordinate and cut with the others.

What is left is verified by its full inner product.  A bucket or block is one
row of packed numbers, so a pair ships two rows; no row is made per pair of
vectors that was not verified.  The bounds only prune: results are exact.

Defined cases: vectors that are null or hold null, NaN or infinite components
take no part.  Vectors of different lengths (dimensions) have no score.  Empty
vectors score 0 with each other.  Ties go to the smaller id, a null id last (a
null id is a candidate, never a query).  A query leaves out its own row only,
so rows that repeat an id are candidates and queries of their own.  Scores
beyond 64 bits are clipped to the range of long.  Further columns are not read.
An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.llm.common import stored

#: Components of one bucket of candidates and of one block of queries.
BUCKET_VALUES = 1 << 19
BLOCK_VALUES = 1 << 17
#: Coordinates a query looks at, and the local cosine threshold from which it does.
FOCUS = 3
COORDINATES_FROM = 0.3
#: Scattered products cost about so many times those of a contiguous prefix.
SCATTER = 4
#: Queries scored at once (rows of one score matrix).
AT_ONCE = 128
#: Relative room for rounding in lengths, cosines and bounds.
SLACK = 1e-9

_PACKED = "part long, dim int, n int, longest double, ids array<long>, width int, numbers binary"
_FOUND = "block long, q int, query_id long, vec_id long, score long, own boolean"


def usable(vector: Column) -> Column:
    """The vector is there and so are all its components, as finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def _integers(column: pa.Array, dim: int, scale: float) -> np.ndarray:
    """floor(scale * x) of a list column, one row per vector, as doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * scale).reshape(len(column), dim)


def _packed(part: int, ids: pa.Array, values: np.ndarray) -> pa.RecordBatch:
    """One row: vectors by falling length, in the narrowest exact numbers."""
    with np.errstate(over="ignore"):
        length = np.sqrt((values * values).sum(axis=1))
    order = np.argsort(-length, kind="stable")
    most = np.abs(values).max(initial=0)
    width = 2 if most < 2**15 else 4 if most < 2**31 else 8
    kind = {2: np.int16, 4: np.int32, 8: np.float64}[width]
    return pa.RecordBatch.from_arrays(
        [pa.array([part]), pa.array([values.shape[1]], pa.int32()), pa.array([len(values)], pa.int32()),
         pa.array([float(length.max(initial=0))]), pa.array([ids.take(pa.array(order)).to_pylist()], pa.list_(pa.int64())),
         pa.array([width], pa.int32()), pa.array([values[order].astype(kind).tobytes()], pa.binary())],
        ["part", "dim", "n", "longest", "ids", "width", "numbers"])


def packed(rows: DataFrame, values: int, scale: float) -> DataFrame:
    """Consecutive vectors of one dimension in rows of at most ``values``
    components (``rows``: dim, id, vector, in the order wanted)."""
    def run(batches):
        seq = TaskContext.get().partitionId() << 24
        ids, parts, dim, held = [], [], -1, 0
        for batch in batches:
            dims = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(dims)) + 1).tolist(), len(dims)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if held and dims[a] != dim:
                    yield _packed(seq, pa.concat_arrays(ids), np.concatenate(parts))
                    seq, ids, parts, held = seq + 1, [], [], 0
                dim = int(dims[a])
                limit = max(1, values // max(dim, 1))
                while a < b:
                    take = min(b - a, limit - held)
                    ids.append(batch.column(1).slice(a, take))
                    parts.append(_integers(batch.column(2).slice(a, take), dim, scale))
                    a, held = a + take, held + take
                    if held == limit:
                        yield _packed(seq, pa.concat_arrays(ids), np.concatenate(parts))
                        seq, ids, parts, held = seq + 1, [], [], 0
        if held:
            yield _packed(seq, pa.concat_arrays(ids), np.concatenate(parts))
    return rows.mapInArrow(run, _PACKED)


def _numbers(width: int, raw: bytes, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(raw, {2: np.int16, 4: np.int32, 8: np.float64}[width]).reshape(n, dim).astype(np.float64)


class Bucket:
    """Candidates of one packed row, sorted by falling length."""

    def __init__(self, ids: pa.Array, values: np.ndarray) -> None:
        self.ids, self.values = ids, values
        numbers = ids.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
        self.by_id = np.empty(len(values), np.int64)    # rank by id, null last
        self.by_id[np.lexsort((numbers, ids.is_null().to_numpy(zero_copy_only=False)))] = np.arange(len(values))
        self.numbers, self.missing = numbers, ids.is_null().to_numpy(zero_copy_only=False)
        with np.errstate(over="ignore"):
            self.length = np.sqrt((values * values).sum(axis=1))
        self._sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self._unit: np.ndarray | None = None

    def unit(self) -> np.ndarray:
        if self._unit is None:
            self._unit = self.values / np.where(self.length > 0, self.length, 1)[:, None]
        return self._unit

    def coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self._sorted:
            column = self.unit()[:, f]
            order = np.argsort(column, kind="stable")
            self._sorted[f] = order, column[order]
        return self._sorted[f]

    def within(self, query: np.ndarray, cosine: float) -> np.ndarray | None:
        """Rows whose focus coordinates allow the cosine; None if the narrowest
        interval is no saving over the prefix by length."""
        angle = math.acos(min(1.0, max(-1.0, cosine - SLACK)))
        best, ranges = None, []
        for f in np.argsort(-np.abs(query))[:FOCUS]:
            own = math.acos(min(1.0, max(-1.0, float(query[f]))))
            low, high = math.cos(min(math.pi, own + angle)) - SLACK, math.cos(max(0.0, own - angle)) + SLACK
            order, column = self.coordinate(int(f))
            a, b = np.searchsorted(column, low, "left"), np.searchsorted(column, high, "right")
            ranges.append((int(f), low, high))
            if best is None or b - a < best[1] - best[0]:
                best = a, b, order
        a, b, order = best
        if (b - a) * SCATTER >= len(self.values):
            return None
        rows = order[a:b]
        for f, low, high in ranges:
            column = self.unit()[rows, f]
            rows = rows[(column >= low) & (column <= high)]
        return rows


def _exact(values: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in row] for row in values], dtype=object).reshape(values.shape)


def _best(rows: np.ndarray, scores: np.ndarray, by_id: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of the rows: highest score, then smallest id."""
    if len(rows) > k:
        last = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > last)
        ties = np.flatnonzero(scores == last)
        need = k - len(above)
        if len(ties) > need:
            ties = ties[np.argpartition(by_id[rows[ties]], need - 1)[:need]]
        pick = np.concatenate([above, ties])
        rows, scores = rows[pick], scores[pick]
    return rows, scores


def meet(bucket: Bucket, queries: np.ndarray, bounds: np.ndarray, k: int):
    """(query, rows, scores): of each query the k best rows at or above its bound."""
    lengths = np.sqrt((queries * queries).sum(axis=1)) if len(queries) else np.zeros(0)
    n = len(bucket.values)
    largest = (bucket.length.max(initial=0) + 1) * (lengths.max(initial=0) + 1)
    if not largest < 2**52:  # beyond exact doubles: whole numbers of any size, nothing pruned
        left, right = _exact(queries), _exact(bucket.values).T
        for q in range(len(queries)):
            every = (left[q: q + 1] @ right)[0] if queries.shape[1] else np.zeros(n, object)
            scores = np.array([min(max(int(s), -2**63), 2**63 - 1) for s in every], np.int64)
            yield q, *_best(np.arange(n), scores, bucket.by_id, k)
        return
    longest = bucket.length[0] if n else 0.0
    positive = (bounds > 0) & (lengths > 0)
    need = np.where(positive, bounds / np.where(lengths > 0, lengths, 1), np.where(bounds > 0, np.inf, -np.inf))
    prefix = np.searchsorted(-bucket.length, -(need - np.abs(np.where(np.isfinite(need), need, 0)) * SLACK), "right")
    by_prefix = []
    for q in np.flatnonzero(prefix > 0):
        cosine = need[q] / longest if longest > 0 else -1.0
        if cosine >= COORDINATES_FROM:
            rows = bucket.within(queries[q] / lengths[q], cosine)
            if rows is not None:
                scores = bucket.values[rows] @ queries[q]
                keep = scores >= bounds[q]
                if keep.any():
                    yield int(q), *_best(rows[keep], scores[keep].astype(np.int64), bucket.by_id, k)
                continue
        by_prefix.append(int(q))
    by_prefix.sort(key=lambda q: prefix[q])
    for i in range(0, len(by_prefix), AT_ONCE):
        some = np.array(by_prefix[i: i + AT_ONCE])
        scores = queries[some] @ bucket.values[: prefix[some[-1]]].T
        hit = scores >= bounds[some][:, None]
        for r in np.flatnonzero(hit.any(axis=1)):
            rows = np.flatnonzero(hit[r])
            yield int(some[r]), *_best(rows, scores[r, rows].astype(np.int64), bucket.by_id, k)


def _scored(pairs: DataFrame, buckets: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """The k best of every (bucket, block) pair, own rows among them."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        one, two = ({c: t.column(c)[0] for c in t.column_names} for t in (left, right))
        ids = one["ids"].values
        bucket = Bucket(ids, _numbers(one["width"].as_py(), one["numbers"].as_py(), one["n"].as_py(), one["dim"].as_py()))
        queries = _numbers(two["width"].as_py(), two["numbers"].as_py(), two["n"].as_py(), two["dim"].as_py())
        names = two["ids"].values.to_numpy(zero_copy_only=False)
        bounds = np.array(two["bounds"].as_py(), np.float64) if two["bounds"].as_py() else np.full(len(queries), -np.inf)
        q, at, score = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for query, rows, scores in meet(bucket, queries, bounds, k):
            q.append(np.full(len(rows), query))
            at.append(rows)
            score.append(scores)
        q, at, score = (np.concatenate(x) for x in (q, at, score))
        squares = np.array([min(sum(int(x) * int(x) for x in row), 2**63 - 1) for row in queries], np.int64)
        own = (bucket.numbers[at] == names[q]) & ~bucket.missing[at] & (score == squares[q])
        return pa.table({"block": pa.array(np.full(len(q), two["block"].as_py())), "q": pa.array(q.astype(np.int32)),
                         "query_id": pa.array(names[q].astype(np.int64)), "vec_id": ids.take(pa.array(at)),
                         "score": pa.array(score), "own": pa.array(own)})
    left = pairs.join(buckets, "part").groupBy("part", "block")
    again = pairs.select(F.col("part").alias("with_part"), F.col("block").alias("with_block"))
    right = again.join(blocks, F.col("with_block") == F.col("block")).groupBy("with_part", "with_block")
    return left.cogroup(right).applyInArrow(run, _FOUND)


def search(queries: DataFrame, candidates: DataFrame, k: int = 5, id_column: str = "vec_id", vector: str = "embedding",
           scale: float = 256.0, bucket_values: int = BUCKET_VALUES, block_values: int = BLOCK_VALUES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each query.

    ``queries`` are rows of the same table as ``candidates``, or of another;
    one candidate with the query's id and vector is taken for its own row and
    left out.  The search runs two jobs while it is built (counts, bounds).
    """
    def numbers(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_column).cast("long").alias("id"), F.col(vector).alias("v")).where(usable(F.col("v"))) \
            .select(F.size("v").alias("dim"), "id", "v")

    rows, asked = numbers(candidates), numbers(queries.where(F.col(id_column).isNotNull()))
    count = F.sum(F.greatest("dim", F.lit(1))).alias("n")
    n, m = (df.agg(count).first()["n"] or 0 for df in (rows, asked))
    squared = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    longest_first = ["dim", F.desc("squared"), "tie"]
    sorted_rows = rows.withColumn("squared", squared).withColumn("tie", F.xxhash64("id")) \
        .repartitionByRange(-(-n // bucket_values) or 1, *longest_first).sortWithinPartitions(*longest_first).select("dim", "id", "v")
    buckets = stored(packed(sorted_rows, bucket_values, scale))
    blocks = stored(packed(asked.repartition(-(-m // block_values) or 1).sortWithinPartitions("dim"), block_values, scale)
                    .withColumnRenamed("part", "block"))
    first = buckets.groupBy("dim").agg(F.max_by("part", F.struct("longest", "part")).alias("part"))
    seeds = blocks.select("block", "dim").join(first, "dim").select("part", "block")
    seen = stored(_scored(seeds, buckets, blocks.withColumn("bounds", F.lit(None).cast("array<double>")), k + 1))
    bound = seen.groupBy("block", "q").agg(F.when(F.count("*") > k, F.min("score").cast("double"))
                                           .otherwise(float("-inf")).alias("bound"))
    bounds = bound.groupBy("block").agg(F.transform(F.sort_array(F.collect_list(F.struct("q", "bound"))),
                                                    lambda x: x["bound"]).alias("bounds"))
    known = stored(blocks.join(bounds, "block", "left"))
    open_from = F.when(F.forall("bounds", lambda x: x > 0), F.array_min("bounds") / F.col("b.longest")).otherwise(float("-inf"))
    pairs = buckets.select("part", "dim", "longest").alias("a").join(known.alias("b"), "dim") \
        .where((F.col("a.longest") * (1 + SLACK) >= open_from) | F.col("b.bounds").isNull()) \
        .select("part", "block").join(seeds, ["part", "block"], "left_anti")
    every = seen.unionByName(_scored(pairs, buckets, known, k + 1))
    by_query = Window.partitionBy("block", "q")
    place = F.row_number().over(by_query.orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), F.desc("own")))
    ranked = every.withColumn("place", place).where(F.col("place") <= k + 1) \
        .withColumn("mine", F.min(F.when(F.col("own"), F.col("place"))).over(by_query))
    rank = F.col("place") - F.when(F.col("mine") < F.col("place"), 1).otherwise(0)
    return ranked.withColumn("rank", rank.cast("int")) \
        .where((F.col("mine").isNull() | (F.col("mine") != F.col("place"))) & (F.col("rank") <= k)) \
        .select("query_id", "rank", "vec_id", "score")


def digest(embeddings: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: rows whose vec_id is divisible by
    ``every`` against all rows."""
    return search(embeddings.where(F.col("vec_id") % every == 0), embeddings, k)


#: DuckDB SQL for ``digest``'s rows (double sums are exact: scores stay under 2**53).
SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT q.r AS qr, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r AND len(q.e) = len(c.e)
  WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, vec_id, score,
         row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id ASC NULLS LAST) AS place FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
"""
