"""Quantile bins with pandas ``qcut`` semantics (E7, E8).

Edges are the linear-interpolated quantiles at 0, 1/q, ..., 1 (one row).  Duplicate edges collapse; bins are
right-closed with the first one closed on the left, so a value's bin is
the number of distinct edges strictly below it, minus one (floored at 0).
The edge count is unrolled into q+1 comparisons so the projection stays
in generated code.  NULL/NaN stay NULL.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.functions.fixedpoint import nan_to_null
from txrisk.operators.impute import APPROX_ACCURACY
from txrisk.operators.stats import attach, beside

#: Accuracy of the quantile sketch (rank error 1 / SKETCH), ranks around a
#: probability that its bracket takes (in units of that error), and up to how
#: many values a column is its own bracket.
SKETCH = 10_000
MARGIN = 4
WHOLE = 10_000
#: Whole columns: rows of a buffer, of whose sorted values every STEP-th is
#: sketched, and the shares of a column that a bracket may take on each side
#: (the least one that the error bound allows).
BUFFER_ROWS = 1 << 15
STEP = 16
MARGINS = (0.003, 0.02, 0.1)


def _edges_row(df: DataFrame, specs: list[tuple[str, str]], q: int, exact: bool) -> DataFrame:
    """One row holding the q+1 edges ``{prefix}0 .. {prefix}q`` of every
    (column, prefix) spec.

    ``exact=True``: interpolated quantiles from :func:`exact_quantiles`
    (distributed); ``exact=False``: the bounded-memory quantile sketch.
    """
    probs = [i / q for i in range(q + 1)]
    if exact:
        long = exact_quantiles(df, [c for c, _ in specs], probs)
        return long.agg(*[
            F.max(F.when((F.col("column") == c) & (F.col("p") == F.lit(p)), F.col("value"))).alias(f"{prefix}{i}")
            for c, prefix in specs for i, p in enumerate(probs)])
    arr = F.array(*[F.lit(p) for p in probs])
    row = df.agg(*[F.percentile_approx(nan_to_null(F.col(c).cast("double")), arr, APPROX_ACCURACY).alias(f"_arr{k}")
                   for k, (c, _) in enumerate(specs)])
    return row.select(*[F.col(f"_arr{k}")[i].alias(f"{prefix}{i}")
                        for k, (_, prefix) in enumerate(specs) for i in range(q + 1)])


def qcut_bin(x: Column, q: int = 10, prefix: str = "_e", base: int = 0, edges: dict | None = None) -> Column:
    """Bin number of ``x`` given the edges ``{prefix}0 .. {prefix}q`` (see
    module doc); ``edges`` maps those names to Columns (e.g. scalar
    subqueries), otherwise they are read as columns of the row."""
    def e(i: int) -> Column:
        name = f"{prefix}{i}"
        return edges[name] if edges is not None else F.col(name)

    x = nan_to_null(x.cast("double"))
    below = F.when(e(0) < x, 1).otherwise(0)
    for i in range(1, q + 1):
        below = below + F.when((e(i) < x) & (e(i) > e(i - 1)), 1).otherwise(0)
    return F.when(x.isNotNull(), F.greatest(below - 1, F.lit(0)) + F.lit(base))


def add_qcut(df: DataFrame, column: str, out: str, q: int = 10, base: int = 0, exact: bool = True) -> DataFrame:
    """Append a quantile-bin column (1-based labels: ``base=1``)."""
    return add_qcuts(df, [(column, out, base)], q, exact)


def add_qcuts(df: DataFrame, specs: list[tuple[str, str, int]], q: int = 10, exact: bool = True) -> DataFrame:
    """Several quantile-bin columns from ONE edges computation.

    ``specs``: (source column, output column, label base).
    """
    row = _edges_row(df, [(column, f"_e_{out}_") for column, out, _ in specs], q, exact)
    if exact:
        src, edges = beside(df, row, "_edges"), {c: F.col(f"_edges.{c}") for c in row.columns}
    else:
        src, edges = attach(df, row, "_edges")
    return src.select(*df.columns, *[qcut_bin(F.col(column), q, f"_e_{out}_", base, edges).alias(out)
                                     for column, out, base in specs])


def with_group_stats(rows: DataFrame, stats: DataFrame, by: list[str]) -> DataFrame:
    """Rows of present groups joined with their group's statistics on (group,
    salt): a group's rows are dealt over as many tasks as a shuffle has
    partitions, and the statistics (a row a group) are repeated per salt.
    The salt is the input partition, which a repeated task does not change."""
    salts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    copies = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copies, [*by, "_salt"])


def _ranks(n: Column, p: Column, discrete: bool) -> tuple[Column, Column, Column]:
    """The two 0-based ranks of a quantile and the share of the way between."""
    if discrete:
        k = F.greatest(F.ceil(p * n.cast("double")) - 1, F.lit(0))
        return k, k, F.lit(0.0)
    pos = (n - 1).cast("double") * p
    return F.floor(pos), F.ceil(pos), pos - F.floor(pos)


def _sketch(src: DataFrame, values: list[str], sides: list[float], by: list[str], accuracy: int) -> DataFrame:
    """Per value column a struct of n, least, most and the sketch's elements
    at the given probabilities (one aggregate)."""
    q = F.array(*[F.lit(x) for x in sides])
    return src.groupBy(*by).agg(*[F.struct(F.count(v).alias("n"), F.min(v).alias("least"), F.max(v).alias("most"),
                                           F.percentile_approx(v, q, accuracy).alias("q")).alias(v) for v in values])


def _sides(probs: list[float], accuracy: int) -> list[tuple[float, float]]:
    margin = MARGIN / accuracy
    return [(max(p - margin, 0.0), min(p + margin, 1.0)) for p in probs]


def _bracketed(src: DataFrame, values: list[str], probs: list[float], by: list[str], accuracy: int) -> DataFrame:
    """The rows with ``_b.<value>``: the number ``n`` of values and ``cells``,
    per probability two values of the column between which its rank lies."""
    pairs = _sides(probs, accuracy)
    sides = sorted({x for pair in pairs for x in pair})
    at = {x: i for i, x in enumerate(sides)}
    sketch = _sketch(src, values, sides, by, accuracy)

    def side(v: str, x: float, whole: str) -> Column:
        s = F.col(v)
        return F.when(s["n"] <= WHOLE, s[whole]).otherwise(s["q"][at[x]])

    bounds = [F.struct(F.col(v)["n"].alias("n"), F.array(*[
        F.struct(F.lit(j).alias("j"), side(v, low, "least").alias("lo"), side(v, high, "most").alias("hi"))
        for j, (low, high) in enumerate(pairs)]).alias("cells")).alias(v) for v in values]
    return with_group_stats(src, sketch.select(*by, F.struct(*bounds).alias("_b")), by)


def _summaries(src: DataFrame, values: list[str], probs: list[float], accuracy: int) -> dict[int, dict]:
    """Per column with values (by its number): n, least, most, the number of
    buffers and the sketch's elements around each probability.

    A buffer of rows is sorted and every ``STEP``-th value passes on, so a rank
    and the number of values are off by at most ``STEP`` each a buffer; the sketch
    merges what passes."""
    sides = sorted({x for p in probs for m in MARGINS for x in (max(p - m, 0.0), min(p + m, 1.0))})
    names = ["i", "v", "n", "least", "most"]

    def run(batches):
        waiting, size = [], 0

        def summary():
            table = pa.Table.from_batches(waiting)
            points, stats = [], []
            for i, column in enumerate(table.columns):
                x = np.sort(column.drop_null().to_numpy())
                if len(x):
                    points.append((i, x[STEP // 2::STEP] if len(x) > STEP // 2 else x[:1]))
                    stats.append((i, len(x), float(x[0]), float(x[-1])))
            if stats:
                k = [len(v) for _, v in points]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([i for i, _ in points], k).astype(np.int32)), pa.array(np.concatenate([v for _, v in points])),
                     pa.nulls(sum(k), pa.int64()), pa.nulls(sum(k), pa.float64()), pa.nulls(sum(k), pa.float64())], names)
                i, n, least, most = zip(*stats, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.nulls(len(i), pa.float64()), pa.array(n, pa.int64()),
                                                  pa.array(least), pa.array(most)], names)
        for batch in batches:
            waiting.append(batch)
            size += len(batch)
            if size >= BUFFER_ROWS:
                yield from summary()
                waiting, size = [], 0
        if waiting:
            yield from summary()
    found = src.select(*values).mapInArrow(run, "i int, v double, n long, least double, most double").groupBy("i").agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"), F.count("n").alias("buffers"),
        F.percentile_approx("v", F.array(*[F.lit(x) for x in sides]), accuracy).alias("q")).collect()
    return {r["i"]: {**r.asDict(), "at": dict(zip(sides, r["q"], strict=True))} for r in found}


def _selected(src: DataFrame, columns: list[str], values: list[str], probs: list[float], discrete: bool, accuracy: int) -> DataFrame:
    """``exact_quantiles`` of whole columns: the brackets (two numbers a cell)
    are read by one job; one pass over sorted batches then counts up to them
    and keeps what lies strictly inside."""
    cells = []
    for i, s in sorted(_summaries(src, values, probs, accuracy).items()):
        error = 2 * STEP * s["buffers"] / s["n"] + MARGIN / accuracy
        margin = next((m for m in MARGINS if m >= error), None)
        for j, p in enumerate(probs):
            if s["n"] <= WHOLE or margin is None:
                low, high = s["least"], s["most"]
            else:
                low = s["least"] if p <= margin else s["at"][p - margin]
                high = s["most"] if p + margin >= 1 else s["at"][p + margin]
            cells.append((i, j, p, s["n"], low, s["least"] if p == 0 else high) if p < 1 else (i, j, p, s["n"], s["most"], s["most"]))
    known = src.sparkSession.createDataFrame([(columns[i], i, j, float(p), n, lo, hi) for i, j, p, n, lo, hi in cells],
                                             "column string, i int, j int, p double, n long, lo double, hi double")
    wide = [(i, j, lo, hi) for i, j, _, _, lo, hi in cells if lo != hi]
    used = sorted({i for i, *_ in wide})
    edges = {i: [(j, lo, hi) for k, j, lo, hi in wide if k == i] for i in used}

    def run(batches):
        counts = {(i, j): np.zeros(3, np.int64) for i, j, *_ in wide}
        for batch in batches:
            inside = []
            for column, i in zip(batch.columns, used, strict=True):
                x = np.sort(column.drop_null().to_numpy(zero_copy_only=False))
                for j, lo, hi in edges[i]:
                    le, upto = np.searchsorted(x, lo, "right"), np.searchsorted(x, hi, "left")
                    counts[i, j] += [np.searchsorted(x, lo, "left"), le, np.searchsorted(x, hi, "right")]
                    if le < upto:
                        inside.append((i, j, *np.unique(x[le:upto], return_counts=True)))
            if inside:
                sizes = [len(v) for *_, v, _ in inside]
                none = pa.nulls(sum(sizes), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(np.repeat([x[k] for x in inside], sizes).astype(np.int32)) for k in (0, 1)),
                     *(pa.array(np.concatenate([x[k] for x in inside])) for k in (2, 3)), none, none, none], names)
        if counts:
            rows = [[*key, None, 0, *map(int, found)] for key, found in counts.items()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names)
    names = ["i", "j", "v", "c", "lt", "le", "in"]
    types = [pa.int32(), pa.int32(), pa.float64(), *[pa.int64()] * 4]
    found = src.select(*[values[i] for i in used]).mapInArrow(run, "i int, j int, v double, c long, lt long, le long, `in` long") \
        .groupBy("i", "j", "v").agg(*[F.sum(c).alias(c) for c in names[3:]])
    cell = Window.partitionBy("i", "j")
    running = cell.orderBy(F.asc_nulls_first("v")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = found.select("i", "j", "v", "c", F.sum("c").over(running).alias("upto"), *[F.max(c).over(cell).alias(c) for c in ("lt", "le", "in")])
    ranked = placed.join(known.select("i", "j", *[c.alias(k) for k, c in zip(("k0", "k1"), _ranks(F.col("n"), F.col("p"), discrete), strict=False)]), ["i", "j"])
    picked = ranked.groupBy("i", "j").agg(*[F.max(c).alias(c) for c in ("lt", "le", "in")], F.max("upto").alias("between"),
                                          _covering("k0").alias("v0"), _covering("k1").alias("v1"))
    long = known.join(picked, ["i", "j"], "left").withColumns(
        {"lt": F.coalesce("lt", F.lit(0)), "le": F.coalesce("le", "n"), "in": F.coalesce("in", "n")})
    return _interpolated(long.withColumns(dict(zip(("k0", "k1", "part"), _ranks(F.col("n"), F.col("p"), discrete), strict=True))), [])


def _covering(k: str) -> Column:
    """The value strictly inside a bracket that holds rank ``k``."""
    return F.max(F.when((F.col("le") + F.col("upto") - F.col("c") <= F.col(k)) & (F.col(k) < F.col("le") + F.col("upto")), F.col("v")))


def _interpolated(joined: DataFrame, by: list[str]) -> DataFrame:
    """Quantiles of cells with their brackets, counts and covering values."""
    def element(k: str, v: str) -> Column:
        missed = (F.col(k) < F.col("lt")) | (F.col(k) >= F.col("in"))
        return F.when(missed, F.raise_error(F.lit("a rank lies outside its quantile bracket")).cast("double")) \
            .when(F.col(k) < F.col("le"), F.col("lo")) \
            .when(F.col(k) >= F.col("le") + F.coalesce("between", F.lit(0)), F.col("hi")).otherwise(F.col(v))

    low, high = element("k0", "v0"), element("k1", "v1")
    return joined.select(*by, "column", "p", (low + (high - low) * F.col("part")).alias("value"))


def _picked(long: DataFrame, entries: DataFrame, by: list[str], discrete: bool) -> DataFrame:
    """Quantiles from each cell's bracket and counts (``long``) and the values
    strictly inside the brackets (``entries``: *by, _e of column, j, v)."""
    keys = [*by, "column", "j"]
    long = long.withColumns(dict(zip(("k0", "k1", "part"), _ranks(F.col("n"), F.col("p"), discrete), strict=True)))
    inside = entries.groupBy(*by, F.col("_e.column").alias("column"), F.col("_e.j").alias("j"), F.col("_e.v").alias("v")) \
        .agg(F.count("*").alias("c"))
    upto = F.sum("c").over(Window.partitionBy(*keys).orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = inside.withColumn("upto", upto).join(long.select(*keys, "le", "k0", "k1"), keys)
    picked = ranked.groupBy(*keys).agg(F.max("upto").alias("between"), _covering("k0").alias("v0"), _covering("k1").alias("v1"))
    return _interpolated(long.join(picked, keys, "left"), by)


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float], by: list[str] | None = None,
                    discrete: bool = False, accuracy: int = SKETCH) -> DataFrame:
    """Exact linear-interpolated quantiles, distributed (long form), by
    sketch-bracketed selection.

    Output: (*by, column, p, value).

    1. A mergeable quantile sketch of each column (one aggregate, no row is
       copied) gives per probability two values of the column that enclose
       the rank; up to ``WHOLE`` values, they are the extremes.
    2. One more aggregate counts the values up to each of the two.
    3. Only values strictly between the two, about ``2 * MARGIN / accuracy``
       of a column and none that a tie makes frequent, are counted per value
       and summed up in order; the ranks ``p * (n - 1)`` are read off and
       interpolated as ``lo + (hi - lo) * frac``.

    Nothing is stored.  Without ``by`` step 1 is a job that runs while the
    plan is built and steps 2 and 3 are one pass; with groups everything is lazy, the brackets being joined
    to the rows.  The sketch only brackets: a rank outside its bracket (which
    its error bound excludes) is an error, never a wrong value.

    ``discrete=True`` returns an element instead (``percentile_disc``: the
    value at 0-based rank ceil(p * n) - 1).
    """
    by = list(by or [])
    values = [f"_v{i}" for i in range(len(columns))]
    src = df.select(*by, *[nan_to_null(F.col(c).cast("double")).alias(v) for c, v in zip(columns, values, strict=True)])
    for b in by:
        src = src.where(F.col(b).isNotNull())
    if not by:
        return _selected(src, columns, values, probs, discrete, accuracy)
    rows = _bracketed(src, values, probs, by, accuracy)

    def bound(v: str, j: int, name: str) -> Column:
        return F.col("_b")[v]["cells"][j][name]

    cells = [(c, v, j, p) for c, v in zip(columns, values, strict=True) for j, p in enumerate(probs)]
    counted = rows.groupBy(*by).agg(F.first("_b").alias("_b"), *[
        F.count(F.when(test, 1)).alias(f"{name}{v}_{j}") for _, v, j, _ in cells
        for name, test in (("lt", F.col(v) < bound(v, j, "lo")), ("le", F.col(v) <= bound(v, j, "lo")),
                           ("in", F.col(v) <= bound(v, j, "hi")))])
    long = counted.select(*by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(j).alias("j"), F.lit(float(p)).alias("p"), F.col("_b")[v]["n"].alias("n"),
                 bound(v, j, "lo").alias("lo"), bound(v, j, "hi").alias("hi"),
                 *[F.col(f"{name}{v}_{j}").alias(name) for name in ("lt", "le", "in")]) for c, v, j, p in cells])).alias("_e")) \
        .select(*by, "_e.*").where(F.col("n") > 0)

    def strictly(c: str, v: str) -> Column:
        inner = F.filter(F.col("_b")[v]["cells"], lambda x: (x["lo"] < F.col(v)) & (F.col(v) < x["hi"]))
        return F.transform(inner, lambda x: F.struct(F.lit(c).alias("column"), x["j"].alias("j"), F.col(v).alias("v")))

    entries = rows.select(*by, F.explode(F.concat(*[strictly(c, v) for c, v in zip(columns, values, strict=True)])).alias("_e"))
    return _picked(long, entries, by, discrete)
