"""Pearson correlation with pandas semantics (pairwise-complete rows,
NULL for a constant column).

With one target, ``corr = covar_pop(x, y) / (stddev_pop(x) * stddev_pop(y))`` where both
standard deviations only see rows where the other column is present; a
zero denominator gives NULL instead of a division error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.operators.profile import numeric_columns
from txrisk.operators.stats import attach


def pair_corr(x: Column, y: Column) -> Column:
    both = x.isNotNull() & y.isNotNull()
    sx = F.stddev_pop(F.when(both, x))
    sy = F.stddev_pop(F.when(both, y))
    den = sx * sy
    return F.covar_pop(x, y) / F.when(den != 0, den)


def _prepared(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols])


def corr_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Long-form matrix (col1, col2, corr) over all ordered pairs incl. the
    diagonal, over pairwise-complete rows; lazy.

    Rows are shifted by the column means (for the digits; a correlation does
    not change) and grouped by the pattern of columns that are there, with
    partial aggregation.  Each pattern has the sums and cross products of its
    columns, and a pair adds up the patterns that hold both.  Without NULLs
    there is one pattern, so a full table costs one product a pair and row.
    A column that is constant on the pair's rows gives NULL, the diagonal is
    1; a result outside [-1, 1] by rounding is clipped.
    """
    cols = columns or numeric_columns(df)
    src = _prepared(df, cols)
    k = len(cols)
    src, means = attach(src, src.agg(*[F.avg(c).alias(c) for c in cols]), "_means")
    present = F.lit(0).cast("decimal(38,0)") if k > 63 else F.lit(0).cast("long")
    for i, c in enumerate(cols):
        present = present + F.when(F.col(c).isNotNull(), F.lit(2 ** i)).otherwise(F.lit(0))
    shifted = src.select(present.alias("_present"), *[(F.col(c) - means[c]).alias(f"x{i}") for i, c in enumerate(cols)])
    sums = [F.count(F.lit(1)).alias("n")]
    for i in range(k):
        sums += [F.sum(f"x{i}").alias(f"s{i}"), F.min(f"x{i}").alias(f"lo{i}"), F.max(f"x{i}").alias(f"hi{i}")]
        sums += [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}_{j}") for j in range(i, k)]
    patterns = shifted.groupBy("_present").agg(*sums)
    i, j = F.floor(F.col("_at") / k).cast("int"), (F.col("_at") % k).cast("int")
    names = F.array(*[F.lit(c) for c in cols])
    every = {name: F.array(*[F.col(f"{name}{at}") for at in range(k)]) for name in ("s", "lo", "hi")}
    every["p"] = F.array(*[F.col(f"p{min(x, y)}_{max(x, y)}") for x in range(k) for y in range(k)])
    pairs = patterns.select("n", *[array.alias(name) for name, array in every.items()],
                            F.explode(F.sequence(F.lit(0), F.lit(k * k - 1))).alias("_at")).select(
        "n", F.get(names, i).alias("col1"), F.get(names, j).alias("col2"),
        *[F.get(F.col(name), at).alias(f"{name}_{side}") for side, at in (("a", i), ("b", j)) for name in ("s", "lo", "hi")],
        F.get(F.col("p"), i * k + i).alias("aa"), F.get(F.col("p"), j * k + j).alias("bb"), F.get(F.col("p"), i * k + j).alias("ab"))
    # a pattern without one of the pair's columns has no cross product
    n = F.sum(F.when(F.col("ab").isNotNull(), F.col("n")))

    def over(fn, name):
        return fn(F.when(F.col("ab").isNotNull(), F.col(name)))

    def centred(product, a, b):
        return over(F.sum, product) - over(F.sum, a) * over(F.sum, b) / n

    varies = (over(F.max, "hi_a") > over(F.min, "lo_a")) & (over(F.max, "hi_b") > over(F.min, "lo_b"))
    squares = centred("aa", "s_a", "s_a") * centred("bb", "s_b", "s_b")
    corr = F.greatest(F.least(centred("ab", "s_a", "s_b") / F.sqrt(F.when(squares > 0, squares)), F.lit(1.0)), F.lit(-1.0))
    return (pairs.groupBy("col1", "col2")
            .agg(F.when(varies & (F.col("col1") == F.col("col2")), F.lit(1.0)).when(varies & (squares > 0), corr)
                 .alias("corr")))


def corr_with(df: DataFrame, target: str, columns: list[str]) -> DataFrame:
    """(feature, correlation) of each column with ``target`` (target left out)."""
    feats = [c for c in columns if c != target]
    src = _prepared(df, [target, *feats])
    row = src.agg(*[pair_corr(F.col(c), F.col(target)).alias(c) for c in feats])
    return row.unpivot([], feats, "feature", "correlation")


def corr_with_label(df: DataFrame, label: str, include_bool: bool = False) -> DataFrame:
    """Correlation with the label, descending (NULL last, name as tie-break)."""
    cols = numeric_columns(df, include_bool=include_bool)
    return corr_with(df, label, cols).orderBy(F.col("correlation").desc_nulls_last(), "feature")


def corr_rank_abs(df: DataFrame, label: str, k: int) -> DataFrame:
    """Top-k features by |correlation| with the label (booleans as 0/1).

    A top-k over a handful of rows; ties broken by feature name so the cut
    is deterministic.
    """
    cols = numeric_columns(df, include_bool=True)
    ranked = corr_with(df, label, cols).select("feature", F.abs("correlation").alias("abs_correlation"))
    return ranked.orderBy(F.col("abs_correlation").desc_nulls_last(), "feature").limit(k)
