"""Tables behind histograms, box plots, violins and scatter samples (D6, D7).

Global statistics (the value range) are one-row aggregates read through a
scalar subquery;
per-group statistics (quartiles, bandwidths) are joined back on the group
key and a salt, so no operator gathers the rows of a group.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.functions.fixedpoint import nan_to_null
from txrisk.operators.quantile import exact_quantiles, with_group_stats
from txrisk.operators.stats import attach
from txrisk.schema import LABEL


#: Bandwidths beyond which a kernel counts as 0.
REACH = 9.0


def histogram(df: DataFrame, column: str, bins: int, by: str | None = None) -> DataFrame:
    """Equal-width histogram over the global [min, max] of ``column``.

    ``bins`` bins, the last one closed; a zero range gives one bin.  Output:
    (by, bin, bin_lo, bin_hi, count, density) with density = count / width
    (width 1 for a zero range).  Empty bins are not emitted.
    """
    x = nan_to_null(F.col(column).cast("double"))
    src = df.select(*([F.col(by)] if by else []), x.alias("_x")).where(F.col("_x").isNotNull())
    if by:
        src = src.where(F.col(by).isNotNull())
    src, rng = attach(src, src.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi")), "_range")
    lo, hi = rng["_lo"], rng["_hi"]
    n = F.lit(bins)
    width = F.when(hi > lo, (hi - lo) / n).otherwise(F.lit(1.0))
    b = F.when(hi > lo, F.least(F.floor((F.col("_x") - lo) / (hi - lo) * n), F.lit(bins - 1))).otherwise(F.lit(0))
    keyed = src.select(*([F.col(by)] if by else []), b.cast("int").alias("bin"), lo.alias("_lo"), width.alias("_w"))
    keys = ([by] if by else []) + ["bin"]
    out = keyed.groupBy(*keys, "_lo", "_w").agg(F.count(F.lit(1)).alias("count"))
    return out.select(
        *keys,
        (F.col("_lo") + F.col("bin") * F.col("_w")).alias("bin_lo"),
        (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("bin_hi"),
        "count",
        (F.col("count") / F.col("_w")).alias("density"),
    ).orderBy(*keys)


def _quartiles(df: DataFrame, column: str, by: str, exact: bool) -> DataFrame:
    x = F.col(column).cast("double")
    if exact:
        long = exact_quantiles(df, [column], [0.25, 0.5, 0.75], by=[by])
        st = long.groupBy(by).agg(*[F.max(F.when(F.col("p") == F.lit(p), F.col("value"))).alias(n)
                                    for p, n in [(0.25, "q1"), (0.5, "median"), (0.75, "q3")]])
    else:
        q = F.percentile_approx(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 10000)
        st = df.where(F.col(by).isNotNull() & x.isNotNull()).groupBy(by).agg(q.alias("_q"))
        st = st.select(by, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return st.select(by, "q1", "median", "q3", iqr.alias("iqr"),
                     (F.col("q1") - F.lit(1.5) * iqr).alias("lower_fence"),
                     (F.col("q3") + F.lit(1.5) * iqr).alias("upper_fence"))


def box_stats(df: DataFrame, column: str, by: str = LABEL, exact: bool = True) -> DataFrame:
    """Per group: quartiles (linear), IQR, fences, whiskers (extreme values
    inside the fences), outlier count, min, max, n."""
    src = df.select(by, nan_to_null(F.col(column).cast("double")).alias(column))
    st = _quartiles(src, column, by, exact)
    x = F.col(column)
    inside = (x >= F.col("lower_fence")) & (x <= F.col("upper_fence"))
    found = with_group_stats(src.where(F.col(by).isNotNull() & x.isNotNull()), st, [by])
    parts = found.groupBy(by, "_salt").agg(
        *[F.first(c).alias(c) for c in st.columns if c != by],
        F.min(F.when(inside, x)).alias("whisker_low"), F.max(F.when(inside, x)).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"), F.min(x).alias("min"), F.max(x).alias("max"), F.count(F.lit(1)).alias("n"))
    return parts.groupBy(by).agg(
        *[F.first(c).alias(c) for c in st.columns if c != by],
        F.min("whisker_low").alias("whisker_low"), F.max("whisker_high").alias("whisker_high"),
        F.sum("n_outliers").alias("n_outliers"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.sum("n").alias("n")).orderBy(by)


def box_outliers(df: DataFrame, column: str, by: str = LABEL, exact: bool = True) -> DataFrame:
    """Rows outside the 1.5 IQR fences of their group (box ``points``)."""
    src = df.select(by, nan_to_null(F.col(column).cast("double")).alias(column))
    st = _quartiles(src, column, by, exact)
    x = F.col(column)
    return (with_group_stats(src.where(F.col(by).isNotNull() & x.isNotNull()),
                             st.select(by, "lower_fence", "upper_fence"), [by])
            .where((x < F.col("lower_fence")) | (x > F.col("upper_fence")))
            .select(by, column))


def kde(df: DataFrame, column: str, by: str = LABEL, points: int = 64) -> DataFrame:
    """Gaussian kernel density per group on ``points`` grid points over the
    group's [min, max]; bandwidth h = 1.06 * sd * n^(-1/5) (Silverman).

    Rows are first collapsed to (group, value, count), so that repeated values
    cost one evaluation.  A value then meets only the grid points within
    ``REACH`` bandwidths (beyond, a kernel is below 1e-17), and the sums per
    (group, grid point) are aggregated partially.
    """
    src = (df.select(by, nan_to_null(F.col(column).cast("double")).alias("_x"))
           .where(F.col(by).isNotNull() & F.col("_x").isNotNull()))
    st = src.groupBy(by).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"),
                             F.stddev_samp("_x").alias("_sd"), F.count(F.lit(1)).alias("_n"))
    h = F.lit(1.06) * F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))
    st = st.select(by, "_lo", "_hi", "_n", F.when(h > 0, h).otherwise(F.lit(1.0)).alias("_h"))
    vals = src.groupBy(by, "_x").agg(F.count(F.lit(1)).alias("_c"))
    joined = with_group_stats(vals, st, [by])
    step = (F.col("_hi") - F.col("_lo")) / F.lit(float(max(points - 1, 1)))
    norm = F.lit(1.0 / math.sqrt(2.0 * math.pi))
    x, h, reach = F.col("_x"), F.col("_h"), F.lit(REACH) * F.col("_h")
    flat = step <= 0  # one value: every grid point stands on it
    first = F.when(flat, 0).otherwise(F.greatest(F.ceil((x - reach - F.col("_lo")) / step), F.lit(0)))
    last = F.when(flat, points - 1).otherwise(F.least(F.floor((x + reach - F.col("_lo")) / step), F.lit(points - 1)))
    keys = [by, "_lo", "_hi", "_n", "_h"]
    near = joined.withColumns({"_first": first.cast("int"), "_last": last.cast("int")}) \
        .select(*keys, "_x", "_c", F.explode(F.when(F.col("_first") <= F.col("_last"), F.sequence("_first", "_last"))).alias("point"))
    u = (F.col("_lo") + F.col("point") * step - x) / h
    sums = near.groupBy(*keys, "point").agg(F.sum(F.col("_c") * F.exp(F.lit(-0.5) * u * u)).alias("_s"))
    # at most ``points`` sums a group; a grid point that no value is near to has density 0
    wide = sums.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("point", "_s"))).alias("_sums"))
    long = wide.select(*keys, "_sums", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    return long.select(
        by, "point",
        (F.col("_lo") + F.col("point") * (F.col("_hi") - F.col("_lo")) / F.lit(float(max(points - 1, 1)))).alias("x"),
        (F.coalesce(F.try_element_at("_sums", F.col("point")), F.lit(0.0)) * norm / (F.col("_n") * h)).alias("density"),
    ).orderBy(by, "point")


def sample_rows(df: DataFrame, n: int, seed: int = 42, key: str | None = None) -> DataFrame:
    """Uniform sample of min(n, rows) rows without replacement, lazily.

    The n rows with the smallest MD5 of (seed, ``key``) are taken (default:
    the transaction id, else the first column), so the same rows come out
    under any partitioning, and in SQL.  The n-th smallest hash is found first,
    from the key alone (a heap per partition), and only rows up to it are
    sorted: projections on top of the sample can part the limit from the sort,
    which then moves every row it gets.  The frame is read twice.  Rows that
    share a key tie and are taken in the order of their other columns.
    """
    key = key or ("transaction_id" if "transaction_id" in df.columns else df.columns[0])
    hashed = F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"))
    last = df.select(hashed.alias("_h")).orderBy("_h").limit(n).agg(F.max("_h")).scalar()
    return df.withColumn("_h", hashed).where(F.col("_h") <= last).orderBy("_h", *[c for c in df.columns if c != key]).limit(n).drop("_h")
