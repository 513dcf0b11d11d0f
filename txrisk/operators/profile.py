"""Whole-table profile (D1): shape, schema, nulls, duplicates, describe.

Per-column statistics are computed in ONE aggregate over all columns and
unpivoted afterwards (the aggregate row is a single row).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampNTZType, TimestampType

from txrisk.functions.fixedpoint import nan_to_null
from txrisk.operators.fingerprint import row_fingerprint, split_rows


def numeric_columns(df: DataFrame, include_bool: bool = False) -> list[str]:
    """Numeric columns by type (booleans only when asked)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, NumericType) or (include_bool and isinstance(f.dataType, BooleanType)):
            out.append(f.name)
    return out


def _unpivot_row(row: DataFrame, names: list[str], value: str) -> DataFrame:
    """Single-row wide frame -> (column, value) long frame (same types)."""
    return row.unpivot([], names, "column", value)


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def schema_profile(df: DataFrame) -> DataFrame:
    """(position, column, dtype, non_null) per column."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    long = _unpivot_row(counts, df.columns, "non_null")
    meta = df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)],
        "position int, column string, dtype string")
    return F.broadcast(meta).join(long, "column").select("position", "column", "dtype", "non_null").orderBy("position")


def null_counts(df: DataFrame) -> DataFrame:
    """NULL (and NaN for floating columns) count per column."""
    aggs = []
    for f in df.schema.fields:
        c = F.col(f.name)
        cond = c.isNull()
        if f.dataType.typeName() in ("double", "float"):
            cond = cond | F.isnan(c)
        aggs.append(F.count_if(cond).alias(f.name))
    return _unpivot_row(df.agg(*aggs), df.columns, "null_count")


def null_total(df: DataFrame) -> DataFrame:
    return null_counts(df).agg(F.sum("null_count").alias("null_total"))


def duplicate_count(df: DataFrame, fingerprint: Callable[[DataFrame], Column] = row_fingerprint) -> DataFrame:
    """Rows that repeat an earlier identical row (``duplicated().sum()``).

    Rows whose fingerprint repeats are grouped by all columns with partial
    aggregation, then sum(n-1).
    """
    rest = split_rows(df, fingerprint)[1]
    if rest is None:
        return df.sparkSession.range(1).select(F.lit(0).cast("long").alias("duplicate_rows"))
    groups = rest.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def describe(df: DataFrame, columns: list[str] | None = None, exact: bool = True) -> DataFrame:
    """count, mean, std (sample), min, 25%, 50%, 75%, max per numeric column.

    Moments come from one aggregate; quartiles interpolate linearly and are
    computed by the distributed exact quantile operator (``exact=False``
    swaps in the quantile sketch).  Output: one row per column.
    """
    from txrisk.operators.quantile import exact_quantiles

    cols = columns or numeric_columns(df)
    probs = [0.25, 0.5, 0.75]
    aggs = []
    for c in cols:
        x = nan_to_null(F.col(c).cast("double"))
        fields = [F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                  F.min(x).alias("min"), F.max(x).alias("max")]
        if not exact:
            q = F.percentile_approx(x, F.array(*[F.lit(p) for p in probs]), 10000)
            fields += [q[0].alias("p25"), q[1].alias("p50"), q[2].alias("p75")]
        aggs.append(F.struct(*fields).alias(c))
    long = _unpivot_row(df.agg(*aggs), cols, "s").select("column", "s.*")
    if exact:
        qs = exact_quantiles(df, cols, probs).groupBy("column").agg(
            *[F.max(F.when(F.col("p") == F.lit(p), F.col("value"))).alias(n)
              for p, n in zip(probs, ["p25", "p50", "p75"])])
        long = long.join(qs, "column", "left")
    return long.select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def describe_datetime(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, min, 25%, 50%, 75%, max of timestamp columns.

    Computed on epoch microseconds: the mean is an exact integer division of
    a decimal sum, quartiles interpolate linearly through the distributed
    exact quantile operator and are floored to the microsecond.
    """
    from txrisk.functions.calendar import epoch_micros
    from txrisk.operators.quantile import exact_quantiles

    micros = df.select(*[epoch_micros(F.col(c)).alias(c) for c in columns])
    row = micros.agg(*[F.struct(
        F.count(c).alias("count"),
        F.expr(f"sum(cast(`{c}` AS decimal(38,0))) div count(`{c}`)").alias("mean"),
        F.min(c).alias("min"), F.max(c).alias("max")).alias(c) for c in columns])
    moments = _unpivot_row(row, columns, "s").select("column", "s.*")
    qs = exact_quantiles(micros, columns, [0.25, 0.5, 0.75]).groupBy("column").agg(
        *[F.max(F.when(F.col("p") == F.lit(p), F.floor(F.col("value")))).alias(n)
          for p, n in [(0.25, "p25"), (0.5, "p50"), (0.75, "p75")]])
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")

    def ts(c: str):
        return F.timestamp_add("MICROSECOND", F.col(c).cast("long"), epoch).alias(c)

    return moments.join(qs, "column", "left").select(
        "column", "count", ts("mean"), ts("min"), ts("p25"), ts("p50"), ts("p75"), ts("max"))


def amount_quality(df: DataFrame, column: str = "amount") -> DataFrame:
    """min, max, negative count and negative percent of a column."""
    x = F.col(column)
    n = F.count(F.lit(1))
    neg = F.count_if(x < 0)
    return df.agg(F.min(x).alias("min"), F.max(x).alias("max"), neg.alias("negative"),
                  (neg * F.lit(100.0) / n).alias("negative_pct"))


def time_range(df: DataFrame, column: str = "time") -> DataFrame:
    return df.agg(F.min(column).alias("min_time"), F.max(column).alias("max_time"))


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value) for every distinct non-NULL value of each column.

    Columns are cast to string (unpivot needs one type) and de-duplicated by
    a distributed distinct.
    """
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "column", "value")
    return long.where(F.col("value").isNotNull()).distinct().orderBy("column", "value")


def distinct_cardinality(df: DataFrame, columns: list[str]) -> DataFrame:
    """Number of distinct non-NULL values per column (exact)."""
    return (distinct_values(df, columns).groupBy("column")
            .agg(F.count(F.lit(1)).alias("n_distinct")).orderBy("column"))


def overall_rate(df: DataFrame, label: str, scale: float = 100.0) -> DataFrame:
    return df.agg((F.avg(F.col(label).cast("double")) * F.lit(scale)).alias("fraud_rate"))
