"""Group reports: counts, mean-label rates, pivots (D2-D5 families).

Every report is one hash aggregate with partial (map-side) aggregation,
so the shuffle carries one row per group per map task whatever the skew.
NULL keys are left out, as pandas group-by does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.functions.fixedpoint import nan_to_null
from txrisk.operators.stats import attach
from txrisk.schema import LABEL


def _not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def fixed_mean(x: Column, fixed_point: int) -> Column:
    """Mean of a column stored on a 1/fixed_point grid (gold decodes its
    numerics from hundredths): an exact integer sum divided once, so the
    result does not depend on partitioning or combine order."""
    units = F.round(nan_to_null(x.cast("double")) * F.lit(float(fixed_point)), 0).cast("long")
    return F.sum(units).cast("double") / F.count(units) / F.lit(float(fixed_point))


def rate_by(df: DataFrame, keys: Sequence[str], value: str = LABEL, scale: float = 100.0,
            alias: str = "fraud_rate", order: str = "key", order_keys: Sequence[Column] | None = None,
            fixed_point: int | None = None) -> DataFrame:
    """``mean(value) * scale`` per group (fraud rate in percent by default).

    ``order``: 'key' (ascending keys), 'desc' (value descending, keys as
    tie-break) or 'none'.  ``order_keys`` overrides the key order (e.g. a
    calendar position for month names).  ``fixed_point``: the value lives on
    that grid, so the mean is taken exactly (see :func:`fixed_mean`).
    """
    keys = list(keys)
    if fixed_point:
        rate = fixed_mean(F.col(value), fixed_point)
    else:
        rate = F.avg(F.col(value).cast("double"))
    if scale != 1:
        rate = rate * F.lit(float(scale))
    out = df.where(_not_null(keys)).groupBy(*keys).agg(rate.alias(alias))
    if order == "desc":
        return out.orderBy(F.col(alias).desc(), *keys)
    if order == "key":
        return out.orderBy(*(order_keys or keys))
    return out


def count_by(df: DataFrame, keys: Sequence[str], alias: str = "count", order: str = "desc") -> DataFrame:
    """Row count per group (``value_counts`` / ``groupby().size()``)."""
    keys = list(keys)
    out = df.where(_not_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))
    if order == "desc":
        return out.orderBy(F.col(alias).desc(), *keys)
    if order == "key":
        return out.orderBy(*keys)
    return out


def label_counts(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Count and percent share per label value (bar + pie tables).

    The share divides by a global total computed by a one-row aggregate
    (read as a scalar subquery), not by an unpartitioned window.
    """
    counts = count_by(df, [label], order="none")
    src, total = attach(counts, counts.agg(F.sum("count").alias("_total")), "_sum")
    return (src.select(label, "count", (F.col("count") * F.lit(100.0) / total["_total"]).alias("percent"))
            .orderBy(F.col("count").desc(), label))


def daily_volume(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Transactions per calendar date."""
    return (df.where(F.col(ts).isNotNull()).groupBy(F.to_date(F.col(ts)).alias("date"))
            .agg(F.count(F.lit(1)).alias("transaction_count")).orderBy("date"))


def pivot_rate(df: DataFrame, rows: str, cols: str, value: str = LABEL, scale: float = 100.0,
               values: Sequence | None = None, order_keys: Sequence[Column] | None = None) -> DataFrame:
    """Wide matrix of ``mean(value)*scale``; empty cells -> 0.

    The rates are aggregated once to (row, column, rate); that small table
    is pivoted.  Without ``values`` Spark finds the columns itself, so
    ``spark.sql.pivotMaxValues`` bounds the width of the result.
    """
    src = df.where(F.col(rows).isNotNull() & F.col(cols).isNotNull())
    rate = F.avg(F.col(value).cast("double")) * F.lit(float(scale))
    cells = src.groupBy(rows, cols).agg(rate.alias("_rate"))
    wide = cells.groupBy(rows).pivot(cols, list(values) if values is not None else None).agg(F.first("_rate"))
    wide = wide.na.fill(0.0, subset=[c for c in wide.columns if c != rows])
    return wide.orderBy(*(order_keys or [rows]))
