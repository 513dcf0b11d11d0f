"""Cleaning operators: null fill, fixed-point codec, drops, dedup, order."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.functions.fixedpoint import decode, encode, is_scalable
from txrisk.operators.fingerprint import split_rows


def fill_null_constant(df: DataFrame, column: str, value) -> DataFrame:
    """NULL -> constant on one column (position kept)."""
    if column not in df.columns:
        return df
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value)))


def fixed_point_encode(df: DataFrame, exclude: Iterable[str], scale: int = 100) -> DataFrame:
    """Store every non-excluded numeric/string column as ``round(x*scale)`` bigint.

    One projection for all columns (no withColumn chain); booleans are
    never scaled.
    """
    skip = set(exclude)
    cols = []
    for field in df.schema.fields:
        name = field.name
        if name in skip or not is_scalable(field.dataType):
            cols.append(F.col(name))
        else:
            cols.append(encode(F.col(name), scale).alias(name))
    return df.select(*cols)


def fixed_point_decode(df: DataFrame, columns: Iterable[str], scale: int = 100) -> DataFrame:
    """``x / scale`` as double for the given columns that exist."""
    wanted = set(columns)
    return df.select(*[decode(F.col(c), scale).alias(c) if c in wanted else F.col(c) for c in df.columns])


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop columns, ignoring the ones that are not there."""
    present = [c for c in columns if c in df.columns]
    return df.drop(*present) if present else df


def dedup_full_row(df: DataFrame, fingerprint: Callable[[DataFrame], Column] | None = None) -> DataFrame:
    """Full-row deduplication (NULLs compare equal).

    By default one lazy hash aggregate, whose map-side part collapses the
    copies of a hot row before the shuffle.  With a ``fingerprint``
    (``row_fingerprint``) only rows whose fingerprint repeats are shuffled and
    compared in full; that reads the frame up to three times and runs a job, so
    it suits stored tables whose rows are wide.
    """
    if fingerprint is None:
        return df.dropDuplicates()
    distinct, rest = split_rows(df, fingerprint)
    if rest is None:
        return distinct
    rest = rest.dropDuplicates()
    return rest if distinct is None else distinct.unionByName(rest)


def reorder_columns(df: DataFrame, leading: list[str]) -> DataFrame:
    """Leading columns first (in order), the rest in their current order."""
    lead = [c for c in leading if c in df.columns]
    rest = [c for c in df.columns if c not in lead]
    return df.select(*lead, *rest)


def audit_columns(df: DataFrame, quality_score: float) -> DataFrame:
    """Processing timestamp and constant data-quality score."""
    return df.withColumns({
        "gold_processed_timestamp": F.current_timestamp(),
        "data_quality_score": F.lit(float(quality_score)),
    })
