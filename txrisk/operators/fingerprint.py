"""Repeated rows by fingerprints first.

A 64-bit hash of a row stands for it in the only shuffle that sees every row.
Rows whose fingerprint occurs once are distinct and go through as they
are; rows that share one are compared in full, so equal fingerprints of
different rows do no harm (among 10^12 rows some 10^4 pairs).  The repeated fingerprints are a stored table whose
rows are counted: up to ``BROADCAST_ROWS`` of them are broadcast to the scan,
beyond that all rows are compared in full by one hash aggregate.

The frame is read again for the comparison, so it should be a stored table or
a projection of one.  NULLs compare equal, as do NaN and NaN, 0.0 and -0.0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txrisk.session import cut_lineage

#: Repeated fingerprints (8 bytes each) that are broadcast.
BROADCAST_ROWS = 1_000_000
_NESTED = (T.ArrayType, T.MapType, T.StructType)


def row_fingerprint(df: DataFrame) -> Column:
    """Hash of a row's plain columns and of the places of its NULLs."""
    parts = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, _NESTED) or field.dataType.typeName() == "variant":
            continue
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = c + F.lit(0.0).cast(field.dataType)
        parts += [c, c.isNull()] if field.nullable else [c]
    return F.xxhash64(F.lit(0), *parts)


def repeated(df: DataFrame, fingerprint: Callable[[DataFrame], Column] = row_fingerprint) -> DataFrame:
    """The fingerprints (_fp) that more than one row has, stored."""
    return cut_lineage(df.select(fingerprint(df).alias("_fp")).groupBy("_fp").agg(F.count(F.lit(1)).alias("_n"))
                       .where("_n > 1").select("_fp"))


def split_rows(df: DataFrame, fingerprint: Callable[[DataFrame], Column] = row_fingerprint) -> tuple[DataFrame | None, DataFrame | None]:
    """(rows known to be distinct, rows to be compared in full); None where
    there are none of the kind."""
    twice = repeated(df, fingerprint)
    n = twice.count()
    if n == 0:
        return df, None
    if n > BROADCAST_ROWS:
        return None, df
    keyed = df.withColumn("_fp", fingerprint(df))
    return keyed.join(F.broadcast(twice), "_fp", "left_anti").drop("_fp"), keyed.join(F.broadcast(twice), "_fp", "left_semi").drop("_fp")
