"""Attach global statistics to rows without a join.

A global aggregate returns exactly one row.  Its values are packed into one
struct and read by every row through ONE uncorrelated scalar subquery,
which Spark computes once.  There is no cross join, and no broadcast of a
data-sized side.  Reading the struct as a column keeps it to a single
subquery however many fields are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach(df: DataFrame, one_row: DataFrame, name: str = "_stats") -> tuple[DataFrame, dict[str, Column]]:
    """``df`` plus a struct column ``name`` holding the one-row frame's
    values, and a map from each statistic to its field Column."""
    packed = one_row.select(F.struct(*one_row.columns).alias(name)).scalar()
    return df.withColumn(name, packed), {c: F.col(f"{name}.{c}") for c in one_row.columns}


def beside(df: DataFrame, one_row: DataFrame, name: str = "_stats") -> DataFrame:
    """``df`` plus the struct column ``name`` of a one-row frame whose own plan
    is large: an equi-join of the input partition with one copy per salt, a
    broadcast of as many rows as a shuffle has partitions.  (A subquery would
    be planned once per field that a filter reads.)"""
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies = one_row.select(F.struct(*one_row.columns).alias(name)) \
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dealt = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    return dealt.join(F.broadcast(copies), "_salt").drop("_salt")
