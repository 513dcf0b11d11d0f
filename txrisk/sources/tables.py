"""The raw transaction table: a named table or a path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txrisk.schema import RESCUED_DATA, SOURCE_COLUMNS


def raw_transactions(spark: SparkSession, source: str) -> DataFrame:
    """The 38 dictionary columns, and the rescue column where the table has it.

    ``source`` with a slash is a Parquet path, otherwise the name of a table.
    Columns pass as they are stored (a timestamp may be text); further
    columns are not read, and a missing one is an error.
    """
    df = spark.read.parquet(source) if "/" in source else spark.read.table(source)
    missing = [c for c in SOURCE_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"{source} has no column {', '.join(missing)}")
    return df.select(*SOURCE_COLUMNS, *[c for c in [RESCUED_DATA] if c in df.columns])
