"""Distributed sinks (CSV with header, parquet) and layer materialisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", **options: str) -> str:
    """CSV with a header row and no index column, written by the executors."""
    df.write.mode(mode).options(**options).option("header", True).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> str:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def read_back(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, **options: str) -> DataFrame:
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        return reader.option("header", True).csv(path)
    return reader.parquet(path)


def materialize(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a layer as a parquet table and continue from the written table.

    This is what a declared pipeline table is: the next layer reads the
    stored table, so lineage is cut and lost executors re-read files.
    """
    write_parquet(df, path, partition_by=partition_by)
    return df.sparkSession.read.parquet(path)
