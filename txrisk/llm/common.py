"""Session settings, shared scratch folder and lineage cuts of the operators.

A checkpoint always goes to the folder that the session names in
``spark.checkpoint.dir``; a folder of our own is made only for a local
session that names none (tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch sent to a Python worker: very long texts may come
#: together, so a batch is kept to a thousand documents.
BATCH_ROWS = 1000

#: Characters of ASCII white space, as the contracts of the operators write it.
SPACE = r"[\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings the operators need (idempotent)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and all executors see."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="llm-shared-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row (a lambda variable)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_of(column: str = "text") -> Column:
    """The text, empty where null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def stored(df: DataFrame, **options: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
