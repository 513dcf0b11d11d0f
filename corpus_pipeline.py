"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir), works on everything that its
predecessor kept, and returns a DataFrame that is written as Parquet and
read again as the next stage's ``docs``.  All but the last return the
columns of ``documents``:

1. quality rules: documents that the production policy rejects go;
2. near duplicates: one document of each class stays;
3. decontamination: documents that contain a benchmark item go;
4. secret scan: secrets in the texts are replaced by a mark;
5. packing: the texts' token pieces in sequences of 2048.

Null and empty texts are rejected by the first stage; empty tables pass
through all stages; further columns are kept until packing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from txrisk.llm import decontaminate, ngram_join, packing, quality_rules, secrets
from txrisk.llm.common import prepare, shared_folder, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return ngram_join.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return secrets.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.digest(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: MinHash, a forest and a tokenizer have no SQL; tests hold the stages
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES, 1):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
