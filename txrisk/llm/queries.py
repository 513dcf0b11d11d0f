"""Registered queries of the operators: name -> (spark, sf_dir) -> DataFrame.

Each query applies its operator, with production parameters, to the whole
table and returns its full result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txrisk.llm import (
    alignment, debruijn, decontaminate, licenses, neighbours, ngram_join, oracles, packing, prefix_trie, quality_rules,
    secrets, suffix_dedup, topk, warc,
)
from txrisk.llm.common import prepare, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(table(spark, sf_dir, "documents"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.digest(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op4_neighbour_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.digest(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digest(table(spark, sf_dir, "documents"))


def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.digest(table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.digest(table(spark, sf_dir, "conversations"))


def _prepared(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(prepare(spark), sf_dir)
    return run


def queries() -> dict[str, Query]:
    every = (op1_license_scan, op2_ngram_join, op3_warc, op4_neighbour_quality, op5_quality_rules, op6_suffix_dedup,
             op7_best_fit_packing, op8_decontamination, op9_substring_dedup, op10_secret_scan,
             op11_token_alignment, op12_exact_topk, op13_prefix_trie)
    return {f.__name__: _prepared(f) for f in every}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    return {"op1_license_scan": oracles.license_sql(), "op3_warc": oracles.WARC, "op5_quality_rules": oracles.QUALITY,
            "op6_suffix_dedup": oracles.BYTES, "op9_substring_dedup": oracles.SUBSTRINGS,
            "op12_exact_topk": topk.SQL, "op13_prefix_trie": prefix_trie.SQL}
