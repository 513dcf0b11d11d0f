"""Steps that must not grow faster than the rows: rounding, totals in the window pass, deduplication, layers stored once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from txrisk.functions.fixedpoint import round_half_up
from txrisk.operators import fingerprint
from txrisk.operators.windows import customer_totals, range_window_features
from txrisk.plans import layers
from txrisk.session import ENGINE_CONF, cut_lineage

SCHEMA = "transaction_id string, customer_id long, timestamp timestamp_ntz, amount double, channel string, location string"


def _rows(n: int) -> list[tuple]:
    start = dt.datetime(2023, 1, 1)
    return [(f"T{i}", None if i % 3 == 0 else i % 17, None if i % 29 == 0 else start + dt.timedelta(minutes=7 * i),
             None if i % 11 == 0 else float("nan") if i % 31 == 0 else i % 13 + 0.25, None if i % 7 == 0 else ["Web", "POS", "Mobile"][i % 3 if i % 2 else 0],
             None if i % 5 == 0 else f"L{i % 4}") for i in range(n)]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_round_half_up_is_spark_round(spark):
    values = [0.0, -0.0, 0.5, -0.5, 1.5, 2.5, -2.5, 0.49999999999999994, 100.49999999999999, 4503599627370495.5, 9007199254740993.0, 1e15 + 0.3,
              -1234567.5, 1.005 * 100, 3226683.4999999995, None, *[i * 0.1 * 100 for i in range(-50, 50)], *[i / 8 for i in range(-40, 40)]]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.select(round_half_up(F.col("x")).cast("long").alias("a"), F.round("x", 0).cast("long").alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got]


@pytest.mark.parametrize("slice_rows", [1 << 15, 20])
def test_totals_of_the_window_pass(spark, slice_rows):
    df = spark.createDataFrame(_rows(600), SCHEMA)
    names = [c for c in customer_totals(df).columns if c != "customer_id"]
    got = range_window_features(df, slice_rows=slice_rows, totals=("channel", "location")) \
        .select("transaction_id", *names).collect()
    totals = customer_totals(df).withColumnRenamed("customer_id", "_c")
    want = df.join(totals, F.col("customer_id").eqNullSafe(F.col("_c"))).select("transaction_id", *names).collect()
    key = {r.transaction_id: r for r in want}
    assert len(got) == len(want) == 600
    for r in got:
        for c in names:
            assert r[c] == (pytest.approx(key[r.transaction_id][c]) if r[c] is not None else None), (r.transaction_id, c)


def test_feature_rows_are_shuffled_once(spark):
    n = spark.createDataFrame(_rows(300), SCHEMA).selectExpr(
        "*", "'m' merchant_category", "'b' bank", "'a' age_group", "0 is_fraud", "null fraud_technique", "0.5D merchant_risk_score")
    rows = layers.feature_rows(cut_lineage(n.withColumn("fraud_technique", F.lit(None).cast("string"))), stored=True)
    plan = _plan(rows)
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_silver_does_not_shuffle_distinct_rows(spark):
    rows = spark.createDataFrame([(f"T{i}", i / 7, None) for i in range(50)], "transaction_id string, amount double, fraud_technique string")
    plain = layers.silver(cut_lineage(rows))
    assert "hashpartitioning" not in _plan(plain) and plain.count() == 50
    twice = layers.silver(cut_lineage(rows.unionByName(rows.where("amount < 3"))))
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, plain.collect()))


def test_silver_finds_repeated_rows_by_base_columns(spark, monkeypatch):
    rows = spark.createDataFrame([("T1", 1.0, 0.1, None), ("T1", 1.0, 0.2, None), ("T1", 1.0, 0.2, None), (None, None, 0.3, "x"), (None, None, 0.3, "x"),
                                  ("T2", 1.0, 0.1, None)], "transaction_id string, amount double, velocity_score double, fraud_technique string")
    read = []
    monkeypatch.setattr(fingerprint, "cut_lineage", lambda df: read.append(df._jdf.queryExecution().optimizedPlan().toString()) or cut_lineage(df))
    got = layers.silver(cut_lineage(rows)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([("T1", 100, 10, "unknown"), ("T1", 100, 20, "unknown"), (None, None, 30, "x"), ("T2", 100, 10, "unknown")], key=str)
    assert len(read) == 1 and "amount" in read[0]
    assert not any("velocity_score" in line for line in read[0].splitlines() if "Relation" not in line)


def test_long_projections_are_compiled():
    assert int(ENGINE_CONF["spark.sql.codegen.hugeMethodLimit"]) <= 8000
