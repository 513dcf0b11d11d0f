"""Prefix windows: right sums, every row stored once and shuffled once."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from txrisk.operators import windows

SCHEMA = "transaction_id string, customer_id long, timestamp timestamp_ntz, amount double"
START = dt.datetime(2023, 1, 1)


def _rows(n: int, large: float = 1.0) -> list[tuple]:
    """Half of the rows have no customer; some have no time, no amount or the time of others."""
    return [(f"T{i}", None if i % 2 else i % 14, None if i % 29 == 0 else START + dt.timedelta(minutes=(i - i % 5) * 53 % 60000),
             None if i % 11 == 0 else float("nan") if i % 31 == 0 else (i % 13 - 5.25) * large) for i in range(n)]


def _expected(rows: list[tuple]) -> dict[str, tuple]:
    found = {}
    for name, key, time, _ in rows:
        peers = [(t, a) for _, k, t, a in rows if k == key and (t is None) == (time is None)]
        day, week = ([a for t, a in peers if time is None or dt.timedelta(0) <= time - t <= dt.timedelta(days=d)] for d in (1, 7))
        cents, week = ([int(a * 100) for a in x if a is not None and not math.isnan(a)] for x in (day, week))
        n, total = len(week), sum(week)
        spread = n * sum(x * x for x in week) - total * total
        found[name] = (float(len(day)), float(sum(cents)) / 100.0 if cents else None, float(total) / n / 100.0 if n else None,
                       math.sqrt(float(spread) / float(n * (n - 1))) / 100.0 if n > 1 else 0.0)
    return found


def _got(out) -> dict[str, tuple]:
    return {r.transaction_id: (r.tx_count_24h, r.amount_sum_24h, r.amount_mean_7d, r.amount_std_7d) for r in out.collect()}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(monkeypatch):
    """Row counts of the tables that are stored."""
    counts, cut = [], windows.cut_lineage

    def counted(df):
        table = cut(df)
        counts.append(table.count())
        return table
    monkeypatch.setattr(windows, "cut_lineage", counted)
    return counts


@pytest.mark.parametrize("large", [1.0, 2.0 ** 45])
def test_dense_key_takes_one_shuffle_of_its_rows(spark, stored, large):
    rows = _rows(600, large)
    out = windows.range_window_features_prefix(spark.createDataFrame(rows, SCHEMA).repartition(5), partitions=30)
    assert stored[0] == 600 and sum(stored[1:]) <= 30   # the rows, and the slices of the dense key
    plan = _plan(out)
    assert plan.count("rangepartitioning") == 1 and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    got = _got(out)
    assert len(got) == 600 and got == _expected(rows)


def test_keys_of_few_rows_take_one_shuffle_and_no_join(spark, stored, monkeypatch):
    monkeypatch.setattr(windows, "RANGE_ROWS", 50)
    rows = [(name, None if i % 40 == 0 else i % 97, time, amount) for i, (name, _, time, amount) in enumerate(_rows(900))]
    out = windows.range_window_features_prefix(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert stored == [900]
    plan = _plan(out)
    assert plan.count("Exchange") == 1 and "Join" not in plan
    ranges = 900 // 50   # more than the session's shuffle partitions
    assert f"NULLS FIRST, {ranges})" in plan
    got = _got(out)
    assert len(got) == 900 and got == _expected(rows)


def test_dense_key_is_spread_over_the_session_s_partitions(spark, monkeypatch):
    monkeypatch.setattr(windows, "SHORT_SLICE", 20)
    rows = _rows(400)   # 200 rows without customer; 50 rows a range
    out = windows.range_window_features_prefix(spark.createDataFrame(rows, SCHEMA).repartition(5))
    slices = [r.n for r in out.where("customer_id is null and timestamp is not null").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(slices) >= 3 and max(slices) <= 150
    assert _got(out) == _expected(rows)
