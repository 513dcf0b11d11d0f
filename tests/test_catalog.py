"""Catalogue-level checks on the driver tables (sf0.001).

Mirrors the driver: Spark result vs the DuckDB oracle (row count, column
names, order-insensitive value hash) for a representative subset, plus
invariants of the reports.
"""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tools.check_oracle import TABLES, row_hash

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

DUCK_TYPE = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
             "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}

SUBSET = [
    "rate_by_channel", "silver_event", "gold_event", "impute_mode", "label_counts", "describe",
    "velocity_decile_event", "hist_amount_by_label", "box_amount", "pivot_merchant_bank",
    "corr_with_label", "tx_count_24h", "dedup_full_row", "duplicate_count", "null_counts",
    "kde_velocity_by_label", "rate_by_month_bank", "distinct_values", "amount_quality", "box_velocity",
    "window_features_prefix", "pivot_location_merchant", "pivot_month_bank", "features", "pairplot_points", "rug_velocity",
    "bronze_scan", "silver_rescued", "features_nulls", "silver_nulls", "gold_nulls", "window_nulls", "window_nulls_prefix",
    "corr_matrix", "online_ratio", "rate_time_bucket_by_bank", "box_outliers_amount",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()


def test_every_query_has_oracle_or_is_a_sample():
    qs, sqls = E.queries(), E.oracle_sql()
    assert len(qs) >= 100
    assert all(k == "pipeline" or k.startswith("op") for k in set(qs) - set(sqls))
    assert "describe_datetime" in sqls and "window_features_prefix" in sqls


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["channel", "fraud_rate"]


@pytest.mark.parametrize("key", SUBSET)
def test_matches_oracle(spark, duck, key):
    sdf = E.queries()[key](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(E.oracle_sql()[key])
    dcols = [c[0] for c in res.description]
    drows = [tuple(r) for r in res.fetchall()]
    assert sorted(sdf.columns) == sorted(dcols)
    spark_types = {f.name: DUCK_TYPE.get(f.dataType.simpleString()) for f in sdf.schema.fields}
    assert spark_types == {c: str(t) for c, t in zip(dcols, duck.sql(E.oracle_sql()[key]).types)}
    assert len(srows) == len(drows)
    assert row_hash(srows, sdf.columns) == row_hash(drows, dcols)


def test_invariants(spark):
    q = E.queries()
    rates = q["rate_by_bank"](spark, SF).collect()
    assert all(0.0 <= r.fraud_rate <= 100.0 for r in rates)
    hist = q["hist_amount_log"](spark, SF).agg(F.sum("count")).first()[0]
    av = q["analysis_view"](spark, SF)
    assert hist == av.where(F.col("amount_log").isNotNull()).count()
    feats = q["features"](spark, SF)
    assert feats.where(F.col("tx_count_24h") < 1).count() == 0
    assert feats.where(F.col("tx_count_24h") > F.col("tx_count_total")).count() == 0
    from txrisk.functions.fixedpoint import decode, encode
    from txrisk.sources.testdata import txn_line
    rt = txn_line(spark, SF).select(F.col("amount"), decode(encode(F.col("amount"))).alias("rt"))
    assert rt.where(F.col("rt") != F.round("amount", 2)).count() == 0
    assert q["scatter_sample"](spark, SF).count() == min(10000, av.count())


def test_every_branch_occurs_in_the_data(spark):
    """The labels are stated here, not taken from the package."""
    q = E.queries()

    def values(key, column):
        return {r[0] for r in q[key](spark, SF).select(column).distinct().collect()}

    assert values("analysis_view", "amount_category") == {"Small", "Medium", "Large", "Very Large"}
    assert values("analysis_view", "time_bucket") == {
        "Midnight (00:00–04:59)", "Early Morning (05:00–07:59)", "Morning (08:00–11:59)", "Midday (12:00–14:59)",
        "Afternoon (15:00–17:59)", "Evening (18:00–20:59)", "Night (21:00–23:59)"}
    assert values("analysis_view", "month_category") == {
        "Beginning (1st–10th)", "Mid Month (11th–20th)", "Month End (21st–31st)"}
    assert values("analysis_view", "season") == {"Dry Season", "Rainy Season"}
    assert values("analysis_view", "DayClassification") == {"Weekday", "Weekend"}
    assert values("gold", "transaction_hour_category") == {"Morning", "Afternoon", "Evening", "Night"}
    assert values("gold", "amount_rounded") == {0.0, 1.0}
    assert len(values("online_ratio", "online_channel_ratio")) > 1
    nulls, filled = q["silver_nulls"](spark, SF), q["gold_nulls"](spark, SF)
    for c in ["amount", "bank", "location", "merchant_category", "age_group"]:
        assert nulls.where(F.col(c).isNull()).count() > 0
        assert filled.where(F.col(c).isNull()).count() == 0
    assert {r[0] for r in filled.select("age_group").distinct().collect()} == {"Unknown"}
    rows = E.catalog.base(spark, SF, "gaps")
    assert rows.where(F.isnan("amount")).count() > 0 and rows.where("customer_id is null").count() > 0
    assert q["features_nulls"](spark, SF).count() == rows.count()


def test_stored_layers_follow_their_source(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet").toPandas()
    (tmp_path / "sf").mkdir()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(tmp_path / "sf" / f"{name}.parquet"))

    def rows_of(part):
        part.to_parquet(tmp_path / "sf" / "events.parquet", coerce_timestamps="us")
        return E.queries()["features"](spark, str(tmp_path / "sf")).count()

    assert rows_of(events) == len(events) > 10
    assert rows_of(events.head(10)) == 10
