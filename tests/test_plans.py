"""Physical-plan properties the scale design relies on."""

import datetime as dt

from pyspark.sql import functions as F

from txrisk.operators import rates
from txrisk.operators.windows import range_window_features
from txrisk.plans import layers


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_shuffles_on_customer_and_slice(spark):
    rows = [(c, dt.datetime(2023, 1, 1) + dt.timedelta(hours=i), float(i)) for c in range(3) for i in range(20)]
    df = spark.createDataFrame(rows, "customer_id int, timestamp timestamp_ntz, amount double")
    # an upstream customer-only partitioning must not be reused; no row is added per frame
    p = plan(range_window_features(df.repartition("customer_id")))
    assert p.count("hashpartitioning(_key") == 1 and "_part" in p.split("hashpartitioning(_key")[1][:40]
    assert "Generate" not in p and "Window" not in p
    assert "Generate" in plan(range_window_features(df, slice_rows=5))


def test_report_scan_is_pruned_and_filtered(spark, tmp_path):
    df = spark.createDataFrame([("Mobile", 1.0, "x", 3)] * 4, "channel string, is_fraud double, other string, n int")
    path = str(tmp_path / "t")
    df.write.parquet(path)
    p = plan(rates.rate_by(spark.read.parquet(path), ["channel"]))
    assert "ReadSchema: struct<channel:string,is_fraud:double>" in p or \
        "ReadSchema: struct<is_fraud:double,channel:string>" in p
    assert "IsNotNull(channel)" in p


def test_gold_statistics_use_bounded_sketch(spark):
    # nullable inputs, so the imputation cannot be folded away
    vals = {c: F.when(F.col("id") > 3, F.col("id") * 100).alias(c)
            for c in ["amount", "composite_risk", "hour", "is_fraud"]}
    base = spark.range(10).select(F.col("id").cast("string").alias("transaction_id"),
                                  F.when(F.col("id") > 2, F.lit("Lagos")).alias("location"), *vals.values())
    gold = layers.gold(base, numeric=list(vals), categorical=["location"])
    p = gold._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile_approx(" in p
    assert "percentile(" not in p.replace("percentile_approx(", "")
    assert gold.where(F.col("amount").isNull()).count() == 0


def test_statistics_attach_without_cross_join(spark):
    from txrisk.operators import distribution
    vals = {c: F.when(F.col("id") > 3, F.col("id") * 100).alias(c)
            for c in ["amount", "composite_risk", "hour", "is_fraud"]}
    base = spark.range(50).select(F.col("id").cast("string").alias("transaction_id"),
                                  F.when(F.col("id") > 2, F.lit("Lagos")).alias("location"), *vals.values())
    for df in [layers.gold(base, numeric=list(vals), categorical=["location"]),
               distribution.histogram(base, "amount", 5, "is_fraud"),
               rates.label_counts(base)]:
        p = plan(df)
        assert "NestedLoopJoin" not in p and "CartesianProduct" not in p
        df.collect()


def test_decile_edges_are_one_subquery(spark):
    from txrisk.operators.quantile import add_qcuts
    df = spark.range(200).select((F.col("id") * 1.5).alias("a"), (F.col("id") % 17).cast("double").alias("b"))
    out = add_qcuts(df, [("a", "a_bin", 1), ("b", "b_bin", 0)])
    p = plan(out)
    # 2 x 11 edges, each read several times: a constant number of subquery
    # nodes (the struct), not one per use of an edge
    assert p.count("Subquery subquery") <= 2
    assert "NestedLoopJoin" not in p
    assert out.where(F.col("a_bin").isNull()).count() == 0


def test_no_rows_are_dealt_by_label_or_column_name_alone(spark, tmp_path):
    from txrisk.operators import distribution
    from txrisk.operators.quantile import exact_quantiles
    path = str(tmp_path / "t")
    spark.range(2000).select((F.col("id") % 2).cast("int").alias("is_fraud"), (F.col("id") * 1.5).alias("x")).write.parquet(path)
    df = spark.read.parquet(path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for out in [distribution.box_stats(df, "x"), distribution.box_outliers(df, "x"), distribution.kde(df, "x")]:
            joins = [x for x in plan(out).split("Join")[1:] if "_salt" in x.split("\n")[0]]
            assert joins, plan(out)
        quantiles = exact_quantiles(df, ["x"], [0.5])
        assert "rangepartitioning" not in plan(quantiles)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_corr_matrix_runs_no_job_before_its_action(spark):
    from txrisk.operators import correlation
    df = spark.range(50).select((F.col("id") * 1.5).alias("a"), F.raise_error(F.lit("ran")).cast("double").alias("b"))
    correlation.corr_matrix(df, ["a", "b"])


def test_raw_table_by_name_and_path(spark, tmp_path):
    import pytest

    from txrisk.schema import SOURCE_COLUMNS
    from txrisk.sources import raw_transactions
    df = spark.range(3).select(*[F.col("id").cast("string").alias(c) for c in SOURCE_COLUMNS],
                               F.lit("{}").alias("_rescued_data"), F.lit(1).alias("other"))
    df.createOrReplaceTempView("raw_fixture")
    df.drop("_rescued_data").write.parquet(str(tmp_path / "raw"))
    assert raw_transactions(spark, "raw_fixture").columns == [*SOURCE_COLUMNS, "_rescued_data"]
    assert raw_transactions(spark, str(tmp_path / "raw")).columns == SOURCE_COLUMNS
    assert "_rescued_data" not in layers.silver(raw_transactions(spark, "raw_fixture")).columns
    df.drop("amount").createOrReplaceTempView("raw_fixture")
    with pytest.raises(ValueError, match="amount"):
        raw_transactions(spark, "raw_fixture")
