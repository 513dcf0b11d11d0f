"""Cases in which a report once did less than its whole job."""

import pytest

from txrisk.plans import catalog


def test_pivot_keeps_values_outside_the_fixed_columns(spark, monkeypatch):
    df = spark.createDataFrame(
        [("a", "NATION_3", True), ("a", "New Bank", True), ("b", "New Bank", False), ("b", None, True), (None, "Other", True)],
        "merchant_category string, bank string, is_fraud boolean")
    assert catalog.pivot_values(df, "merchant_category", "bank") == [*catalog.PIVOT_VALUES["bank"], "New Bank"]
    monkeypatch.setattr(catalog, "av", lambda *_: df)
    run, _ = catalog.pivot_query("line", "merchant_category", "bank")
    got = {r.merchant_category: r for r in run(spark, "").collect()}
    assert (got["a"]["New Bank"], got["b"]["New Bank"], got["a"]["NATION_3"]) == (100.0, 0.0, 100.0)
    before = spark.conf.get("spark.sql.pivotMaxValues")
    spark.conf.set("spark.sql.pivotMaxValues", "25")
    try:
        with pytest.raises(ValueError, match="pivotMaxValues"):
            catalog.pivot_values(df, "merchant_category", "bank")
    finally:
        spark.conf.set("spark.sql.pivotMaxValues", before)
