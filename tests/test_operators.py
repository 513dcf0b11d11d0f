"""Operators on small fixtures: imputation, dedup, qcut, windows, corr."""

import datetime as dt
import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from txrisk.operators import correlation, distribution, profile, rates
from txrisk.operators.clean import dedup_full_row, fixed_point_encode
from txrisk.operators.impute import impute, impute_median, impute_mode
from txrisk.operators.quantile import add_qcut, add_qcuts
from txrisk.operators.windows import customer_totals, range_window_features


def test_impute_median_and_all_null(spark):
    # fx_nulls: NULLs, an all-NULL column falls back to 0.0
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None), (5.0, None)], "a double, b double")
    got = impute_median(df, ["a", "b"], exact=True).collect()
    assert [r.a for r in got] == [1.0, 3.0, 3.0, 5.0]
    assert [r.b for r in got] == [0.0] * 4


def test_impute_mode_ties_and_nulls(spark):
    # fx_modeties: equal counts -> smallest value; NULL is never the mode
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "c string")
    got = [r.c for r in impute_mode(df, ["c"], fallback="Unknown").collect()]
    assert got.count("a") == 5 and got.count("b") == 2
    empty = spark.createDataFrame([(None,), (None,)], "c string")
    assert {r.c for r in impute_mode(empty, ["c"], fallback="Unknown").collect()} == {"Unknown"}


def test_impute_combined_one_stats_row(spark):
    df = spark.createDataFrame([(1.0, "x"), (None, None), (2.0, "x"), (9.0, "y")], "n double, c string")
    got = impute(df, ["n"], ["c"], exact=True, fallback="Unknown").collect()
    assert [(r.n, r.c) for r in got] == [(1.0, "x"), (2.0, "x"), (2.0, "x"), (9.0, "y")]


def test_dedup_with_nulls(spark):
    # fx_dups: exact duplicates incl. NULLs (NULL = NULL)
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (2, "a"), (2, "b")], "k int, v string")
    assert dedup_full_row(df).count() == 3
    assert profile.duplicate_count(df).first()[0] == 2


def test_repeated_rows_by_fingerprint(spark, monkeypatch):
    """Forged equal fingerprints, NULLs in different places, NaN, -0.0, nested columns, no and too many repeats."""
    from txrisk.operators import fingerprint
    rows = [(1.0, None, 2, [1]), (None, 1.0, 2, [1]), (1.0, None, 2, [1]), (0.0, 1.0, 3, None), (-0.0, 1.0, 3, None),
            (math.nan, 5.0, None, [2]), (math.nan, 5.0, None, [2]), (math.nan, 5.0, None, [3]), (None, None, None, None)]
    df = spark.createDataFrame(rows, "a double, `b.c` double, k int, l array<int>").toDF("a", "b", "k", "l")
    same = lambda frame: F.lit(7).cast("long")
    for way in (fingerprint.row_fingerprint, same):
        assert dedup_full_row(df, way).count() == 6
        assert profile.duplicate_count(df, way).first()[0] == 3
    distinct, rest = fingerprint.split_rows(df)
    assert (distinct.count(), rest.count()) == (2, 7)
    assert fingerprint.split_rows(df.limit(2))[1] is None and profile.duplicate_count(df.limit(2)).first()[0] == 0
    none, two = (dedup_full_row(df.limit(n), fingerprint.row_fingerprint) for n in (0, 2))
    assert none.count() == 0 and two.columns == df.columns
    monkeypatch.setattr(fingerprint, "BROADCAST_ROWS", 1)
    assert fingerprint.split_rows(df)[0] is None
    assert dedup_full_row(df, fingerprint.row_fingerprint).count() == dedup_full_row(df).count() == 6 and profile.duplicate_count(df).first()[0] == 3


def test_encode_skips_booleans_and_excluded(spark):
    df = spark.createDataFrame([("t1", True, 1.234, 3)], "id string, flag boolean, x double, n int")
    out = fixed_point_encode(df, exclude=["id"])
    row = out.first()
    assert (row.id, row.flag, row.x, row.n) == ("t1", True, 123, 300)


def test_qcut_ties_matches_pandas(spark):
    # fx_ties: 50 zeros + 0..49 -> collapsed edges, pandas labels=False
    vals = [0.0] * 50 + [float(i) for i in range(50)]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "x double")
    got = [r.b for r in add_qcut(df, "x", "b", 10, base=0).collect()]
    expected = pd.qcut(pd.Series(vals + [np.nan]), 10, labels=False, duplicates="drop")
    for g, e in zip(got, expected):
        assert (g is None and math.isnan(e)) or g == e


def test_qcut_random_matches_pandas(spark):
    rng = np.random.default_rng(3)
    vals = np.round(rng.lognormal(3, 1, 500), 2).tolist()
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.b for r in add_qcuts(df, [("x", "b", 1)]).collect()]
    expected = pd.qcut(pd.Series(vals), 10, labels=range(1, 11), duplicates="drop").astype(int).tolist()
    assert got == expected


def test_range_windows_inclusive_and_peers(spark):
    # fx_window: t, t+23h59, t+24h exactly, t+24h01, same-instant pair, lone customer
    t = dt.datetime(2023, 3, 5, 12, 0, 0)
    rows = [(1, t, 10.0), (1, t + dt.timedelta(hours=23, minutes=59), 20.0),
            (1, t + dt.timedelta(hours=24), 30.0), (1, t + dt.timedelta(hours=24, minutes=1), 40.0),
            (1, t + dt.timedelta(days=9), 1.0), (1, t + dt.timedelta(days=9), 2.0), (2, t, 5.0)]
    df = spark.createDataFrame(rows, "customer_id int, timestamp timestamp_ntz, amount double")
    out = range_window_features(df).orderBy("customer_id", "timestamp", "amount").collect()
    assert [r.tx_count_24h for r in out] == [1.0, 2.0, 3.0, 3.0, 2.0, 2.0, 1.0]
    assert [r.amount_sum_24h for r in out] == [10.0, 30.0, 60.0, 90.0, 3.0, 3.0, 5.0]
    assert out[3].amount_mean_7d == 25.0
    assert out[6].amount_std_7d == 0.0


def test_range_windows_match_bruteforce_across_buckets(spark):
    # rows straddling 7-day bucket edges: compare against a pandas brute force
    rng = np.random.default_rng(7)
    base = dt.datetime(2023, 1, 1)
    recs = []
    for c in range(3):
        for _ in range(80):
            recs.append((c, base + dt.timedelta(seconds=int(rng.integers(0, 40 * 86400))),
                         float(np.round(rng.uniform(1, 100), 2))))
    df = spark.createDataFrame(recs, "customer_id int, timestamp timestamp_ntz, amount double")
    got = range_window_features(df).toPandas().sort_values(["customer_id", "timestamp", "amount"])
    fine = range_window_features(df, slice_rows=8).toPandas().sort_values(
        ["customer_id", "timestamp", "amount"])
    assert fine.tx_count_24h.tolist() == got.tx_count_24h.tolist()
    assert np.allclose(fine.amount_mean_7d.tolist(), got.amount_mean_7d.tolist())
    pdf = pd.DataFrame(recs, columns=["customer_id", "timestamp", "amount"])
    exp24, exp7 = [], []
    for _, r in pdf.iterrows():
        same = pdf[pdf.customer_id == r.customer_id]
        w24 = same[(same.timestamp <= r.timestamp) & (same.timestamp >= r.timestamp - pd.Timedelta(days=1))]
        w7 = same[(same.timestamp <= r.timestamp) & (same.timestamp >= r.timestamp - pd.Timedelta(days=7))]
        exp24.append(len(w24))
        exp7.append(round(w7.amount.mean(), 6))
    pdf["c24"], pdf["m7"] = exp24, exp7
    pdf = pdf.sort_values(["customer_id", "timestamp", "amount"])
    assert got.tx_count_24h.tolist() == [float(x) for x in pdf.c24]
    assert np.allclose(got.amount_mean_7d.round(6).tolist(), pdf.m7.tolist())


def test_customer_totals(spark):
    df = spark.createDataFrame([(1, 10.0, "Mobile", "Lagos"), (1, 20.0, "POS", "Lagos"), (2, 7.0, "Web", None)],
                               "customer_id int, amount double, channel string, location string")
    got = {r.customer_id: r for r in customer_totals(df).collect()}
    assert got[1].tx_count_total == 2 and got[1].amount_mean_total == 15.0
    assert got[1].channel_diversity == 2 and got[1].location_diversity == 1
    assert got[1].online_channel_ratio == 0.5 and got[2].amount_std_total == 0.0


def test_corr_constant_and_null_pairs(spark):
    # fx_corr: constant column -> NULL; NULL pairs skipped pairwise
    pdf = pd.DataFrame({"y": [0, 1, 0, 1, 1], "c": [5.0] * 5, "x": [1.0, 2.0, None, 4.0, 8.0],
                        "b": [True, False, True, True, False]})
    df = spark.createDataFrame(pdf.astype({"y": "float64"}))
    got = {r.feature: r.correlation for r in correlation.corr_with(df, "y", ["c", "x", "b"]).collect()}
    assert got["c"] is None
    assert math.isclose(got["x"], pdf[["y", "x"]].corr().loc["y", "x"], rel_tol=1e-12)
    assert math.isclose(got["b"], pdf.assign(b=pdf.b.astype(int))[["y", "b"]].corr().loc["y", "b"], rel_tol=1e-12)


def test_rate_by_drops_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), (None, 1), ("b", 0)], "k string, y int")
    got = {r.k: r.fraud_rate for r in rates.rate_by(df, ["k"], value="y").collect()}
    assert got == {"a": 50.0, "b": 0.0}


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(1)
    vals = rng.normal(0, 1, 1000)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = {r.bin: r["count"] for r in distribution.histogram(df, "x", 20).collect()}
    counts, _ = np.histogram(vals, bins=20)
    assert [got.get(i, 0) for i in range(20)] == counts.tolist()


def test_box_stats_matches_numpy(spark):
    rng = np.random.default_rng(2)
    vals = rng.lognormal(0, 1, 400)
    df = spark.createDataFrame([(0, float(v)) for v in vals], "is_fraud int, x double")
    r = distribution.box_stats(df, "x").first()
    q1, q3 = np.percentile(vals, [25, 75])
    assert math.isclose(r.q1, q1) and math.isclose(r.q3, q3)
    hi = q3 + 1.5 * (q3 - q1)
    assert math.isclose(r.whisker_high, vals[vals <= hi].max())
    assert r.n_outliers == int(((vals < q1 - 1.5 * (q3 - q1)) | (vals > hi)).sum())


def test_kde_matches_numpy(spark):
    rng = np.random.default_rng(5)
    vals = np.round(rng.gamma(2, 2, 300), 2)
    df = spark.createDataFrame([(1, float(v)) for v in vals], "is_fraud int, x double")
    out = distribution.kde(df, "x", points=9).orderBy("point").collect()
    h = 1.06 * vals.std(ddof=1) * len(vals) ** -0.2
    grid = np.linspace(vals.min(), vals.max(), 9)
    dens = [np.exp(-0.5 * ((g - vals) / h) ** 2).sum() / (len(vals) * h * math.sqrt(2 * math.pi)) for g in grid]
    assert np.allclose([r.density for r in out], dens)


def test_kde_of_far_values_and_of_one_value(spark):
    """Grid points that no value is near to have density 0; a group of one value keeps its grid."""
    rows = [(1, 0.001 * i) for i in range(200)] + [(1, 1e6), (0, 5.0), (0, 5.0), (None, 3.0), (1, None), (1, math.nan)]
    df = spark.createDataFrame(rows, "is_fraud int, x double")
    out = distribution.kde(df, "x", points=64).collect()
    assert [(r.is_fraud, r.point) for r in out] == [(g, i) for g in (0, 1) for i in range(64)]
    for g in (0, 1):
        vals = np.array([x for k, x in rows if k == g and x is not None and x == x])
        h = 1.06 * vals.std(ddof=1) * len(vals) ** -0.2 or 1.0
        grid = np.linspace(vals.min(), vals.max(), 64)
        dens = [np.exp(-0.5 * ((p - vals) / h) ** 2).sum() / (len(vals) * h * math.sqrt(2 * math.pi)) for p in grid]
        assert np.allclose([r.density for r in out if r.is_fraud == g], dens, rtol=1e-9, atol=1e-15)


def test_sample_size(spark):
    df = spark.range(100)
    assert distribution.sample_rows(df, 10).count() == 10
    assert distribution.sample_rows(df, 1000).count() == 100


def test_describe_matches_pandas(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 3.0, 4.0, 10.0], "b": [0.5, None, 0.25, 1.0, 2.0]})
    df = spark.createDataFrame(pdf)
    got = {r.column: r for r in profile.describe(df).collect()}
    exp = pdf.describe().T
    for c in ["a", "b"]:
        for s, e in [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"),
                     ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
            assert math.isclose(got[c][s], exp.loc[c, e])


def test_null_counts_and_shape(spark):
    df = spark.createDataFrame([(1, None, float("nan")), (None, "x", 1.0)], "a int, b string, c double")
    got = {r.column: r.null_count for r in profile.null_counts(df).collect()}
    assert got == {"a": 1, "b": 1, "c": 1}
    assert profile.null_total(df).first()[0] == 3
    assert tuple(profile.table_shape(df).first()) == (2, 3)


def test_label_counts_share(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "is_fraud int")
    got = {r.is_fraud: (r["count"], r.percent) for r in rates.label_counts(df).collect()}
    assert got == {0: (3, 75.0), 1: (1, 25.0)}


def test_pivot_fill_zero(spark):
    df = spark.createDataFrame([("m1", "A", 1), ("m1", "B", 0), ("m2", "A", 0)], "m string, b string, is_fraud int")
    got = {r.m: (r.A, r.B) for r in rates.pivot_rate(df, "m", "b").collect()}
    assert got == {"m1": (100.0, 0.0), "m2": (0.0, 0.0)}


def test_corr_matrix_paths_match_pandas(spark):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"a": rng.normal(size=200), "b": rng.normal(size=200), "k": [0.1] * 200})
    pdf["c"] = pdf.a * 0.5 + rng.normal(size=200) * 0.1
    exp = pdf.corr()
    fast = {(r.col1, r.col2): r.corr for r in correlation.corr_matrix(spark.createDataFrame(pdf)).collect()}
    with_null = pdf.copy()
    with_null.loc[3, "b"] = np.nan
    exp_n = with_null.corr()
    slow = {(r.col1, r.col2): r.corr for r in correlation.corr_matrix(spark.createDataFrame(with_null)).collect()}
    for got, e in [(fast, exp), (slow, exp_n)]:
        assert len(got) == 16
        for (x, y), v in got.items():
            if math.isnan(e.loc[x, y]):
                assert v is None
            else:
                assert math.isclose(v, e.loc[x, y], rel_tol=1e-9, abs_tol=1e-12)


def test_exact_quantiles_edges(spark):
    from txrisk.operators.quantile import exact_quantiles
    rows = [(1, 5.0, None), (2, 1.0, None), (2, 1.0, None), (2, 1.0, None), (2, 9.0, None), (2, float("nan"), None)]
    df = spark.createDataFrame(rows, "g int, x double, y double")
    got = {(r.g, r.column, r.p): r.value for r in exact_quantiles(df, ["x", "y"], [0.0, 0.5, 0.9, 1.0], by=["g"]).collect()}
    # single row group: every quantile is that value
    assert all(got[(1, "x", p)] == 5.0 for p in (0.0, 0.5, 0.9, 1.0))
    # hot duplicate value and NaN ignored: [1, 1, 1, 9]
    vals = np.array([1.0, 1.0, 1.0, 9.0])
    for p in (0.0, 0.5, 0.9, 1.0):
        assert math.isclose(got[(2, "x", p)], np.quantile(vals, p))
    # an all-NULL column yields no rows
    assert not any(k[1] == "y" for k in got)


@pytest.mark.parametrize("discrete", [False, True])
def test_bracketed_quantiles_beyond_a_whole_column(spark, monkeypatch, discrete):
    """Columns that are larger than their bracket: spread, tied and skewed values."""
    from txrisk.operators import quantile
    monkeypatch.setattr(quantile, "WHOLE", 50)
    rng = np.random.default_rng(5)
    n = 8000
    data = {"x": rng.normal(size=n), "y": np.round(rng.exponential(size=n), 1), "z": (rng.random(n) < 0.3) * 1.0,
            "w": np.where(rng.random(n) < 0.4, 7.0, rng.integers(0, 50, n))}
    frame = pd.DataFrame(data | {"g": rng.integers(0, 2, n)})
    df = spark.createDataFrame(frame).repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]
    how = "inverted_cdf" if discrete else "linear"
    for accuracy, buffer, step in ((100, 8192, 16), (10_000, 700, 16), (10_000, 100, 50), (1000, 8192, 1)):
        monkeypatch.setattr(quantile, "BUFFER_ROWS", buffer)
        monkeypatch.setattr(quantile, "STEP", step)
        got = {(r.column, r.p): r.value for r in quantile.exact_quantiles(df, list(data), probs, discrete=discrete, accuracy=accuracy).collect()}
        assert got == {(c, p): pytest.approx(np.quantile(v, p, method=how), abs=1e-12) for c, v in data.items() for p in probs}
    got = {(r.g, r.p): r.value for r in quantile.exact_quantiles(df, ["x"], probs, by=["g"], discrete=discrete, accuracy=200).collect()}
    assert got == {(g, p): pytest.approx(np.quantile(frame[frame.g == g].x, p, method=how), abs=1e-12) for g in (0, 1) for p in probs}


def test_rank_outside_its_bracket_is_an_error(spark, monkeypatch):
    from txrisk.operators import quantile
    monkeypatch.setattr(quantile, "WHOLE", 5)
    monkeypatch.setattr(quantile, "MARGINS", (0.3,))
    monkeypatch.setattr(quantile, "_summaries", lambda *_: {0: {   # brackets that lie beside the rank
        "n": 1000, "least": 0.0, "most": 999.0, "buffers": 0, "at": {0.2: 700.0, 0.8: 900.0}}})
    df = spark.range(1000).selectExpr("CAST(id AS DOUBLE) AS x")
    with pytest.raises(Exception, match="bracket"):
        quantile.exact_quantiles(df, ["x"], [0.5]).collect()


def test_prefix_window_matches_bruteforce_dense_key(spark):
    from txrisk.operators.windows import range_window_features_prefix
    rng = np.random.default_rng(9)
    base = dt.datetime(2023, 1, 1)
    recs = [(0, base + dt.timedelta(seconds=int(rng.integers(0, 3 * 86400))), float(np.round(rng.uniform(1, 50), 2)))
            for _ in range(400)]
    recs += [(1, base, 3.0), (1, base, 4.0), (1, base + dt.timedelta(days=1), 5.0)]  # peers + exact 24h edge
    df = spark.createDataFrame(recs, "customer_id int, timestamp timestamp_ntz, amount double")
    got = range_window_features_prefix(df, partitions=12).toPandas()
    pdf = pd.DataFrame(recs, columns=["customer_id", "timestamp", "amount"])
    for _, r in got.sample(60, random_state=1).iterrows():
        same = pdf[pdf.customer_id == r.customer_id]
        w24 = same[(same.timestamp <= r.timestamp) & (same.timestamp >= r.timestamp - pd.Timedelta(days=1))]
        w7 = same[(same.timestamp <= r.timestamp) & (same.timestamp >= r.timestamp - pd.Timedelta(days=7))]
        assert r.tx_count_24h == len(w24)
        assert math.isclose(r.amount_sum_24h, round(w24.amount.sum(), 2), abs_tol=1e-9)
        assert math.isclose(r.amount_mean_7d, w7.amount.mean(), rel_tol=1e-12)
        exp_std = w7.amount.std(ddof=1) if len(w7) > 1 else 0.0
        assert math.isclose(r.amount_std_7d, exp_std, rel_tol=1e-9, abs_tol=1e-9)
    edge = got[got.customer_id == 1].sort_values(["timestamp", "amount"])
    assert edge.tx_count_24h.tolist() == [2.0, 2.0, 3.0]


def test_exact_discrete_median_matches_percentile_disc(spark):
    from txrisk.operators.impute import median_stats
    rng = np.random.default_rng(4)
    vals = [float(v) for v in rng.integers(0, 50, 301)] + [None] * 5
    df = spark.createDataFrame([(v, v) for v in vals] + [(1.0, 2.0)], "a double, b double")
    got = median_stats(df, ["a", "b"], exact=True).first()
    exp = df.selectExpr("percentile_disc(0.5) WITHIN GROUP (ORDER BY a) AS a",
                        "percentile_disc(0.5) WITHIN GROUP (ORDER BY b) AS b").first()
    assert (got["_med_a"], got["_med_b"]) == (exp.a, exp.b)


def test_describe_datetime_matches_pandas(spark):
    ts = pd.to_datetime(["2024-01-01 00:00:00", "2024-01-01 06:00:00.000003", "2024-01-02 00:00:00",
                         "2024-01-05 12:30:00", None], format="ISO8601")
    df = spark.createDataFrame(pd.DataFrame({"t": ts}).astype({"t": "datetime64[us]"}), "t timestamp_ntz")
    r = profile.describe_datetime(df, ["t"]).first()
    exp = pd.Series(ts).describe()
    assert r["count"] == exp["count"]
    for k, e in [("min", "min"), ("max", "max"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("mean", "mean")]:
        # floored to the microsecond; pandas interpolates in nanoseconds
        assert abs(pd.Timestamp(r[k]) - exp[e]) < pd.Timedelta(microseconds=1), (k, r[k], exp[e])


def _null_rows(spark):
    import datetime as dt
    t0 = dt.datetime(2023, 5, 1)
    rows = [("a", 0, 1.0), ("a", 1, None), ("a", 30, 3.0), ("a", 30, 5.0), ("a", 24 * 6, float("nan")), (None, 2, 7.0),
            (None, 3, None), ("b", 5, None), ("b", 24 * 9, 2.5), ("a", 24 * 7, 4.0), ("a", 24 * 7 + 1, 9.0)]
    return spark.createDataFrame([(c, t0 + dt.timedelta(hours=h), x) for c, h, x in rows],
                                 "customer_id string, timestamp timestamp_ntz, amount double")


def test_windows_with_null_keys_and_amounts(spark):
    import math
    import statistics
    from txrisk.operators.windows import DAY_US, WEEK_US, range_window_features, range_window_features_prefix
    df = _null_rows(spark)
    src = [(r.customer_id, r.timestamp, r.amount) for r in df.collect()]

    def ok(x):
        return x is not None and not math.isnan(x)

    def frame(c, t, us):
        return [x for k, s, x in src if k == c and 0 <= (t - s).total_seconds() * 1e6 <= us]

    for method in (range_window_features, range_window_features_prefix):
        out = method(df).collect()
        assert len(out) == len(src)
        for r in out:
            day, week = frame(r.customer_id, r.timestamp, DAY_US), [x for x in frame(r.customer_id, r.timestamp, WEEK_US) if ok(x)]
            assert r.tx_count_24h == len(day)
            seen = [x for x in day if ok(x)]
            assert r.amount_sum_24h == (sum(seen) if seen else None)
            assert r.amount_mean_7d == (pytest.approx(sum(week) / len(week)) if week else None)
            assert r.amount_std_7d == pytest.approx(statistics.stdev(week) if len(week) > 1 else 0.0)


def test_features_keep_rows_without_customer(spark):
    from txrisk.plans import layers
    df = _null_rows(spark).selectExpr(
        "'t' AS transaction_id", "customer_id", "timestamp", "amount", "'Web' AS channel", "'m' AS merchant_category",
        "'k' AS bank", "'l' AS location", "'g' AS age_group", "0 AS is_fraud", "CAST(NULL AS STRING) AS fraud_technique",
        "0.5D AS merchant_risk_score")
    out = layers.features(df).collect()
    assert len(out) == df.count()
    means = {r.customer_id: r.amount_mean_total for r in out}
    assert means == {"a": pytest.approx(22 / 5), None: 7.0, "b": 2.5}
    assert {r.online_channel_ratio for r in out} == {1.0}


def test_dense_key_is_cut_into_even_tasks(spark):
    """A customer with a third of all rows: same features, no large task."""
    from txrisk.operators import windows
    rng = np.random.default_rng(3)
    base = dt.datetime(2023, 1, 1)
    n = 6000
    keys = np.where(rng.random(n) < 0.34, "hot", np.char.add("c", rng.integers(0, 400, n).astype(str)))
    seconds = rng.integers(0, 30 * 86400, n)
    seconds[::50] = 86400 * 9                                   # peers of one instant
    recs = [(None if k == "c7" else str(k), base + dt.timedelta(seconds=int(t)), None if t % 97 == 0 else float(t % 1000) / 4)
            for k, t in zip(keys, seconds, strict=True)]
    recs += [("hot", None, 2.5), ("hot", None, 1.0), ("hot", base, 1e11), ("hot", base, -1e11)]   # no time, wide squares
    df = spark.createDataFrame(recs, "customer_id string, timestamp timestamp_ntz, amount double").repartition(6)
    order = ["customer_id", "timestamp", "amount", "tx_count_24h"]

    def rows(out):
        return sorted(out.collect(), key=lambda r: str([r[c] for c in order]))
    whole, cut = rows(windows.range_window_features(df)), rows(windows.range_window_features(df, slice_rows=100))
    assert whole == cut and len(cut) == len(recs)
    prefix = rows(windows.range_window_features_prefix(df.where("timestamp is not null")))
    timed = [r for r in cut if r.timestamp is not None]
    assert [r[:6] for r in prefix] == [r[:6] for r in timed]
    assert np.allclose([r.amount_std_7d for r in prefix], [r.amount_std_7d for r in timed], rtol=1e-12)
    assert {(r.tx_count_24h, r.amount_sum_24h) for r in cut if r.timestamp is None} == {(2.0, 3.5)}
    marked = df.select(F.col("customer_id").alias("_key"), windows.epoch_micros(F.col("timestamp")).alias("_t"))
    slices = windows.dense_slices(marked, 100)
    assert [r["_dense"] for r in slices.select("_dense").collect()] == ["hot"]
    parts = marked.join(slices, F.col("_key") == F.col("_dense")).groupBy(windows._slice(F.col("_t")).alias("p")).count()
    sizes = [r["count"] for r in parts.where("p > 0").collect()]
    assert max(sizes) <= 3 * 100 and len(sizes) >= 15


def test_sample_is_deterministic(spark):
    from txrisk.operators.distribution import sample_rows
    df = spark.range(5000).selectExpr("id", "id % 7 AS g")
    one = {r.id for r in sample_rows(df.repartition(2), 300).collect()}
    two = {r.id for r in sample_rows(df.repartition(16), 300).collect()}
    assert one == two and len(one) == 300
    assert sample_rows(df, 9000).count() == 5000


def test_sample_sorts_only_rows_up_to_its_last_hash(spark):
    """Also under projections, below which the limit does not stay with the sort."""
    from txrisk.operators.distribution import sample_rows
    df = spark.range(20000).selectExpr("id", "id % 7 AS g", "cast(id AS string) AS t")
    some = sample_rows(df, 50).withColumn("x", F.concat("t", "t")).withColumn("y", F.concat("x", "x", "x"))
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan[plan.index("Sort ["):]
    rows = sorted(range(20000), key=lambda i: hashlib.md5(f"42/{i}".encode()).hexdigest())[:50]
    assert [r.id for r in some.collect()] == rows
    assert sample_rows(df, 0).count() == 0 and sample_rows(df.limit(0), 5).count() == 0


def test_sample_of_tied_and_null_keys(spark):
    from txrisk.operators.distribution import sample_rows
    df = spark.createDataFrame([(None, 3), ("a", 2), ("a", 1), ("a", 0), (None, None)], "k string, v int")
    order = sorted([(None, None), (None, 3), ("a", 0), ("a", 1), ("a", 2)],
                   key=lambda r: (hashlib.md5(f"42/{r[0] or ''}".encode()).hexdigest(), -1 if r[1] is None else r[1]))
    for n in range(6):
        assert [tuple(r) for r in sample_rows(df, n).collect()] == order[:n]


def test_pivot_width_is_bounded(spark):
    from pyspark.errors import AnalysisException
    from txrisk.operators.rates import pivot_rate
    df = spark.range(20).selectExpr("'r' AS a", "CAST(id AS STRING) AS b", "1 AS is_fraud")
    spark.conf.set("spark.sql.pivotMaxValues", "5")
    try:
        with pytest.raises(AnalysisException):
            pivot_rate(df, "a", "b").collect()
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")
