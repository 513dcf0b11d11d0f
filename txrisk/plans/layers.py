"""Whole-layer plans: features -> silver -> gold -> analysis view.

Each layer is a lazy ``DataFrame -> DataFrame`` function; Catalyst sees the
full chain (column pruning reaches the parquet scans of the adapters).
The only eager step is the optional stored table inside :func:`features`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.functions import bins, calendar
from txrisk.functions.fixedpoint import nan_to_null
from txrisk.functions.numeric import amount_log, amount_rounded, cyclic, velocity_score
from txrisk.operators.clean import (
    audit_columns, dedup_full_row, drop_columns, fill_null_constant, fixed_point_decode,
    fixed_point_encode, reorder_columns,
)
from txrisk.operators.fingerprint import row_fingerprint
from txrisk.operators.impute import impute
from txrisk.operators.stats import attach
from txrisk.operators.windows import customer_totals, range_window_features, range_window_features_prefix
from txrisk.schema import (
    ANALYSIS_DROP_FIRST, ANALYSIS_DROP_SECOND, COMPOSITE_WEIGHTS, DATA_QUALITY_SCORE,
    FRAUD_TECHNIQUE_FILL, GOLD_CATEGORICAL, MEDIAN_RELATIVE_ERROR, GOLD_LEADING, GOLD_NUMERIC, HIGH_FREQUENCY_COUNT,
    MODE_FALLBACK, RESCUED_DATA, SILVER_UNSCALED, SOURCE_COLUMNS,
)
from txrisk.session import cut_lineage

BASE_COLUMNS = [
    "transaction_id", "customer_id", "timestamp", "amount", "channel", "merchant_category",
    "bank", "location", "age_group", "is_fraud", "fraud_technique", "merchant_risk_score",
]


def _minmax_norm(x: str, stat: dict) -> F.Column:
    lo, hi = stat[f"_min_{x}"], stat[f"_max_{x}"]
    return F.when(hi > lo, (F.col(x) - lo) / (hi - lo)).otherwise(F.lit(0.0))


def features(base: DataFrame, checkpoint: bool = True, window_method: str = "bucket", stored: bool = False) -> DataFrame:
    """Raw transactions (38 dictionary columns) from base transaction rows.

    Calendar ints, cyclic encodings, log/round flags, RANGE-window
    velocity features, per-customer totals, velocity and composite risk
    (min-max normalised over the input).  NaN in the double columns counts
    as NULL.  The row set after windows and totals feeds both the
    global min/max and the rows, so it is stored once as a Parquet table
    (``checkpoint=False`` leaves it lazy); so are the base rows, unless they
    are a ``stored`` table already.
    ``window_method``: 'bucket' (windows and totals in one pass after one
    shuffle) or 'prefix' (prefix sums over a range-partitioned sort: any key
    density, several more shuffles).
    """
    rows = feature_rows(base, window_method, stored)
    return scored(cut_lineage(rows) if checkpoint else rows)


def feature_rows(base: DataFrame, window_method: str = "bucket", stored: bool = False) -> DataFrame:
    """Base rows with all that the global minima and maxima are not needed for."""
    ts = F.col("timestamp")
    base = base.select(*[nan_to_null(F.col(c)).alias(c) if t in ("double", "float") else F.col(c)
                         for c, t in base.dtypes])
    if window_method == "prefix":
        windowed = range_window_features_prefix(base.select(*BASE_COLUMNS))
        totals = customer_totals(base.select("customer_id", "amount", "channel", "location"))
        # null-safe: rows without a customer are a group of their own
        totals = totals.withColumnRenamed("customer_id", "_customer")
        rows = windowed.join(totals, F.col("customer_id").eqNullSafe(F.col("_customer"))).drop("_customer")
    else:
        rows = range_window_features(base.select(*BASE_COLUMNS), totals=("channel", "location"), stored=stored)
    return rows.select(
        "*",
        *[e.alias(n) for n, e in calendar.calendar_ints(ts).items()],
        (F.col("amount") / F.when(F.col("amount_mean_total") != 0, F.col("amount_mean_total")))
        .alias("amount_vs_mean_ratio"),
        velocity_score(F.col("tx_count_24h"), F.col("amount_sum_24h"), F.col("amount_mean_total"))
        .alias("velocity_score"),
    )


def scored(rows: DataFrame) -> DataFrame:
    """The 38 dictionary columns of ``feature_rows`` (a stored table): cyclic
    encodings, log/round flags and the composite risk."""
    rows, stat = attach(rows, rows.agg(
        F.min("amount_vs_mean_ratio").alias("_min_amount_vs_mean_ratio"),
        F.max("amount_vs_mean_ratio").alias("_max_amount_vs_mean_ratio"),
        F.min("velocity_score").alias("_min_velocity_score"),
        F.max("velocity_score").alias("_max_velocity_score"),
    ), "_minmax")
    w_m, w_r, w_v, w_f = COMPOSITE_WEIGHTS
    composite = (F.lit(w_m) * F.col("merchant_risk_score")
                 + F.lit(w_r) * _minmax_norm("amount_vs_mean_ratio", stat)
                 + F.lit(w_v) * _minmax_norm("velocity_score", stat)
                 + F.lit(w_f) * F.when(F.col("tx_count_24h") > HIGH_FREQUENCY_COUNT, 1.0).otherwise(0.0))
    derived = {
        "hour_sin": cyclic(F.col("hour"), 24, "sin"),
        "hour_cos": cyclic(F.col("hour"), 24, "cos"),
        "day_sin": cyclic(F.col("day_of_week"), 7, "sin"),
        "day_cos": cyclic(F.col("day_of_week"), 7, "cos"),
        "month_sin": cyclic(F.col("month"), 12, "sin"),
        "month_cos": cyclic(F.col("month"), 12, "cos"),
        "amount_log": amount_log(F.col("amount")),
        "amount_rounded": amount_rounded(F.col("amount")),
        "composite_risk": composite,
    }
    return rows.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in SOURCE_COLUMNS])


def silver(bronze: DataFrame, scale: int = 100) -> DataFrame:
    """NULL fraud technique -> 'unknown', numerics as fixed point, drop the
    rescue column, full-row dedup by fingerprints (``bronze`` is a projection
    of a stored table; only its repeated rows are shuffled in full).  The
    fingerprints are of the base columns, from which the others follow, so
    finding the repeated ones reads and computes no others; the rows that share
    one are compared in all columns."""
    df = drop_columns(bronze, [RESCUED_DATA])
    df = fill_null_constant(df, "fraud_technique", FRAUD_TECHNIQUE_FILL)
    df = fixed_point_encode(df, exclude=[*SILVER_UNSCALED, "fraud_technique"], scale=scale)
    base = [c for c in BASE_COLUMNS if c in df.columns] or df.columns
    return dedup_full_row(df, lambda rows: row_fingerprint(rows.select(*base)))


def gold(silver_df: DataFrame, scale: int = 100, exact_median: bool = False,
         numeric: list[str] | None = None, categorical: list[str] | None = None) -> DataFrame:
    """Decode, impute (median / mode from one stats row), derive categories,
    add audit columns and put the 21 leading columns first."""
    num = GOLD_NUMERIC if numeric is None else numeric
    cat = GOLD_CATEGORICAL if categorical is None else categorical
    df = fixed_point_decode(silver_df, num, scale)
    # the sketch uses the same 0.01 relative rank error as the original
    df = impute(df, num, cat, exact=exact_median, fallback=MODE_FALLBACK,
                accuracy=int(round(1 / MEDIAN_RELATIVE_ERROR)))
    df = df.withColumns({
        "risk_category": bins.risk_category(F.col("composite_risk")),
        "is_fraudulent": bins.is_fraudulent(F.col("is_fraud")),
    })
    df = audit_columns(df, DATA_QUALITY_SCORE)
    df = df.withColumns({
        "transaction_hour_category": bins.hour_category(F.col("hour")),
        "amount_category": bins.amount_category(F.col("amount")),
    })
    return reorder_columns(df, GOLD_LEADING)


def analysis_view(gold_df: DataFrame) -> DataFrame:
    """Notebook preparation as one projection: parse time, calendar names,
    day class, season, drop feature columns, time bucket, month category."""
    ts_type = gold_df.schema["timestamp"].dataType
    df = gold_df.withColumn("timestamp", calendar.parse_timestamp(F.col("timestamp"), ts_type))
    ts = F.col("timestamp")
    df = df.withColumns({
        "year": F.year(ts),
        "month": calendar.month_name(ts),
        "day_of_week": calendar.day_name(ts),
        "hour": F.hour(ts),
        "time": calendar.time_of_day(ts),
        "day": F.dayofmonth(ts),
    })
    df = df.withColumn("DayClassification", bins.day_classification(ts))
    df = df.withColumn("season", bins.season(F.col("month")))
    df = drop_columns(df, ANALYSIS_DROP_FIRST)
    df = drop_columns(df, ANALYSIS_DROP_SECOND)
    return df.withColumns({
        "time_bucket": bins.time_bucket(F.col("hour")),
        "month_category": bins.month_category(F.col("day")),
    })
