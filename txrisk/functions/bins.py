"""Conditional bins (CASE WHEN chains) of the gold layer and the notebook.

NULL input falls through to the ``otherwise`` branch, as in the original
CASE chains; NaN is turned into NULL by the callers first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txrisk.schema import DRY_SEASON_MONTHS, RAINY_SEASON_MONTHS

# ---------------------------------------------------------------------------
# FIXED VALUES: bin labels and bounds (must match the specification)
# ---------------------------------------------------------------------------
RISK_BINS = [(0.75, "High Risk"), (0.50, "Medium Risk"), (0.25, "Low Risk")]
RISK_DEFAULT = "Very Low Risk"

HOUR_CATEGORY_BINS = [(6, 11, "Morning"), (12, 17, "Afternoon"), (18, 22, "Evening")]
HOUR_CATEGORY_DEFAULT = "Night"

AMOUNT_BINS = [(100, "Small"), (500, "Medium"), (2000, "Large")]
AMOUNT_DEFAULT = "Very Large"

TIME_BUCKETS = [
    (0, 4, "Midnight (00:00–04:59)"),
    (5, 7, "Early Morning (05:00–07:59)"),
    (8, 11, "Morning (08:00–11:59)"),
    (12, 14, "Midday (12:00–14:59)"),
    (15, 17, "Afternoon (15:00–17:59)"),
    (18, 20, "Evening (18:00–20:59)"),
    (21, 23, "Night (21:00–23:59)"),
]
MONTH_CATEGORIES = [
    (1, 10, "Beginning (1st–10th)"),
    (11, 20, "Mid Month (11th–20th)"),
    (21, 31, "Month End (21st–31st)"),
]
UNKNOWN = "Unknown"
DRY_SEASON = "Dry Season"
RAINY_SEASON = "Rainy Season"
WEEKDAY = "Weekday"
WEEKEND = "Weekend"


def _ranges(x: Column, bins, default: str) -> Column:
    expr = None
    for lo, hi, label in bins:
        cond = x.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)


def _thresholds_ge(x: Column, bins, default: str) -> Column:
    expr = None
    for bound, label in bins:
        cond = x >= bound
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)


def _thresholds_lt(x: Column, bins, default: str) -> Column:
    expr = None
    for bound, label in bins:
        cond = x < bound
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)


def risk_category(composite_risk: Column) -> Column:
    return _thresholds_ge(composite_risk, RISK_BINS, RISK_DEFAULT)


def is_fraudulent(is_fraud: Column) -> Column:
    """TRUE when the label is 1; NULL and anything else -> FALSE."""
    return F.coalesce(is_fraud == 1, F.lit(False))


def hour_category(hour: Column) -> Column:
    return _ranges(hour, HOUR_CATEGORY_BINS, HOUR_CATEGORY_DEFAULT)


def amount_category(amount: Column) -> Column:
    return _thresholds_lt(amount, AMOUNT_BINS, AMOUNT_DEFAULT)


def time_bucket(hour: Column) -> Column:
    return _ranges(hour, TIME_BUCKETS, UNKNOWN)


def month_category(day: Column) -> Column:
    return _ranges(day, MONTH_CATEGORIES, UNKNOWN)


def season(month_name: Column) -> Column:
    return (F.when(month_name.isin(*DRY_SEASON_MONTHS), DRY_SEASON)
            .when(month_name.isin(*RAINY_SEASON_MONTHS), RAINY_SEASON)
            .otherwise(UNKNOWN))


def day_classification(ts: Column) -> Column:
    """Weekend for Saturday/Sunday of the timestamp, else Weekday."""
    return F.when(F.weekday(ts) >= 5, WEEKEND).otherwise(WEEKDAY)
