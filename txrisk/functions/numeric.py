"""Numeric feature expressions from the column dictionary."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from txrisk.functions.fixedpoint import nan_to_null, round_half_up


def cents(amount: Column) -> Column:
    """Money as exact integer cents.

    Sums of cents are exact and associative, so a total does not depend on
    how partitions were combined (double sums do).  NaN counts as NULL.
    """
    return round_half_up(nan_to_null(amount.cast("double")) * F.lit(100.0)).cast("long")


def cyclic(x: Column, period: int, fn: str) -> Column:
    """``sin/cos(2*pi*x/period)``."""
    arg = F.lit(2.0 * math.pi) * x.cast("double") / F.lit(float(period))
    return F.sin(arg) if fn == "sin" else F.cos(arg)


def amount_log(amount: Column) -> Column:
    """``log(1 + amount)``."""
    return F.log1p(amount.cast("double"))


def amount_rounded(amount: Column) -> Column:
    """1 when the amount is a multiple of 1000, else 0."""
    return F.when((amount.cast("double") % F.lit(1000.0)) == 0, 1).otherwise(0)


def velocity_score(tx_count_24h: Column, amount_sum_24h: Column, amount_mean_total: Column) -> Column:
    """``tx_count_24h * amount_sum_24h / (amount_mean_total + 1)``."""
    return tx_count_24h * amount_sum_24h / (amount_mean_total + F.lit(1.0))
