"""Fixed-point storage of numeric columns (silver stores value x scale)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, NumericType, StringType


def nan_to_null(c: Column) -> Column:
    """NaN -> NULL so casts to long cannot overflow and bins see NULL."""
    return F.nanvl(c, F.lit(None).cast("double"))


def round_half_up(x: Column) -> Column:
    """``round(x, 0)`` (HALF_UP) of a double, without Spark's way through a
    BigDecimal per value: the nearest whole number, ties away from zero.  The
    difference to it is exact, so only true ties are moved."""
    size = F.abs(x)
    near = F.rint(size)
    return F.signum(x) * (near + F.when(size - near == 0.5, 1.0).otherwise(0.0))


def encode(c: Column, scale: int = 100) -> Column:
    """``round(x * scale, 0)`` (HALF_UP on the double product) as bigint.

    Strings are parsed as double first (``'32266.83'`` must not go through a
    bigint cast); NaN becomes NULL instead of a cast overflow.
    """
    as_double = nan_to_null(c.cast("double"))
    return round_half_up(as_double * F.lit(float(scale))).cast("long")


def decode(c: Column, scale: int = 100) -> Column:
    """Inverse of :func:`encode`: ``x / scale`` as double."""
    return (c / F.lit(float(scale))).cast("double")


def is_scalable(dtype: DataType) -> bool:
    """Columns that can be stored as fixed point (booleans never are)."""
    if isinstance(dtype, BooleanType):
        return False
    return isinstance(dtype, (NumericType, StringType))
