"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DecimalType


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_up(x, scale: int) -> Column:
    """Round half away from zero through a decimal, returned as DOUBLE.

    Going through DECIMAL(38,12) makes the tie rule explicit (1.005 -> 1.01)
    and identical to the SQL form ``round(CAST(x AS DECIMAL(38,12)), s)``.
    Values from 1e25 on have no fraction to round and would not fit: they stay.
    """
    v = _col(x).cast("double")
    return F.when(F.abs(v) < 1e25, F.round(_col(x).cast(DecimalType(38, 12)), scale).cast("double")).otherwise(v)


def safe_divide(num, den) -> Column:
    """Division that yields NULL on a zero or NULL denominator."""
    return F.try_divide(_col(num), _col(den))


def decade_of(year_col) -> Column:
    """floor(year / 10) * 10 as INT; NULL stays NULL."""
    return (F.floor(_col(year_col) / F.lit(10)) * F.lit(10)).cast("int")


def relative_change(current, previous) -> Column:
    """abs(cur - prev) / prev, NULL unless prev > 0."""
    prev = _col(previous).cast("double")
    return F.when(prev > 0, F.abs(_col(current).cast("double") - prev) / prev)


def fraction_floor(n, fraction: float) -> Column:
    """int(fraction * n), the row-count floor (F16)."""
    return F.floor(F.lit(float(fraction)) * _col(n).cast("double")).cast("bigint")
