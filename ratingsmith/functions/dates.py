"""Date helpers.

Epoch seconds become a UTC calendar date by integer arithmetic, so the
result does not depend on the session time zone of whoever runs the job.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SECONDS_PER_DAY = 86400


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_to_date(epoch_seconds) -> Column:
    """UTC date of an epoch-seconds value (F1)."""
    days = F.floor(_col(epoch_seconds) / F.lit(SECONDS_PER_DAY)).cast("int")
    return F.date_from_unix_date(days)


def year_of(date_col) -> Column:
    """Calendar year as INT (F2)."""
    return F.year(_col(date_col)).cast("int")


def day_number(date_col) -> Column:
    """Days since 1970-01-01, the numeric axis for day-range frames."""
    return F.unix_date(_col(date_col))
