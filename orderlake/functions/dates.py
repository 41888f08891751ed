"""Date helpers.

Two different day counts exist on purpose: ``whole_days`` counts complete
24-hour periods of a timestamp difference, truncated toward zero, while RFM
recency uses calendar-date ``datediff``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(ts: Column | str) -> Column:
    """First day of the month of a timestamp, as DATE."""
    return F.trunc(F.to_date(_c(ts)), "MM")


def whole_days(later: Column | str, earlier: Column | str) -> Column:
    """Whole days in ``later - earlier`` (NULL if either is NULL); INT."""
    return F.extract(F.lit("DAY"), _c(later) - _c(earlier)).cast("int")


def month_index(d: Column | str) -> Column:
    """year * 12 + month, for month distances."""
    d = _c(d)
    return F.year(d) * 12 + F.month(d)


def ntz_lit(value: dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal built from text (no session or process time zone involved)."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
