"""Time column functions.

Timestamps without a zone are ``TIMESTAMP_NTZ``; differences are taken in
integer microseconds with ``timestampdiff`` (``unix_micros`` and
``extract(epoch ...)`` reject NTZ values).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType


def _epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros_between(start, end) -> Column:
    """Signed integer microseconds ``end - start`` (both NTZ or both LTZ)."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end))


def epoch_micros(c, dtype: DataType | None = None) -> Column:
    """Microseconds since 1970-01-01 (UTC wall clock for NTZ)."""
    if dtype is None or isinstance(dtype, TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", _epoch_ntz(), _c(c))
    return F.unix_micros(_c(c))


def utc_ntz(c) -> Column:
    """Zoned instant -> UTC wall clock without zone (session tz is UTC)."""
    return _c(c).cast("timestamp_ntz")


def calendar_parts(c) -> dict[str, Column]:
    """UTC date / year / month / day of an instant."""
    c = _c(c)
    return {"date": F.to_date(c), "year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c)}
