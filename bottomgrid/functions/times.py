"""Time handling that does not depend on the session time zone.

Observation times are ``timestamp_ntz`` holding UTC wall-clock time. Text
with a zone designator is turned into that through the instant's epoch
microseconds; text without one is taken as written; Python datetimes enter
plans as text cast to ``timestamp_ntz``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")

_ZONED = r"(Z|[+-][0-9]{2}:?[0-9]{2})$"


def utc_naive(value: dt.datetime) -> dt.datetime:
    """An aware datetime as naive UTC wall time; a naive one is kept."""
    if value.tzinfo is not None:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def ntz_lit(value: dt.datetime | dt.date | str) -> Column:
    """A ``timestamp_ntz`` literal; an aware datetime is first moved to UTC."""
    if isinstance(value, dt.datetime):
        value = utc_naive(value).isoformat(sep=" ")
    elif isinstance(value, dt.date):
        value = value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


def instant_to_utc(c: Column) -> Column:
    """A zoned timestamp (an instant) as UTC wall time, ``timestamp_ntz``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), _epoch())


def parse_time(c: Column, dtype: T.DataType, fmt: str | None = None) -> Column:
    """Text or zoned time -> ``timestamp_ntz`` in UTC; unparseable -> NULL."""
    if isinstance(dtype, T.StringType):
        parsed = F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)
        return F.when(c.rlike(_ZONED), instant_to_utc(parsed)).otherwise(parsed.cast("timestamp_ntz"))
    if isinstance(dtype, T.TimestampType):
        return instant_to_utc(c)
    return c.cast("timestamp_ntz")
