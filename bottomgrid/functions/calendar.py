"""The refresh window chosen from the run date, as a column function."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: start of the full history and the schedule rules
FULL_START = "2000-01-01"
QUARTER_MONTHS = (4, 7, 10)
BIWEEKLY_DAYS = (1, 15)
DAILY_LOOKBACK_DAYS = 5


def refresh_window(run_date: Column, force_full: bool = False) -> Column:
    """``struct(reload_type, start)`` for a run on ``run_date`` (a date or
    timestamp, UTC). ``start`` is a midnight ``timestamp_ntz``.

    forced -> manual_full since 2000-01-01; Jan 1 -> full since 2000-01-01;
    1 Apr/Jul/Oct -> quarterly, one year back; day 1 or 15 -> bi-weekly, one
    month back; otherwise daily, five days back."""
    d = F.to_date(run_date)
    full = F.to_date(F.lit(FULL_START))
    if force_full:
        kind, start = F.lit("manual_full"), full
    else:
        m, day = F.month(d), F.dayofmonth(d)
        rule = (F.when((m == 1) & (day == 1), F.struct(F.lit("full").alias("t"), full.alias("s")))
                .when(m.isin(*QUARTER_MONTHS) & (day <= 1),
                      F.struct(F.lit("quarterly").alias("t"), F.add_months(d, -12).alias("s")))
                .when(day.isin(*BIWEEKLY_DAYS),
                      F.struct(F.lit("bi-weekly").alias("t"), F.add_months(d, -1).alias("s")))
                .otherwise(F.struct(F.lit("daily").alias("t"),
                                    F.date_sub(d, DAILY_LOOKBACK_DAYS).alias("s"))))
        kind, start = rule["t"], rule["s"]
    return F.struct(kind.alias("reload_type"), start.cast("timestamp_ntz").alias("start"))
