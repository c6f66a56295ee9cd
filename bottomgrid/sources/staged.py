"""Staged and published tables: hand-off reconcile (S8), previous product
and the product query over the last days (S10)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import nan_to_null
from ..functions.times import parse_time
from ..schemas import STAGED_OPTIONAL, STAGED_REQUIRED, STAGED_TYPES

HANDOFF_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def reconcile(df: DataFrame, required: list[str] = STAGED_REQUIRED,
              optional: list[str] = STAGED_OPTIONAL,
              types: dict[str, T.DataType] = STAGED_TYPES) -> DataFrame:
    """Required columns must exist, optional ones are taken when present,
    everything is cast with ``try_cast`` (text in a number column -> NULL), NaN
    becomes NULL, and a text time is parsed (unparseable -> NULL). Extra columns are dropped."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"hand-off lacks required columns: {missing}")
    cols = []
    for c in required + [o for o in optional if o in df.columns]:
        t = types.get(c)
        if c == "time":
            src = df.schema[c].dataType
            if isinstance(src, T.StringType):
                cols.append(F.coalesce(parse_time(F.col(c), src, HANDOFF_TIME_FORMAT),
                                       parse_time(F.col(c), src)).alias(c))
            else:
                cols.append(parse_time(F.col(c), src).alias(c))
        elif t is not None:
            cols.append(F.col(c).try_cast(t).alias(c))
        else:
            cols.append(F.col(c))
    return nan_to_null(df.select(*cols))     # NaN in the file or made by a cast


def reconcile_staged(df: DataFrame) -> DataFrame:
    """S8 for the hand-off table; the union order of the sources
    (``source_ord``) and the tie column are kept when present, with the time
    they define "first"."""
    types = dict(STAGED_TYPES, source_ord=T.IntegerType(), tie=T.LongType())
    return reconcile(df, optional=STAGED_OPTIONAL + ["source_ord", "tie"], types=types)


def read_staged(spark: SparkSession, path: str) -> DataFrame:
    """The hand-off table written by K1, reconciled."""
    return reconcile_staged(spark.read.parquet(path))


def read_previous(spark: SparkSession, path: str) -> DataFrame:
    """The whole previous product (all days, all columns), NaN as NULL."""
    return nan_to_null(spark.read.parquet(path))


def recent(product: DataFrame, cols: list[str] | None, days: int,
           now: dt.date | str, time: str = "time") -> DataFrame:
    """Chosen columns over the last ``days`` days up to ``now``.

    ``time`` may be a date (the daily frame) or days since epoch (the
    published product, where it is the partition column): the bounds are
    written in the same form, so on the published product the predicate is a
    partition filter and only the matching day folders are listed and read."""
    now_d = F.to_date(F.lit(str(now)))
    lo, hi = F.date_sub(now_d, days), now_d
    dtype = product.schema[time].dataType
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType)):
        lo, hi = F.unix_date(lo), F.unix_date(hi)
    out = product.where(F.col(time).between(lo, hi))
    return out.select(*cols) if cols else out
