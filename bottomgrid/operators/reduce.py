"""Feed reductions: hourly means (A1, A2) and the deepest row per profile (A3).

All are single aggregations with map-side partial aggregation; none needs
the rows of a group together in one task. The hourly means are hash
aggregations; the deepest row is found on narrow rows and fetched by its number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir
from .sizing import ROW_WISE, broadcast_if_small


def hour_start(time: str = "time"):
    """Start of the calendar hour as ``timestamp_ntz`` (no session zone)."""
    return F.window(F.col(time), "1 hour").start


def hourly_mean(df: DataFrame, group: str | list[str], measures: list[str],
                time: str = "time", counts: bool = False) -> DataFrame:
    """A1: mean of each measure per group and calendar hour (label = hour
    start); rows without a group or a time are dropped, empty hours never appear, and
    hours whose means are all missing are dropped. ``counts`` adds the
    non-null count of each measure as ``<m>_count``."""
    groups = [group] if isinstance(group, str) else list(group)
    base = df.where(F.col(time).isNotNull())      # no hour bin for a missing time
    for g in groups:
        base = base.where(F.col(g).isNotNull())
    aggs = [F.avg(m).alias(m) for m in measures]
    if counts:
        aggs += [F.count(m).alias(f"{m}_count") for m in measures]
    out = base.groupBy(*groups, hour_start(time).alias(time)).agg(*aggs)
    return out.na.drop(how="all", subset=measures)


def hourly_by_station(df: DataFrame, station: str = "dataset_id", time: str = "time",
                      measures: list[str] | None = None) -> DataFrame:
    """A2: hourly mean of every numeric column per station. The station joins
    the key because stations are unioned before the reduction."""
    if measures is None:
        numeric = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
        measures = [f.name for f in df.schema.fields
                    if isinstance(f.dataType, numeric) and f.name not in (station, time)]
    return (df.groupBy(station, hour_start(time).alias(time))
              .agg(*[F.avg(m).alias(m) for m in measures]))


FILE, ROW = "_metadata.file_path", "_metadata.row_index"


def rows_have_numbers(df: DataFrame) -> bool:
    """Whether every row of ``df`` is one row of one Parquet file, which its
    file and number name."""
    try:
        plan = df._jdf.queryExecution().analyzed()
    except AttributeError:      # Spark Connect: the plan is on the server
        return False
    while plan.nodeName() in ROW_WISE:
        plan = plan.children().apply(0)
    return plan.nodeName() == "LogicalRelation" and "parquet" in plan.simpleString(100).lower()


def deepest(df: DataFrame, key: str, value: str, tie: str | None = None,
            broadcast_limit: int | None = None) -> DataFrame:
    """A3: the row with the largest ``value`` per ``key``; on a tie the row
    with the smallest ``tie`` wins (the first row). Rows without a key are
    dropped, and so is a profile whose values are all missing.

    Over files whose rows have numbers (Parquet), the winners are found on
    key, value, tie and the row's file and number alone, one candidate per key
    per map task, and the whole rows are fetched by file and number: wide rows
    are neither aggregated nor sorted. The winners are broadcast if they are
    few enough (they are counted), else hashed on their side of a shuffle.
    Without such numbers ``min_by`` carries the whole row, which Spark
    aggregates by sorting."""
    cols = df.columns
    order = [(-F.col(value)).alias("v")] + ([F.col(tie).alias("t")] if tie else [])
    rank = F.when(F.col(value).isNotNull(), F.struct(*order))
    keyed = df.where(F.col(key).isNotNull())
    if not rows_have_numbers(df):
        best = keyed.groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*[F.col(c) for c in cols]), rank).alias("_r"))
        return best.where(F.col("_r").isNotNull()).select("_r.*")
    where = F.struct(F.col(FILE).alias("f"), F.col(ROW).alias("n"))
    # of rows that tie in all but their place, the first in the files
    place = F.when(rank.isNotNull(), F.struct(rank.alias("r"), where.alias("w")))
    best = keyed.groupBy(F.col(key).alias("_key")).agg(F.min(place).alias("_p")).where(F.col("_p").isNotNull())
    checkpoint_dir(df.sparkSession)
    best = best.select(F.col("_p.w.f").alias("_file"), F.col("_p.w.n").alias("_row")).checkpoint()
    few, small = broadcast_if_small(best, best.count(), 256, broadcast_limit)
    if not small:
        few = few.hint("shuffle_hash")
    placed = keyed.select("*", F.col(FILE).alias("_f"), F.col(ROW).alias("_n"))
    return placed.join(few, (F.col("_f") == F.col("_file")) & (F.col("_n") == F.col("_row"))).select(*cols)
