"""Size-checked broadcast: broadcast a side only when its size is proven."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest side we broadcast to every executor. The estimate is rows x a
# per-row width taken from the schema, so it bounds what is actually shipped.
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024


_FIXED = {"byte": 1, "short": 2, "integer": 4, "long": 8, "float": 4, "double": 8,
          "boolean": 1, "date": 4, "timestamp": 8, "timestamp_ntz": 8}


def _type_width(dt, array_len: int, string_len: int) -> int:
    name = dt.typeName()
    if name in _FIXED:
        return _FIXED[name]
    if name == "array":
        return 16 + array_len * _type_width(dt.elementType, array_len, string_len)
    if name == "struct":
        return sum(_type_width(f.dataType, array_len, string_len) + 8 for f in dt.fields)
    return string_len + 8


def row_width(df: DataFrame, array_len: int = 8, string_len: int = 64) -> int:
    """Rough upper bound of one row's bytes from the schema; ``array_len``
    is the longest array the caller has measured."""
    return sum(_type_width(f.dataType, array_len, string_len) + 8 for f in df.schema.fields)


def broadcast_if_small(df: DataFrame, rows: int, width: int | None = None,
                       limit: int | None = None) -> tuple[DataFrame, bool]:
    """Return ``(df with a broadcast hint, True)`` when ``rows x width`` is
    under ``limit``; otherwise the frame unchanged, to be joined by shuffle.

    ``rows`` must come from a count or an aggregate the caller already ran,
    so the decision rests on the real size and not on an estimate.
    """
    width = width or row_width(df)
    limit = DEFAULT_BROADCAST_BYTES if limit is None else limit
    if rows * width <= limit:
        return F.broadcast(df), True
    return df, False


# what may stand between a scan and a reader without changing what its rows say
ROW_WISE = {"Project", "Filter", "SubqueryAlias", "Repartition", "RepartitionByExpression", "RebalancePartitions"}


def read_again_alike(df: DataFrame) -> bool:
    """Whether ``df`` is nothing but files or given rows, read and computed row
    by row (or several such, one after the other): a second reading is cheap and
    gives every value to its last digit, unlike a mean summed anew."""
    try:
        plan = df._jdf.queryExecution().analyzed()
    except AttributeError:      # Spark Connect: the plan is on the server
        return False
    if plan.isStreaming() or not plan.deterministic():
        return False
    open_ = [plan]
    while open_:
        p = open_.pop()
        if p.nodeName() in ROW_WISE or p.nodeName() == "Union":
            open_.extend(p.children().apply(i) for i in range(p.children().size()))
        elif p.nodeName() not in ("LogicalRelation", "LocalRelation", "Range"):
            return False
    return True


# A scan with at least this many splits is never re-spread.
SPREAD_MAX_SPLITS = 32


def spread_small_input(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a scan that arrives in very few splits (one large file, one row
    group) over ``min(task slots, 32)`` partitions before row-wise heavy work.
    An input of many files already has enough splits and is left as it is,
    so on a large cluster at most 32 splits' worth of data is ever moved."""
    try:
        target = min_partitions or min(df.sparkSession.sparkContext.defaultParallelism,
                                       SPREAD_MAX_SPLITS)
        splits = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001  (e.g. a Spark Connect session: leave the scan as it is)
        return df
    return df.repartition(target) if splits < target else df
