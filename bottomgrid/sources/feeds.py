"""Feed scans: registry-driven multi-source scan (S1), declarative row
constraints (S2), refresh window (S3), scan normalization (S4) and side-loads
(S5). Every scan is lazy; filters are plain column predicates, so Catalyst
pushes them into the Parquet reader (``PushedFilters``) and prunes columns."""

from __future__ import annotations

import datetime as dt
import operator
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..functions.columns import nan_to_null
from ..functions.times import ntz_lit, parse_time, utc_naive
from ..operators.sizing import spread_small_input
from ..registry import FEEDS, Feed
from ..session import path_exists

_OPS = {
    ">=": operator.ge, "<=": operator.le, "!=": None, "=": operator.eq,
    ">": operator.gt, "<": operator.lt,
}
_KEY = re.compile(r"^(.*?)(>=|<=|!=|=|>|<)$")


def constraint_predicate(constraints: dict) -> Column | None:
    """``{"var<op>": value}`` pairs ANDed into one predicate. Comparisons
    drop NULLs; ``!=`` keeps them (a missing value is not equal to it)."""
    preds = []
    for key, value in constraints.items():
        m = _KEY.match(key)
        if not m:
            raise ValueError(f"bad constraint key {key!r}")
        name, op = m.group(1), m.group(2)
        c, v = F.col(name), F.lit(value)
        preds.append(~c.eqNullSafe(v) if op == "!=" else _OPS[op](c, v))
    return reduce(lambda a, b: a & b, preds) if preds else None


def apply_constraints(df: DataFrame, constraints: dict) -> DataFrame:
    """S2 applied before projection, so constraints may use columns that are
    not among the requested variables."""
    p = constraint_predicate(constraints)
    return df if p is None else df.where(p)


def time_window(df: DataFrame, lo, hi=None, time: str = "time",
                lo_inclusive: bool = True) -> DataFrame:
    """S3: ``lo <= time <= hi`` (``lo < time`` for side-loads)."""
    t = F.col(time)
    cond = (t >= ntz_lit(lo)) if lo_inclusive else (t > ntz_lit(lo))
    if hi is not None:
        cond = cond & (t <= ntz_lit(hi))
    return df.where(cond)


def day_window(df: DataFrame, lo, hi=None, day: str = "day") -> DataFrame:
    """S3 for feeds that land with the UTC day of each row, as a column or as
    partition folders: the same window by day, which prunes the folders. Rows
    without a day stay and are left to the window on their time."""
    if dict(df.dtypes).get(day) != "date":       # a column of that name with another meaning
        return df
    d = F.col(day)
    cond = d >= F.to_date(ntz_lit(lo))
    if hi is not None:
        cond = cond & (d <= F.to_date(ntz_lit(hi)))
    return df.where(cond | d.isNull())


def text_window(df: DataFrame, lo, hi=None, time: str = "time") -> DataFrame:
    """S3 for times landed as ISO 8601 text: a range of text that holds the
    window whatever the zone of a text (a day is left on either side), so that
    the reader can skip row groups before a text is parsed."""
    if dict(df.dtypes).get(time) != "string":
        return df
    day = dt.timedelta(days=1)

    def date_of(x) -> dt.date:
        x = dt.datetime.fromisoformat(x) if isinstance(x, str) else x
        return utc_naive(x).date() if isinstance(x, dt.datetime) else x

    cond = F.col(time) >= (date_of(lo) - day).isoformat()
    if hi is not None:
        cond = cond & (F.col(time) < (date_of(hi) + 2 * day).isoformat())
    return df.where(cond)


def strip_units(df: DataFrame) -> DataFrame:
    """``"temperature (degree_C)"`` -> ``temperature``."""
    return df.toDF(*[c.split(" ")[0] for c in df.columns])


def normalize_scan(df: DataFrame, variables: list[str] | tuple[str, ...],
                   time_col: str = "time") -> DataFrame:
    """Strip unit suffixes, keep the requested variables, rename the time
    variable to ``time``, parse it, drop the zone, NaN -> NULL."""
    df = strip_units(df)
    keep = [v for v in variables if v in df.columns]
    df = df.select(*keep)
    if time_col in df.columns:
        dtype = df.schema[time_col].dataType
        df = df.withColumn(time_col, parse_time(F.col(time_col), dtype))
        if time_col != "time":
            df = df.withColumnRenamed(time_col, "time")
    return nan_to_null(df)


@dataclass
class FeedScan:
    feed: Feed
    frame: DataFrame | None
    status: str          # ok | missing | error: ...


def error_status(e: Exception) -> str:
    return f"error: {type(e).__name__}: {str(e)[:200]}"


def _load(spark: SparkSession, f: Feed, paths: list[str], schema: T.StructType | None, base: str | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if base is not None:
        reader = reader.option("basePath", base)
    if f.fmt == "csv":
        return reader.option("header", True).csv(paths)
    return reader.format(f.fmt).load(paths)


def scan_feed(spark: SparkSession, f: Feed, root: str, lo=None, hi=None,
              schema: T.StructType | None = None, files: list[str] | None = None) -> FeedScan:
    """One feed: read the landed files (or only ``files`` of them), constrain,
    prune by day or text where the feed allows it, normalize, window. Whatever
    fails, be it the file system, is this feed's status."""
    path = f"{root}/{f.feed_id}"
    try:
        if not path_exists(spark, path):
            return FeedScan(f, None, "missing")
        raw = strip_units(_load(spark, f, files or [path], schema, path if files else None))
        raw = apply_constraints(raw, f.constraints)
        if lo is not None:
            raw = day_window(raw, lo, hi, f.day_col)
            if f.iso_times:
                raw = text_window(raw, lo, hi, f.time_col)
        df = normalize_scan(raw, f.variables, f.time_col)
        if lo is not None:
            df = time_window(df, lo, hi)
        df = spread_small_input(df)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return FeedScan(f, None, "missing")
        return FeedScan(f, None, f"error: {str(e)[:200]}")
    except Exception as e:  # noqa: BLE001  (an unreadable footer or location: this feed's status, not the run's end)
        return FeedScan(f, None, error_status(e))
    return FeedScan(f, df, "ok")


def landed_files(spark: SparkSession, f: Feed, root: str) -> list[str]:
    """The files of a feed, from a listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/{f.feed_id}")
    return sorted(r["path"] for r in files.select("path").collect())


def unreadable_files(spark: SparkSession, f: Feed, root: str, files: list[str],
                     schema: T.StructType | None = None) -> dict[str, str]:
    """Files of a feed that cannot be read to their end, with the error. Asked
    only about a feed that failed: the files are read together, and halves of
    a set that fails are read on their own, so a few bad files among many cost
    a few reads each."""
    if not files:
        return {}
    try:
        _load(spark, f, files, schema, f"{root}/{f.feed_id}").write.format("noop").mode("overwrite").save()
        return {}
    except Exception as e:  # noqa: BLE001  (whatever a bad file raises)
        if len(files) == 1:
            return {files[0]: error_status(e)}
    half = len(files) // 2
    return {**unreadable_files(spark, f, root, files[:half], schema), **unreadable_files(spark, f, root, files[half:], schema)}


def read_feeds(spark: SparkSession, root: str, lo=None, hi=None,
               feeds: tuple[Feed, ...] = FEEDS,
               schemas: dict[str, T.StructType] | None = None) -> dict[str, FeedScan]:
    """Scan every registered feed. A missing or failing feed does not stop
    the others; its outcome is in the ``status`` for the run log (K2)."""
    schemas = schemas or {}
    return {f.feed_id: scan_feed(spark, f, root, lo, hi, schemas.get(f.feed_id)) for f in feeds}


# fixed values: side-load CSV columns (files carry the grid cell id)
SIDELOAD_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("time", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("salinity", T.DoubleType()),
    T.StructField("dissolved_oxygen", T.DoubleType()),
    T.StructField("data_provider", T.StringType()),
    T.StructField("fishery_dependent", T.IntegerType()),
])


def sideload_frame(df: DataFrame, grid: DataFrame, lo, grid_rows: int | None = None) -> DataFrame:
    """S5 after the read: drop the file's own position, take the cell's
    centroid, area and depth (left join on id), keep ``time > lo``."""
    from ..operators.spatial import attach_cell
    if "time" in df.columns:
        df = df.withColumn("time", parse_time(F.col("time"), df.schema["time"].dataType))
    df = nan_to_null(df)
    df = time_window(df, lo, lo_inclusive=False)
    return attach_cell(df, grid, grid_rows=grid_rows)


def read_sideload(spark: SparkSession, path: str, grid: DataFrame, lo,
                  schema: T.StructType = SIDELOAD_SCHEMA) -> DataFrame:
    """A side-loaded CSV (header, explicit schema, no inference)."""
    raw = spark.read.schema(schema).option("header", True).csv(path)
    return sideload_frame(raw, grid, lo)
