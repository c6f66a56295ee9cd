"""Sinks of the product: staged hand-off (K1), day-partitioned product (K3)
and archive catalogue (K5; the snapshots themselves are in ``snapshots.py``)."""

from __future__ import annotations

import datetime as dt
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.times import utc_naive
from ..session import content_bytes
from ..schemas import ARCHIVE_SCHEMA
from .logs import append_once
from .snapshots import citation_url


STAGE_DAY = "day"


def _staged_rows(df: DataFrame) -> DataFrame:
    out = df.na.drop(subset=["id"])
    if "geometry" in out.columns:
        out = out.drop("geometry")
    return out.withColumn(STAGE_DAY, F.to_date("time"))


def stage(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1: overwrite the hand-off table with the gridded observations that
    have a cell (no geometry is ever carried). The table is partitioned by
    observation day, so readers that recompute some days (T1, T2) list and
    read only those day folders (partition pruning)."""
    (_staged_rows(df).hint("rebalance", STAGE_DAY)
     .write.mode(mode).partitionBy(STAGE_DAY).parquet(path))


def stage_append(df: DataFrame, path: str) -> None:
    """K1 for late files: add rows to the hand-off table in the same layout."""
    stage(df, path, mode="append")


def publish_days(df: DataFrame, path: str, day_col: str = "time") -> list[int]:
    """K3: write the product partitioned by ``year/month/time`` (time = days
    since epoch). Only the days present in ``df`` are replaced; other days
    stay as they are (dynamic partition overwrite, set on this write only).

    The REBALANCE hint shuffles by day and lets AQE split a day with many
    rows into several files and merge small days, so neither a hot day nor
    many tiny days dictate the task layout. The days are observed above the
    shuffle, where a frame that turns out empty still has its observing node.
    Returns the written days."""
    d = F.date_from_unix_date(F.col(day_col))
    seen = Observation(f"published-days-{uuid.uuid4().hex}")
    out = (df.withColumn("year", F.year(d)).withColumn("month", F.month(d))
             .hint("rebalance", day_col)
             .sortWithinPartitions(day_col, *[c for c in ("grid_id",) if c in df.columns])
             .observe(seen, F.collect_set(F.col(day_col)).alias("days")))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month", day_col).parquet(path))
    # the day list is gathered while writing (one small set per task), so the
    # product is not computed a second time to report it; where a plan lost
    # the observing node all the same, its own keys are asked
    try:
        days = seen.get.get("days") or []
    except (AssertionError, Py4JJavaError):
        days = [r[0] for r in df.select(day_col).distinct().collect()]
    return sorted(int(x) for x in days)


def files_size_mb(spark: SparkSession, path: str) -> float:
    """Total size of the data files under ``path`` in MB (1 decimal).

    Taken from the file system's content summary (a listing, no data read);
    without a JVM gateway, from the distinct files of the ``_metadata``
    column instead (a scan)."""
    total = content_bytes(spark, path)
    if total is None:
        files = (spark.read.parquet(path)
                 .select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s"))
                 .distinct())
        total = files.agg(F.sum("s")).first()[0] or 0
    return round(total / (1024 * 1024), 1)


def log_archive(spark: SparkSession, catalogue_path: str, snapshot: str, public_url: str,
                when: dt.datetime, version: str, doi: str | None, reload_type: str,
                size_mb: float, run_id: str | None = None) -> DataFrame:
    """K5: append one catalogue row per archive (once per run)."""
    row = [(snapshot, public_url, utc_naive(when), version, doi or "",
            citation_url(doi), reload_type, float(size_mb))]
    df = spark.createDataFrame(row, ARCHIVE_SCHEMA)
    append_once(df, catalogue_path, run_id, ["archive_s3_key"])
    return df


def catalogue_view(catalogue: DataFrame) -> DataFrame:
    """K5: the public catalogue: archive day and renamed URL."""
    return catalogue.select("version", "doi", "reload_type",
                            F.to_date("archive_date").alias("time"),
                            F.col("archive_public_url").alias("file_url"),
                            "file_size_mb", "citation_url")


def export_catalogue(catalogue: DataFrame, path: str) -> None:
    """K5: one CSV with a header (one row per archive, so one file is fine)."""
    catalogue_view(catalogue).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
