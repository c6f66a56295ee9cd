"""Run-log analytics: rows per feed (A8), latest run (A10), last full run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def feed_counts(raw: DataFrame, kept: DataFrame, feed: str = "dataset_id",
                feeds: list[str] | None = None) -> DataFrame:
    """Raw and kept row counts per feed. Both sides are partial
    aggregates (one small row per feed); a full outer join lines them up and
    a feed that returned nothing reports zeros when it is listed in ``feeds``."""
    r = raw.groupBy(feed).agg(F.count(F.lit(1)).alias("observation_count"))
    k = kept.groupBy(feed).agg(F.count(F.lit(1)).alias("post_filter_count"))
    out = r.join(k, feed, "full")
    if feeds:
        listed = raw.sparkSession.createDataFrame([(f,) for f in feeds], f"{feed} string")
        out = out.join(listed, feed, "full")
    return out.select(feed, F.coalesce("observation_count", F.lit(0)).alias("observation_count"),
                      F.coalesce("post_filter_count", F.lit(0)).alias("post_filter_count"))


def counts_frame(spark: SparkSession, raw: dict[str, int], kept: dict[str, int],
                 feed: str = "dataset_id") -> DataFrame:
    """A8 table from known counts, one row per feed."""
    rows = [(k, int(raw[k]), int(kept.get(k, 0))) for k in raw]
    return spark.createDataFrame(rows, f"{feed} string, observation_count long, post_filter_count long")


def latest_run(log: DataFrame, runtime: str = "runtime", kind: str = "reload_type") -> DataFrame:
    """A10: the latest runtime and its reload type (one row). Ties on the
    latest runtime go to the smallest reload type, so the answer is stable."""
    return (log.groupBy(kind).agg(F.max(runtime).alias(runtime))
               .orderBy(F.col(runtime).desc(), F.col(kind).asc())
               .limit(1)
               .select(runtime, kind))


def last_full_run(log: DataFrame, runtime: str = "runtime", kind: str = "reload_type",
                  full: str = "full") -> DataFrame:
    """The latest runtime of a full refresh (NULL when there is none)."""
    return log.where(F.col(kind) == F.lit(full)).agg(F.max(runtime).alias(runtime))
