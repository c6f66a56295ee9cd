"""Publish when new hand-off rows land, and recompute a refresh
window for late or corrected data.

The staged folder is a file source; each micro-batch only tells *which days*
changed. Those days are recomputed from all staged rows (not from the batch
alone, which would give partial counts) and published with dynamic
partition overwrite, so replaying a batch after a failure rewrites the same
days with the same content: the sink is idempotent by construction.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.runs import product_frame, window_for
from ..functions.times import ntz_lit
from ..session import checkpoint_dir
from ..operators.sizing import broadcast_if_small
from ..sinks.publish import STAGE_DAY, publish_days
from ..sources.staged import reconcile_staged
from .ownership import own_checkpoint


def staged_schema(spark: SparkSession, staged_path: str):
    return spark.read.parquet(staged_path).schema


# Day lists up to this size become a static IN filter on the partition column.
MAX_LISTED_DAYS = 10_000
# New staged files that one micro-batch takes.
MAX_FILES = 1000


def publish_touched_days(spark: SparkSession, staged_path: str, product_path: str,
                         days: DataFrame, n_days: int) -> list[int]:
    """Recompute and publish the given days (a frame with a ``day`` date
    column, one row per day) from every staged row of those days. The staged
    table is partitioned by ``day``: a counted, small day list becomes an
    ``IN`` filter on the partition column, so only the touched day folders
    are listed and read; a longer list is applied as a semi join."""
    raw = spark.read.parquet(staged_path)
    if n_days <= MAX_LISTED_DAYS:
        listed = [r["day"] for r in days.collect()]
        touched = raw.where(F.col(STAGE_DAY).isin(listed))
    else:
        days, _ = broadcast_if_small(days, n_days, 16)
        touched = raw.join(days, raw[STAGE_DAY] == days["day"], "left_semi")
    return publish_days(product_frame(reconcile_staged(touched)), product_path)


def stream_checkpoint(product_path: str) -> str:
    """The checkpoint of the one stream that publishes a product, beside it."""
    return product_path.rstrip("/") + "_stream/checkpoint"


def publish_stream(spark: SparkSession, staged_path: str, product_path: str,
                   checkpoint: str | None = None, available_now: bool = True,
                   max_files: int = MAX_FILES) -> StreamingQuery:
    """File-source stream over the staged folder -> per batch, distinct
    days -> recompute those days from all staged rows -> publish.

    The checkpoint (by default beside the product, so each product has its
    own) is bound to the two tables: streams over different tables run side
    by side, and none continues another's. A batch takes at most
    ``max_files`` new files, so a backlog is drained in bounded steps."""
    checkpoint_dir(spark)   # each batch checkpoints its (small) day list
    checkpoint = checkpoint or stream_checkpoint(product_path)
    own_checkpoint(spark, checkpoint, {"staged": staged_path, "product": product_path})
    schema = staged_schema(spark, staged_path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(staged_path)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        days = (batch.select(F.col(STAGE_DAY).alias("day")).where(F.col("day").isNotNull())
                .distinct().checkpoint())
        n = days.count()
        if n == 0:
            return
        publish_touched_days(batch.sparkSession, staged_path, product_path, days, n)

    w = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def refresh(spark: SparkSession, staged_path: str, product_path: str, run_date: dt.date,
            force_full: bool = False) -> list[int]:
    """Recompute every day from the refresh window's start (R1) to the
    run date from the staged rows, replacing those days only."""
    _, start = window_for(spark, run_date, force_full)
    raw = spark.read.parquet(staged_path)
    lo = ntz_lit(start)
    # the day bounds are on the partition column: only the window's day
    # folders are listed and read
    part = raw.where(F.col(STAGE_DAY).between(F.to_date(lo), F.lit(run_date))
                     & (F.col("time") >= lo))
    return publish_days(product_frame(reconcile_staged(part)), product_path)
