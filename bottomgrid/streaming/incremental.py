"""T2, incremental form: late rows merged as partial daily statistics.

Each micro-batch writes its own daily partials (A4 plus the order key of each
group's first row) into ``partials_root/delta/time=DAY/batch_id=N``;
overwriting those partitions makes a replayed batch idempotent. The days that
it touched are then published from the A7 merge of all their partials.

A day's deltas are folded into one base once there are ``fold_after`` of them,
so a day never has more than that, however many batches have touched it:

* ``base/time=DAY/upto=N`` holds the merge of the day's partials of all
  batches up to N. It counts once its ``_FOLDED`` marker is there.
* A reader takes the greatest marked base of a day and the deltas after its
  number, nothing else. So a crash anywhere between writing the base, marking
  it and removing what it replaces neither loses nor repeats a row: before the
  marker the deltas count, after it the base, and left-over folders are
  ignored until the day's next batch removes them.
* A batch that is replayed after its fold writes its deltas again; they are
  not above the base's number and are ignored.

A batch lists the folders of the days it touched, and no others. It costs its
own rows, plus one row per (day, cell) for the base and each open delta of
those days.

Batch numbers mean something only together with the stream's checkpoint: a
stream that starts over would count the same files again under other numbers.
So the partials table remembers the checkpoint it belongs to, and the stream
refuses to run with another one, or with partials whose checkpoint is gone.

The product here is by definition the merge of all stored partials, so a
touched day whose merged statistics no longer pass the gross-range test is
removed: an earlier batch may have published it. (T1 and the refresh replace
the days that a run has rows for and keep the others, like the daily job.)
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import epoch_day, narrow, with_metadata
from ..operators.daily import daily_cell, merge_daily
from ..operators.qc import gross_range
from ..session import checkpoint_dir, child_names, delete_path, path_exists, touch
from ..sinks.publish import publish_days
from ..sources.staged import reconcile_staged
from .publish_stream import MAX_FILES, MAX_LISTED_DAYS

FOLD_AFTER = 8  # deltas of one day that are folded into its base
MARKER = "_FOLDED"
EPOCH = dt.date(1970, 1, 1)


@dataclass(frozen=True)
class DayParts:
    """The folders of one day: its base, the deltas after it, and left-overs
    that a marked base replaces."""
    day: dt.date
    upto: int | None
    deltas: tuple[int, ...]
    stale: tuple[str, ...]


def _numbers(names: list[str], key: str) -> list[int]:
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{key}="))


def day_parts(spark: SparkSession, partials_root: str, day: dt.date) -> DayParts:
    """What is stored of one day, from a listing of its two folders."""
    base, delta = (f"{partials_root}/{k}/time={day.isoformat()}" for k in ("base", "delta"))
    bases = _numbers(child_names(spark, base), "upto")
    marked = [n for n in bases if path_exists(spark, f"{base}/upto={n}/{MARKER}")]
    upto = max(marked, default=None)
    deltas = _numbers(child_names(spark, delta), "batch_id")
    live = tuple(n for n in deltas if upto is None or n > upto)
    stale = [f"{base}/upto={n}" for n in marked if n != upto] + [f"{delta}/batch_id={n}" for n in deltas if n not in live]
    return DayParts(day, upto, live, tuple(stale))


def stage_batch_partials(rows: DataFrame, partials_root: str, batch_id: int,
                         order: list[str] | None = None) -> None:
    """Daily partials of one batch, written to its own ``batch_id`` partition
    of each day (dynamic overwrite: running the same batch again replaces it)."""
    order = order or [c for c in ("source_ord", "time", "tie") if c in rows.columns]
    parts = daily_cell(rows, order=order, keep_first_key=True).withColumn("batch_id", F.lit(int(batch_id)))
    (parts.hint("rebalance", "time").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy("time", "batch_id").parquet(f"{partials_root}/delta"))


def _read(spark: SparkSession, root: str, paths: list[str], number: str) -> DataFrame:
    df = spark.read.option("basePath", root).parquet(*paths)
    return df.withColumn("time", F.col("time").cast("date")).drop(number)


def partials_of(spark: SparkSession, partials_root: str, parts: list[DayParts]) -> DataFrame | None:
    """The stored partials of some days: each day's base and the deltas after
    it; only their folders are listed and read. None if there are none."""
    base = [f"{partials_root}/base/time={p.day.isoformat()}/upto={p.upto}" for p in parts if p.upto is not None]
    delta = [f"{partials_root}/delta/time={p.day.isoformat()}/batch_id={n}" for p in parts for n in p.deltas]
    frames = [_read(spark, f"{partials_root}/{k}", paths, number)
              for k, paths, number in (("base", base, "upto"), ("delta", delta, "batch_id")) if paths]
    if len(frames) == 2:
        return frames[0].unionByName(frames[1])
    return frames[0] if frames else None


def product_from_partials(parts: DataFrame) -> DataFrame:
    """A7 over stored partials, then the publishing steps of C13."""
    merged = merge_daily(parts, sort=False, first_key="_first").drop("_first")
    return with_metadata(narrow(gross_range(epoch_day(merged))))


def publish_from_partials(spark: SparkSession, partials_root: str, product_path: str,
                          parts: list[DayParts]) -> list[int]:
    """Re-publish some days from all their stored partials. Days that merge to
    nothing are removed from the product."""
    rows = partials_of(spark, partials_root, parts)
    written = set(publish_days(product_from_partials(rows), product_path)) if rows is not None else set()
    for d in (p.day for p in parts):
        n = (d - EPOCH).days
        if n not in written:
            delete_path(spark, f"{product_path}/year={d.year}/month={d.month}/time={n}")
    return sorted(written)


def write_base(spark: SparkSession, partials_root: str, parts: list[DayParts], upto: int) -> None:
    """The merge of the days' partials as ``upto=N`` (an unmarked folder that
    a crash left is replaced)."""
    merged = merge_daily(partials_of(spark, partials_root, parts), sort=False, first_key="_first")
    (merged.withColumn("upto", F.lit(int(upto))).hint("rebalance", "time")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("time", "upto").parquet(f"{partials_root}/base"))


def mark_base(spark: SparkSession, partials_root: str, day: dt.date, upto: int) -> None:
    touch(spark, f"{partials_root}/base/time={day.isoformat()}/upto={upto}/{MARKER}")


def remove_stale(spark: SparkSession, parts: list[DayParts]) -> None:
    for path in (s for p in parts for s in p.stale):
        delete_path(spark, path)


def fold(spark: SparkSession, partials_root: str, parts: list[DayParts], batch_id: int,
         fold_after: int = FOLD_AFTER) -> list[dt.date]:
    """Fold the days that have ``fold_after`` deltas or more, and remove what
    marked bases replace. Every step may be the last one before a crash."""
    full = [p for p in parts if len(p.deltas) >= fold_after]
    if full:
        write_base(spark, partials_root, full, batch_id)
        for p in full:
            mark_base(spark, partials_root, p.day, batch_id)
    folded = {p.day for p in full}
    remove_stale(spark, [day_parts(spark, partials_root, p.day) if p.day in folded else p for p in parts])
    return sorted(folded)


def day_lists(days: DataFrame, size: int) -> Iterator[list[dt.date]]:
    """The days of a one-column frame in lists of at most ``size``; the driver
    holds one list at a time."""
    it = (r[0] for r in days.toLocalIterator())
    while part := list(islice(it, size)):
        yield part


def owner_path(partials_root: str) -> str:
    """Which checkpoint the partials belong to (kept beside the table)."""
    return partials_root.rstrip("/") + "_checkpoint"


def _claim(spark: SparkSession, partials_root: str, checkpoint: str) -> None:
    own = owner_path(partials_root)
    if path_exists(spark, own):
        was = spark.read.parquet(own).first()["checkpoint"]
        if was != checkpoint:
            raise ValueError(f"the partials in {partials_root} belong to the stream checkpoint {was}")
        if path_exists(spark, partials_root) and not path_exists(spark, f"{checkpoint}/metadata"):
            raise ValueError(f"the checkpoint {checkpoint} of the partials in {partials_root} is gone: "
                             "start with an empty partials table, or its rows would count twice")
        return
    if path_exists(spark, partials_root):
        raise ValueError(f"the partials in {partials_root} belong to no known stream checkpoint")
    spark.createDataFrame([(checkpoint,)], "checkpoint string").write.parquet(own)


def incremental_stream(spark: SparkSession, staged_path: str, partials_root: str,
                       product_path: str, checkpoint: str, available_now: bool = True,
                       max_files: int = MAX_FILES, fold_after: int = FOLD_AFTER) -> StreamingQuery:
    """T2 as a stream over the staged folder: per batch of at most
    ``max_files`` files, stage its partials (idempotent by batch id), publish
    the days it touched, then fold those of them that have many deltas.
    ``checkpoint`` has no default: it and the partials table live and die
    together."""
    _claim(spark, partials_root, checkpoint)
    checkpoint_dir(spark)
    schema = spark.read.parquet(staged_path).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(staged_path)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        rows = reconcile_staged(batch)
        days = (rows.where(F.col("id").isNotNull() & F.col("time").isNotNull())
                .select(F.to_date("time").alias("day")).distinct().checkpoint())
        stage_batch_partials(rows, partials_root, batch_id)
        for some in day_lists(days, MAX_LISTED_DAYS):
            parts = [day_parts(session, partials_root, d) for d in some]
            publish_from_partials(session, partials_root, product_path, parts)
            fold(session, partials_root, parts, batch_id, fold_after)

    w = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
