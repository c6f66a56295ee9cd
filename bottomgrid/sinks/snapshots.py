"""K4: archive snapshots that copy only the days published anew.

A day's version is a fingerprint of its data files' names and sizes, taken
from a listing (publishing a day gives its files new names). The snapshot of a
date is a manifest with one row per day of the product: the day, its version,
its bytes, and the folder under ``archive_root/days`` that holds a copy of that
version, stamped with version, archive time, doi and citation URL. Days whose
version the last snapshot has are listed with its folder; the others are copied
into a new one, without a shuffle (the product lies by day already). A folder is never
written again, and the manifest is written last: a run that ends half way
leaves a folder that no manifest names.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import ntz_lit
from ..operators.sizing import broadcast_if_small
from ..session import checkpoint_dir, child_names, path_exists

# Day lists up to this size become a static filter on the partition column.
MAX_LISTED_DAYS = 10_000
_PART = [("year", "int"), ("month", "int"), ("time", "int")]


def citation_url(doi: str | None) -> str:
    return f"https://zenodo.org/records/{doi.split('.')[-1]}" if doi else ""


def day_versions(spark: SparkSession, product_path: str) -> DataFrame:
    """(year, month, time, day_version, bytes) of every published day; no
    data file is opened."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(product_path).select("path", "length"))
    keys = [F.regexp_extract("path", f"/{c}=(-?[0-9]+)/", 1).cast(k).alias(c) for c, k in _PART]
    name = F.concat(F.element_at(F.split("path", "/"), -1), F.lit(":"), F.col("length").cast("string"))
    return files.select(*keys, name.alias("name"), "length").groupBy("year", "month", "time").agg(
        F.sha2(F.array_join(F.array_sort(F.collect_list("name")), ","), 256).alias("day_version"),
        F.sum("length").alias("bytes"))


def _committed(spark: SparkSession, snapshot: str) -> list[str]:
    return [f"{snapshot}/{n}" for n in child_names(spark, snapshot)
            if n.startswith("manifest=") and path_exists(spark, f"{snapshot}/{n}/_SUCCESS")]


def manifest(spark: SparkSession, snapshot: str) -> DataFrame:
    """The days of a snapshot (the last one written for its date)."""
    have = _committed(spark, snapshot)
    if not have:
        raise ValueError(f"no snapshot in {snapshot}")
    return spark.read.parquet(have[-1])


def last_manifest(spark: SparkSession, archive_root: str) -> DataFrame | None:
    for name in reversed([n for n in child_names(spark, archive_root) if n.startswith("archive_date=")]):
        if _committed(spark, f"{archive_root}/{name}"):
            return manifest(spark, f"{archive_root}/{name}")
    return None


def archive(spark: SparkSession, product_path: str, archive_root: str, version: str,
            when: dt.datetime, doi: str | None = "") -> tuple[str, float]:
    """K4: snapshot the whole previous product as ``archive_root/
    archive_date=YYYY-MM-DD``. Must run before K3 replaces any day. Returns
    the snapshot's path and the size of the whole of it in MB. A second
    snapshot on one date takes the place of the first."""
    snap = f"{archive_root}/archive_date={when.date().isoformat()}"
    now = day_versions(spark, product_path)
    last = last_manifest(spark, archive_root)
    if last is not None:
        now = now.join(last.select("time", "day_version", "folder"), ["time", "day_version"], "left")
    else:
        now = now.withColumn("folder", F.lit(None).cast("string"))
    checkpoint_dir(spark)
    now = now.checkpoint()      # one row per day; the product must not be listed twice
    changed = now.where("folder IS NULL").select("time")
    n = changed.count()
    number = f"{len(child_names(spark, snap)) + 1:06d}"
    folder = f"copied={when.date().isoformat()}.{number}"
    if n:
        rows = spark.read.parquet(product_path)
        if n <= MAX_LISTED_DAYS:
            rows = rows.where(F.col("time").isin([r["time"] for r in changed.collect()]))
        else:
            days, _ = broadcast_if_small(changed, n, 16)
            rows = rows.join(days, "time", "left_semi")
        rows.write.mode("overwrite").partitionBy("year", "month", "time").parquet(f"{archive_root}/days/{folder}")
    stamps = {"folder": F.coalesce("folder", F.lit(folder)), "version": F.lit(version), "archive_time": ntz_lit(when),
              "doi": F.lit(doi or ""), "citation_url": F.lit(citation_url(doi))}
    (now.withColumns(stamps).coalesce(1).write.mode("overwrite").parquet(f"{snap}/manifest={number}"))
    size = now.agg(F.sum("bytes")).first()[0] or 0
    return snap, round(size / (1024 * 1024), 1)


def read_snapshot(spark: SparkSession, snapshot: str) -> DataFrame:
    """The whole product as it was when the snapshot was taken, with its
    stamps. Only the folders that its manifest names are listed."""
    days = manifest(spark, snapshot).withColumnRenamed("folder", "_folder").withColumnRenamed("time", "_day")
    root = snapshot.rstrip("/").rsplit("/", 1)[0] + "/days"
    sizes = {r["_folder"]: r["n"] for r in days.groupBy("_folder").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        raise ValueError(f"the snapshot {snapshot} has no days")
    rows = spark.read.option("basePath", root).option("mergeSchema", "true").parquet(*[f"{root}/{f}" for f in sorted(sizes)])
    listed = days.select("_folder", "_day", "version", "archive_time", "doi", "citation_url")
    listed, _ = broadcast_if_small(listed, sum(sizes.values()), 256)
    here = F.concat(F.lit("copied="), F.col("copied").cast("string")) == F.col("_folder")
    return rows.join(listed, here & (F.col("time") == F.col("_day"))).drop("copied", "_folder", "_day")
