"""Append-only log tables: run log (K2) and diagnostics (K6)."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import ntz_lit, utc_naive
from ..schemas import DIAG_SCHEMA, RUN_LOG_SCHEMA
from ..session import checkpoint_dir, path_exists


def run_log_rows(counts: DataFrame, runtime: dt.datetime, version: str, reload_type: str,
                 statuses: dict[str, str] | None = None, providers: dict[str, str] | None = None,
                 protocol: str = "tabledap", doi: str = "", elapsed: float = 0.0,
                 protocols: dict[str, str] | None = None) -> DataFrame:
    """K2 rows from A8's per-feed counts: one row per feed with the run
    stamp, the outcome flag (1 = fetched from the registry and scanned, 0 =
    missing, failed or side-loaded), the provider group, the protocol, doi and
    elapsed seconds. The per-feed settings are a small table (one row per
    registered feed) joined to the counts."""
    spark = counts.sparkSession
    out = counts
    if statuses:
        meta = [(k, 1 if v == "ok" else 0, (providers or {}).get(k),
                 (protocols or {}).get(k, protocol)) for k, v in statuses.items()]
        st = spark.createDataFrame(meta, "dataset_id string, fetch_erddap_success int, "
                                         "_prov string, _proto string")
        out = out.join(st, "dataset_id", "full")
    else:
        out = (out.withColumn("fetch_erddap_success", F.lit(1))
                  .withColumn("_prov", F.lit(None).cast("string")).withColumn("_proto", F.lit(protocol)))
    out = out.select(
        "dataset_id",
        F.coalesce("observation_count", F.lit(0)).cast("bigint").alias("observation_count"),
        F.coalesce("post_filter_count", F.lit(0)).cast("bigint").alias("post_filter_count"),
        ntz_lit(runtime).alias("runtime"),
        F.lit(version).alias("version"), F.col("_prov").alias("data_provider"),
        F.coalesce(F.col("_proto"), F.lit(protocol)).alias("file_protocol"),
        F.lit(reload_type).alias("reload_type"),
        F.coalesce("fetch_erddap_success", F.lit(0)).cast("int").alias("fetch_erddap_success"),
        F.lit(float(elapsed)).alias("execution_time_seconds"), F.lit(doi).alias("doi"))
    return out.select(*[F.col(f.name).cast(f.dataType) for f in RUN_LOG_SCHEMA.fields])


RUN_ID = "run_id"


def append_once(rows: DataFrame, path: str, run_id: str | None, keys: list[str]) -> None:
    """Append the rows that the table does not have yet under this run id: a
    retried job gives the id of its first try and adds only what that one did
    not write. Without an id every call is a run of its own. Tables written
    before there were run ids are read on."""
    spark = rows.sparkSession
    new = rows.withColumn(RUN_ID, F.lit(run_id or uuid.uuid4().hex))
    if run_id and path_exists(spark, path):
        have = spark.read.option("mergeSchema", "true").parquet(path)
        if RUN_ID in have.columns:
            have = have.where(F.col(RUN_ID) == run_id).select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
            same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
            checkpoint_dir(spark)
            new = new.join(have, reduce(lambda a, b: a & b, same), "left_anti").checkpoint()
            if new.isEmpty():
                return
    new.write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """A log table without its run ids, also where older files have none."""
    return spark.read.option("mergeSchema", "true").parquet(path).drop(RUN_ID)


def append_run_log(rows: DataFrame, path: str, run_id: str | None = None) -> None:
    """K2: append to the run-log table, once per run and feed."""
    append_once(rows, path, run_id, ["dataset_id"])


def append_quarantine(spark: SparkSession, set_aside: list[tuple[str, str, str]], runtime: dt.datetime, path: str,
                      run_id: str | None = None) -> None:
    """Files that a run could not read: (feed, file, error), once per run."""
    rows = spark.createDataFrame(set_aside, "dataset_id string, file string, error string")
    append_once(rows.withColumn("runtime", ntz_lit(runtime)), path, run_id, ["dataset_id", "file"])


def diagnostics_rows(spark: SparkSession, runtime: dt.datetime, program: str, version: str,
                     total_seconds: float, phases: dict[str, float],
                     files_created: int | None = None) -> DataFrame:
    """K6 row: per-phase seconds as a map, serialised to JSON by Spark."""
    src = spark.createDataFrame(
        [(utc_naive(runtime), program, version, float(total_seconds),
          {k: float(v) for k, v in phases.items()}, files_created)],
        T.StructType([
            T.StructField("runtime", T.TimestampNTZType()), T.StructField("program", T.StringType()),
            T.StructField("version", T.StringType()),
            T.StructField("total_execution_seconds", T.DoubleType()),
            T.StructField("phases", T.MapType(T.StringType(), T.DoubleType())),
            T.StructField("nc_files_created", T.IntegerType())]))
    return src.select("runtime", "program", "version", "total_execution_seconds",
                      F.to_json("phases").alias("phase_durations"), "nc_files_created")


def append_diagnostics(rows: DataFrame, path: str, upstream: DataFrame | None = None,
                       run_id: str | None = None) -> None:
    """K6: upstream rows first, then our own, appended once per run and
    program."""
    out = rows if upstream is None else upstream.select(*DIAG_SCHEMA.names).unionByName(rows)
    append_once(out, path, run_id, ["program"])
