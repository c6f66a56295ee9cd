"""Observation-shaped views over the driver's test tables.

These only give rows in the schemas the operators expect (FIXTURES.md §2);
they do none of the operators' work. The same expression text is used for
the Spark DataFrames and for the DuckDB oracle CTEs, so both engines see the
same input. ``raster`` uses every order key, so it grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sizing import spread_small_input

OBS_EXPRS = [
    "event_id AS obs_id",
    "event_type AS dataset_id",
    "CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_id % 7 END AS tow_id",
    "concat(CAST(user_id AS STRING), '_', event_type) AS profile_id",
    "ts AS time",
    "36e0 + ((user_id * 7919 + event_id % 3) % 10000) / 1e3 AS latitude",
    "-76e0 + ((user_id * 104729 + event_id % 3) % 12000) / 1e3 AS longitude",
    "value * 5e-1 AS temperature",
    "CASE WHEN event_id % 5 = 0 THEN NULL ELSE 3e1 + (event_id % 900) / 1e2 END AS salinity",
    "CASE WHEN event_id % 7 = 0 THEN NULL ELSE value - 1e0 END AS dissolved_oxygen",
    "5e0 + (event_id % 400) AS depth",
    "event_type AS data_provider",
    "CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END AS fishery_dependent",
]

GRID_INNER = (
    "SELECT p_partkey AS id, "
    "-7600037e-5 + (p_partkey % 40) * 3e-1 + CAST(floor(p_partkey / 40) AS BIGINT) * 1e-2 AS x0, "
    "3600041e-5 + CAST(floor(p_partkey / 40) AS BIGINT) * 2e-1 AS y0 FROM part"
)
GRID_EXPRS = [
    "id", "x0", "y0", "3e-1 AS w", "2e-1 AS h", "1e-2 AS shear",
    "x0 + 155e-3 AS centroid_lon", "y0 + 1e-1 AS centroid_lat",
    "500 + id % 40 AS stat_area", "CAST(id * 13 % 1000 AS DOUBLE) AS depth",
]

RASTER_EXPRS = [
    "lat_idx", "lon_idx", "36e0 + lat_idx * 1e-1 AS lat", "-76e0 + lon_idx * 1e-1 AS lon",
    "20 - (lat_idx * 37 + lon_idx * 11) % 600 AS elevation",
]
RASTER_INNER = ("SELECT CAST(floor(o_orderkey / 120) AS BIGINT) AS lat_idx, "
                "o_orderkey % 120 AS lon_idx FROM orders")

RUN_LOG_EXPRS = [
    "o_orderdate AS runtime",
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'full' WHEN '2-HIGH' THEN 'quarterly' "
    "WHEN '3-MEDIUM' THEN 'bi-weekly' ELSE 'daily' END AS reload_type",
    "o_orderkey AS run_id",
]

# SQL text of the same views, for oracle CTEs.
OBS_SQL = "SELECT " + ", ".join(OBS_EXPRS) + " FROM events"
GRID_SQL = "SELECT " + ", ".join(GRID_EXPRS) + f" FROM ({GRID_INNER}) c"
RASTER_SQL = "SELECT " + ", ".join(RASTER_EXPRS) + f" FROM ({RASTER_INNER}) b"
RUN_LOG_SQL = "SELECT " + ", ".join(RUN_LOG_EXPRS) + " FROM orders"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the driver's files are single row groups: spread them over the cores
    return spread_small_input(table(spark, sf_dir, "events")).selectExpr(*OBS_EXPRS)


def grid_corners(spark: SparkSession, sf_dir: str) -> DataFrame:
    inner = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS id",
        "-7600037e-5 + (p_partkey % 40) * 3e-1 + CAST(floor(p_partkey / 40) AS BIGINT) * 1e-2 AS x0",
        "3600041e-5 + CAST(floor(p_partkey / 40) AS BIGINT) * 2e-1 AS y0")
    return inner.selectExpr(*GRID_EXPRS)


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid cells in the engine's grid schema: a closed ring per cell."""
    c = grid_corners(spark, sf_dir)
    pt = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    x0, y0, w, h, s = (F.col(n) for n in ("x0", "y0", "w", "h", "shear"))
    ring = F.array(pt(x0, y0), pt(x0 + w, y0), pt(x0 + w + s, y0 + h),
                   pt(x0 + s, y0 + h), pt(x0, y0))
    return c.select(F.col("id").cast("bigint").alias("id"), ring.alias("ring"),
                    F.col("stat_area").cast("bigint").alias("stat_area"), "depth",
                    "centroid_lon", "centroid_lat")


def raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    inner = table(spark, sf_dir, "orders").selectExpr(
        "CAST(floor(o_orderkey / 120) AS BIGINT) AS lat_idx", "o_orderkey % 120 AS lon_idx")
    return inner.selectExpr(*RASTER_EXPRS)


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*RUN_LOG_EXPRS)
