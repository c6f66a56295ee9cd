"""The query catalogue: one Spark query per operator of the inventory, each
with an independent DuckDB oracle written in a different form.

Every query reads the driver's tables (through the fixture views, which only
shape rows) over their whole extent. Doubles are rounded to 6 decimals on both
sides, because the two engines sum in different orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixtures as fx
from ..operators.daily import daily_cell
from ..operators.spatial import assign_grid, nearest_raster, within_cells

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double/float column for a stable cross-engine compare."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


# ---------------------------------------------------------------------------
# oracle building blocks (DuckDB text)
# ---------------------------------------------------------------------------

OBS = f"obs AS ({fx.OBS_SQL})"
GRID = f"grid AS ({fx.GRID_SQL})"
RASTER = f"raster AS ({fx.RASTER_SQL})"
RUN_LOG = f"run_log AS ({fx.RUN_LOG_SQL})"

# Inside-test of the fixture's parallelogram cells in range form (oracle side).
IN_CELL = ("o.latitude > g.y0 AND o.latitude < g.y0 + g.h "
           "AND o.longitude > g.x0 + (o.latitude - g.y0) * g.shear / g.h "
           "AND o.longitude < g.x0 + g.w + (o.latitude - g.y0) * g.shear / g.h")

LOCATED = f"""located AS (
  SELECT o.obs_id, o.dataset_id, o.tow_id, o.profile_id, o.time, o.temperature, o.salinity,
         o.dissolved_oxygen, o.data_provider, o.fishery_dependent,
         g.id, g.centroid_lat AS latitude, g.centroid_lon AS longitude, g.stat_area, g.depth
  FROM obs o JOIN grid g ON {IN_CELL})"""


def sql(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _stats_sql(m: str, r: bool = True) -> str:
    if not r:
        return (f"avg({m}) AS {m}, min({m}) AS {m}_min, max({m}) AS {m}_max, "
                f"stddev_samp({m}) AS {m}_std, count({m}) AS {m}_count")
    return (f"round(avg({m}), 6) AS {m}, round(min({m}), 6) AS {m}_min, "
            f"round(max({m}), 6) AS {m}_max, round(stddev_samp({m}), 6) AS {m}_std, "
            f"count({m}) AS {m}_count")


def daily_cte(name: str = "d", src: str = "located", rounded_: bool = True) -> str:
    """A4 in SQL: ordered-aggregate 'first' and DISTINCT string_agg."""
    r = (lambda x: f"round({x}, 6)") if rounded_ else (lambda x: x)
    return f"""{name} AS (
SELECT CAST(time AS DATE) AS time, id AS grid_id,
  {r('first(latitude ORDER BY time, obs_id)')} AS latitude,
  {r('first(longitude ORDER BY time, obs_id)')} AS longitude,
  first(fishery_dependent ORDER BY time, obs_id) AS fishery_dependent,
  first(stat_area ORDER BY time, obs_id) AS stat_area,
  {r('first(depth ORDER BY time, obs_id)')} AS depth,
  {_stats_sql('temperature', rounded_)}, {_stats_sql('dissolved_oxygen', rounded_)},
  {_stats_sql('salinity', rounded_)},
  string_agg(DISTINCT data_provider, ', ' ORDER BY data_provider) AS data_provider
FROM {src} GROUP BY 1, 2)"""


def located(spark: SparkSession, sf: str) -> DataFrame:
    """obs with a grid cell (C11: J2 -> J4 -> P7)."""
    return assign_grid(fx.obs(spark, sf), fx.grid(spark, sf))


# ---------------------------------------------------------------------------
# flagship: A4 daily cell statistics over gridded observations
# ---------------------------------------------------------------------------

DAILY_CELL_SQL = sql([OBS, GRID, LOCATED, daily_cte()], "SELECT * FROM d")


@query("daily_cell", DAILY_CELL_SQL)
def q_daily_cell(spark, sf):
    """A4 over C11: daily mean/min/max/std/count per cell, providers, first flag."""
    return rounded(daily_cell(located(spark, sf), order=["time", "obs_id"]))


# ---------------------------------------------------------------------------
# J2 point in polygon, J1 nearest raster cell
# ---------------------------------------------------------------------------

@query("point_in_cell", sql([OBS, GRID], f"SELECT o.obs_id, g.id FROM obs o LEFT JOIN grid g ON {IN_CELL}"))
def q_point_in_cell(spark, sf):
    """Every observation with each cell that strictly contains it (left join)."""
    pts = fx.obs(spark, sf).select("obs_id", "latitude", "longitude")
    return within_cells(pts, fx.grid(spark, sf)).select("obs_id", "id")


def nearest_ctes(src: str, keys: list[str], p: str) -> list[str]:
    """Oracle CTEs ``{p}_nr(keys..., inferred_depth)``: the nearest raster
    value found by ranking every axis value per row (a different form from
    the Spark operator's candidate arithmetic)."""
    k = ", ".join(f"s.{c}" for c in keys)
    using = ", ".join(keys)
    return [
        f"""{p}_la AS (SELECT {using}, lat_idx FROM (
   SELECT {k}, a.lat_idx, row_number() OVER (PARTITION BY {k}
          ORDER BY abs(s.latitude - a.lat), a.lat DESC) AS rn
   FROM {src} s, (SELECT DISTINCT lat_idx, lat FROM raster) a
   WHERE s.latitude IS NOT NULL) WHERE rn = 1)""",
        f"""{p}_lo AS (SELECT {using}, lon_idx FROM (
   SELECT {k}, b.lon_idx, row_number() OVER (PARTITION BY {k}
          ORDER BY abs(s.longitude - b.lon), b.lon DESC) AS rn
   FROM {src} s, (SELECT DISTINCT lon_idx, lon FROM raster) b
   WHERE s.longitude IS NOT NULL) WHERE rn = 1)""",
        f"""{p}_nr AS (SELECT {using}, CAST(abs(r.elevation) AS INTEGER) AS inferred_depth
   FROM {p}_la JOIN {p}_lo USING ({using})
   LEFT JOIN raster r ON r.lat_idx = {p}_la.lat_idx AND r.lon_idx = {p}_lo.lon_idx)"""]


@query("raster_nearest", sql([OBS, RASTER, *nearest_ctes("obs", ["obs_id"], "n")],
                             "SELECT o.obs_id, n.inferred_depth FROM obs o LEFT JOIN n_nr n USING (obs_id)"))
def q_raster_nearest(spark, sf):
    """Depth of the nearest bathymetry cell for every observation."""
    pts = fx.obs(spark, sf).select("obs_id", "latitude", "longitude")
    return nearest_raster(pts, fx.raster(spark, sf)).select("obs_id", "inferred_depth")
