"""Queries for the feed standardizers (C1–C10). Each feed's input is the obs
view shaped to that feed's landed schema; the chain itself is the library's."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import fixtures as fx
from .catalog_ops import INSTITUTION, INSTITUTION_CASE
from .queries import GRID, LOCATED, OBS, RASTER, located, nearest_ctes, query, rounded, sql
from ..operators.union import union_feeds
from .standardize import Dims, standardize

STD_OUT = ("time, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, "
           "round(temperature, 6) AS temperature, round(salinity, 6) AS salinity, "
           "round(dissolved_oxygen, 6) AS dissolved_oxygen, data_provider, fishery_dependent")


def _dims(spark, sf) -> Dims:
    return Dims(grid=fx.grid(spark, sf), raster=fx.raster(spark, sf))


def _tagged(provider: str, flag: int, salinity: str = "CAST(NULL AS DOUBLE)",
            oxygen: str = "CAST(NULL AS DOUBLE)") -> str:
    return (f"'{provider}' AS data_provider, {flag} AS fishery_dependent, {salinity} AS salinity, "
            f"{oxygen} AS dissolved_oxygen")


# C1 ------------------------------------------------------------------------

@query("std_emolt_rt", sql([OBS, RASTER, """h AS (
  SELECT CAST(tow_id AS VARCHAR) AS tow_id, date_trunc('hour', time) AS time, avg(latitude) AS latitude,
    avg(longitude) AS longitude, avg(temperature) AS temperature, avg(depth) AS depth
  FROM obs WHERE tow_id IS NOT NULL GROUP BY 1, 2
  HAVING NOT (avg(latitude) IS NULL AND avg(longitude) IS NULL AND avg(temperature) IS NULL
              AND avg(depth) IS NULL))""", *nearest_ctes("h", ["tow_id", "time"], "n"),
                           f"""s AS (SELECT h.time, h.latitude, h.longitude, h.temperature,
    {_tagged('eMOLT', 1)} FROM h JOIN n_nr n USING (tow_id, time)
  WHERE h.depth IS NOT NULL AND n.inferred_depth IS NOT NULL AND h.depth - n.inferred_depth < 20)"""],
                           f"SELECT {STD_OUT} FROM s"))
def q_std_emolt_rt(spark, sf):
    """Hourly mean per tow -> nearest seabed depth -> seabed check -> tags."""
    src = fx.obs(spark, sf).select("time", "latitude", "longitude", "temperature",
                                   F.col("tow_id").cast("string").alias("tow_id"), "depth")
    return rounded(standardize("eMOLT_RT", src, _dims(spark, sf)))


# C2 ------------------------------------------------------------------------

@query("std_emolt_lowell", sql([OBS, """d0 AS (
  SELECT obs_id, time, latitude, longitude, temperature, dissolved_oxygen AS do_v,
    CAST(tow_id AS VARCHAR) AS tow_id FROM obs WHERE dissolved_oxygen > 0)""", """d1 AS (
  SELECT * FROM (SELECT *, avg(do_v) OVER (PARTITION BY tow_id) AS mu,
      stddev_samp(do_v) OVER (PARTITION BY tow_id) AS sd FROM d0)
  WHERE NOT (tow_id IS NOT NULL AND coalesce(abs(do_v - mu) > 3 * sd, false)))""", """d2 AS (
  SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY tow_id) AS n FROM d1)
  WHERE tow_id IS NOT NULL AND n >= 10)""", """d3 AS (
  SELECT *, list_sort(list_resize(list(do_v) OVER (PARTITION BY tow_id ORDER BY time, obs_id
      ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 5, 0.0))[3] AS do_f FROM d2)""", f"""h AS (
  SELECT tow_id, date_trunc('hour', time) AS time, avg(latitude) AS latitude, avg(longitude) AS longitude,
    avg(temperature) AS temperature, avg(do_f) AS do_f FROM d3 GROUP BY 1, 2)""", f"""s AS (
  SELECT time, latitude, longitude, temperature, {_tagged('eMOLT', 1, oxygen='do_f')}
  FROM h WHERE do_f > 0)"""], f"SELECT {STD_OUT} FROM s"))
def q_std_emolt_lowell(spark, sf):
    """DO > 0 -> 3-sigma per tow -> tows >= 10 rows -> 5-point running
    median of DO -> hourly mean -> DO > 0 -> tags."""
    src = fx.obs(spark, sf).select("obs_id", "time", "latitude", "longitude", "temperature",
                                   F.col("dissolved_oxygen").alias("DO"),
                                   F.col("tow_id").cast("string").alias("tow_id"))
    return rounded(standardize("eMOLT_RT_LOWELL", src, _dims(spark, sf), tie="obs_id"))


# C3 ------------------------------------------------------------------------

def _profiles_sql(flag: int) -> str:
    return sql([OBS, RASTER, """p AS (
  SELECT obs_id, time, latitude, longitude, temperature, salinity, depth AS sea_pressure FROM (
    SELECT *, row_number() OVER (PARTITION BY profile_id ORDER BY depth DESC, obs_id) AS rn
    FROM obs WHERE profile_id IS NOT NULL AND depth IS NOT NULL) WHERE rn = 1)""",
                *nearest_ctes("p", ["obs_id"], "n"), f"""s AS (
  SELECT p.time, p.latitude, p.longitude, p.temperature, {_tagged('CFRF', flag, salinity='p.salinity')}
  FROM p JOIN n_nr n USING (obs_id)
  WHERE p.sea_pressure IS NOT NULL AND n.inferred_depth IS NOT NULL
    AND p.sea_pressure - n.inferred_depth < 20)"""], f"SELECT {STD_OUT} FROM s")


def _profiles_src(spark, sf):
    return fx.obs(spark, sf).select(
        "obs_id", "time", "latitude", "longitude",
        F.col("temperature").alias("conservative_temperature"), F.col("depth").alias("sea_pressure"),
        "profile_id", F.col("salinity").alias("absolute_salinity"))


@query("std_shelf_profiles", _profiles_sql(1))
def q_std_shelf_profiles(spark, sf):
    """C3 (shelf fleet, flag 1): deepest bin per profile -> seabed check."""
    return rounded(standardize("shelf_fleet_profiles_1m_binned", _profiles_src(spark, sf),
                               _dims(spark, sf), tie="obs_id"))


@query("std_wind_profiles", _profiles_sql(0))
def q_std_wind_profiles(spark, sf):
    """C3 (wind farm, flag 0)."""
    return rounded(standardize("wind_farm_profiles_1m_binned", _profiles_src(spark, sf),
                               _dims(spark, sf), tie="obs_id"))


# C4, C5 --------------------------------------------------------------------

@query("std_fixed_gear", sql([OBS, f"""s AS (
  SELECT time, latitude, longitude, temperature, {_tagged('CFRF', 1, oxygen='dissolved_oxygen')} FROM (
    SELECT *, avg(dissolved_oxygen) OVER (PARTITION BY tow_id) AS mu,
      stddev_samp(dissolved_oxygen) OVER (PARTITION BY tow_id) AS sd FROM obs)
  WHERE NOT (tow_id IS NOT NULL AND coalesce(abs(dissolved_oxygen - mu) > 3 * sd, false)))"""],
                             f"SELECT {STD_OUT} FROM s"))
def q_std_fixed_gear(spark, sf):
    """C4: 3-sigma oxygen outliers per tow removed -> tags."""
    src = fx.obs(spark, sf).select("time", "latitude", "longitude", "temperature",
                                   "dissolved_oxygen", "tow_id")
    return rounded(standardize("fixed_gear_oceanography", src, _dims(spark, sf)))


@query("std_receivers", sql([OBS, f"""s AS (SELECT time, latitude, longitude, temperature,
  {_tagged('CFRF', 0)} FROM obs)"""], f"SELECT {STD_OUT} FROM s"))
def q_std_receivers(spark, sf):
    """Tags only."""
    src = fx.obs(spark, sf).select("time", "latitude", "longitude",
                                   F.col("dataset_id").alias("station_id"), "temperature")
    return rounded(standardize("wind_farm_acoustic_receivers", src, _dims(spark, sf)))


# C6, C7 --------------------------------------------------------------------

# profile numbers of a cruise; some are missing
PROFILE_NO = "CASE WHEN obs_id % 97 = 0 THEN NULL ELSE CAST(obs_id % 211 AS INT) END"


@query("std_oleander", sql([OBS, RASTER, f"""k AS (
  SELECT *, concat_ws('_', coalesce(dataset_id, 'nan'), coalesce(CAST(profile_no AS VARCHAR), 'nan')) AS pkey
  FROM (SELECT *, {PROFILE_NO} AS profile_no FROM obs))""", """p AS (
  SELECT obs_id, time, latitude, longitude, temperature, depth FROM (
    SELECT *, row_number() OVER (PARTITION BY pkey ORDER BY depth DESC, obs_id) AS rn
    FROM k WHERE depth IS NOT NULL) WHERE rn = 1)""", *nearest_ctes("p", ["obs_id"], "n"), f"""s AS (
  SELECT p.time, p.latitude, p.longitude, p.temperature, {_tagged('Oleander', 0)}
  FROM p JOIN n_nr n USING (obs_id)
  WHERE p.depth IS NOT NULL AND n.inferred_depth IS NOT NULL AND p.depth - n.inferred_depth < 20)"""],
                           f"SELECT {STD_OUT} FROM s"))
def q_std_oleander(spark, sf):
    """Rename -> profile key (cruise, profile number) -> deepest ->
    nearest seabed depth -> seabed check -> tags."""
    src = fx.obs(spark, sf).select("obs_id", "time", "latitude", "longitude",
                                   F.col("temperature").alias("temp"), "depth",
                                   F.expr(PROFILE_NO).alias("profile_number"),
                                   F.col("dataset_id").alias("cruise_num"))
    return rounded(standardize("oleanderXbt", src, _dims(spark, sf), tie="obs_id"))


@query("std_ecomon", sql([OBS, RASTER, f"""k AS (
  SELECT *, concat_ws('_', coalesce(dataset_id, 'nan'), coalesce(CAST(profile_no AS VARCHAR), 'nan')) AS pkey
  FROM (SELECT *, {PROFILE_NO} AS profile_no FROM obs) o WHERE dissolved_oxygen IS NULL OR dissolved_oxygen > 0)""", """p AS (
  SELECT obs_id, time, latitude, longitude, temperature, salinity, dissolved_oxygen, depth FROM (
    SELECT *, row_number() OVER (PARTITION BY pkey ORDER BY depth DESC, obs_id) AS rn
    FROM k WHERE depth IS NOT NULL) WHERE rn = 1)""", *nearest_ctes("p", ["obs_id"], "n"), f"""s AS (
  SELECT p.time, p.latitude, p.longitude, p.temperature,
    {_tagged('ECOMON', 0, salinity='p.salinity', oxygen='p.dissolved_oxygen')}
  FROM p JOIN n_nr n USING (obs_id)
  WHERE p.depth IS NOT NULL AND n.inferred_depth IS NOT NULL AND p.depth - n.inferred_depth < 20)"""],
                         f"SELECT {STD_OUT} FROM s"))
def q_std_ecomon(spark, sf):
    """Renames -> profile key (cruise, cast) -> oxygen missing or > 0 ->
    deepest by pressure -> nearest seabed depth -> seabed check -> tags."""
    src = fx.obs(spark, sf).select("obs_id", "time", "latitude", "longitude",
                                   F.col("temperature").alias("sea_water_temperature"),
                                   F.col("depth").alias("pressure_dbars"), "dissolved_oxygen",
                                   F.col("salinity").alias("sea_water_salinity"),
                                   F.expr(PROFILE_NO).alias("cast_number"),
                                   F.col("dataset_id").alias("cruise_id"))
    return rounded(standardize("ocdbs_v_erddap1", src, _dims(spark, sf), tie="obs_id"))


# C8, C9, C10 ---------------------------------------------------------------

@query("std_ooi", sql([OBS, f"""s AS (
  SELECT dataset_id, date_trunc('hour', time) AS time, avg(latitude) AS latitude,
    avg(longitude) AS longitude, avg(temperature) AS temperature,
    {_tagged('OOI', 0, salinity='avg(salinity)', oxygen='avg(dissolved_oxygen * 0.0328)')}
  FROM obs GROUP BY dataset_id, date_trunc('hour', time))"""], f"SELECT dataset_id, {STD_OUT} FROM s"))
def q_std_ooi(spark, sf):
    """Molar oxygen -> mg/L -> renames -> hourly mean per station -> tags."""
    from .standardize import OOI_OXYGEN, std_ooi
    src = fx.obs(spark, sf).select("dataset_id", "time", "latitude", "longitude",
                                   F.col("temperature").alias("sea_water_temperature"),
                                   F.col("salinity").alias("sea_water_practical_salinity"),
                                   F.col("dissolved_oxygen").alias(OOI_OXYGEN))
    return rounded(std_ooi(src, _dims(spark, sf)))




@query("std_gliders", sql([OBS, GRID, LOCATED, f"""s AS (
  SELECT l.time, g.centroid_lat AS latitude, g.centroid_lon AS longitude, l.temperature,
    CASE {INSTITUTION} {INSTITUTION_CASE} ELSE 'glider_other' END AS data_provider, 0 AS fishery_dependent,
    l.salinity, l.dissolved_oxygen
  FROM located l LEFT JOIN grid g ON g.id = l.id
  WHERE l.dissolved_oxygen IS NULL OR l.dissolved_oxygen > 0)"""], f"SELECT {STD_OUT} FROM s"))
def q_std_gliders(spark, sf):
    """Institution -> provider code -> oxygen missing or > 0 -> cell
    attributes by the feed's grid id -> flag 0."""
    src = located(spark, sf).select("time", F.col("id").alias("grid_id"), "temperature",
                                    "salinity", "dissolved_oxygen",
                                    F.expr(INSTITUTION).alias("institution"))
    return rounded(standardize("demersal_gliders_aggregated", src, _dims(spark, sf)))


@query("std_unknown", sql([OBS, f"""s AS (SELECT time, latitude, longitude, temperature,
  {_tagged('CFRF', 0)} FROM obs)"""], f"SELECT {STD_OUT} FROM s"))
def q_std_unknown(spark, sf):
    """Of two feeds over the same observations, the one without a
    standardizer adds nothing to the union of the standard rows."""
    src = fx.obs(spark, sf).select("time", "latitude", "longitude",
                                   F.col("dataset_id").alias("station_id"), "temperature")
    known = standardize("wind_farm_acoustic_receivers", src, _dims(spark, sf))
    return rounded(union_feeds([known, standardize("not_registered", src, _dims(spark, sf))]))
