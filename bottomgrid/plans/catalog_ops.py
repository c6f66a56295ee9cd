"""Queries for scans, projections, filters, joins, aggregations, windows,
set operations and the refresh calendar (each with a DuckDB oracle)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from . import fixtures as fx
from .queries import (GRID, LOCATED, OBS, RASTER, RUN_LOG, IN_CELL, _stats_sql, daily_cte,
                      located, nearest_ctes, query, rounded, sql)
from ..functions.calendar import refresh_window
from ..functions.columns import epoch_day, narrow, profile_key, scale, tag, to_standard, with_metadata
from ..operators.daily import daily_cell, daily_cell_precounted, merge_daily
from ..operators.lookup import INSTITUTION_CODES, map_default
from ..operators.qc import (drop_outliers, gross_range, min_group_size, missing_or_positive,
                            positive, retention_curve, running_median, seabed_check)
from ..operators.reduce import deepest, hourly_by_station, hourly_mean
from ..operators.runlog import feed_counts, last_full_run, latest_run
from ..operators.spatial import (albers_xy, attach_cell, drop_unlocated, nearest_centroid,
                                 nearest_raster, once_per_key, within_cells)
from ..operators.union import distinct_positions, union_feeds, union_with_sideloads
from ..sources.feeds import apply_constraints, normalize_scan, time_window
from ..sources.staged import reconcile, recent

DAILY_COLS = ("time, grid_id, latitude, longitude, fishery_dependent, stat_area, depth, "
              "temperature, temperature_min, temperature_max, temperature_std, temperature_count, "
              "dissolved_oxygen, dissolved_oxygen_min, dissolved_oxygen_max, dissolved_oxygen_std, "
              "dissolved_oxygen_count, salinity, salinity_min, salinity_max, salinity_std, "
              "salinity_count, data_provider")


def product(spark, sf):
    """A4 over the gridded fixture, unrounded (input of product queries)."""
    return daily_cell(located(spark, sf), order=["time", "obs_id"])


# ---------------------------------------------------------------------------
# scans and projections
# ---------------------------------------------------------------------------

SCAN_LO, SCAN_HI = "2024-01-05 00:00:00", "2024-01-20 12:00:00"


@query("scan_constraints", sql([OBS], f"""
SELECT obs_id, time, round(salinity, 6) AS salinity, data_provider FROM obs
WHERE salinity > 31 AND salinity < 38 AND data_provider IS DISTINCT FROM 'error'
  AND time >= TIMESTAMP '{SCAN_LO}' AND time <= TIMESTAMP '{SCAN_HI}'"""))
def q_scan_constraints(spark, sf):
    """S2 + S3: declarative constraints (``!=`` keeps NULL) and the window."""
    o = apply_constraints(fx.obs(spark, sf), {"salinity>": 31, "salinity<": 38,
                                               "data_provider!=": "error"})
    o = time_window(o, dt.datetime.fromisoformat(SCAN_LO), dt.datetime.fromisoformat(SCAN_HI))
    return rounded(o.select("obs_id", "time", "salinity", "data_provider"))


@query("scan_normalize", """
SELECT event_id, ts AS time, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
  round(value, 6) AS temperature, CAST(NULL AS DOUBLE) AS salinity,
  CAST(NULL AS DOUBLE) AS dissolved_oxygen, 'CFRF' AS data_provider, 0 AS fishery_dependent
FROM events""")
def q_scan_normalize(spark, sf):
    """S4 + P1 + P2: unit-suffixed headers, a text time with a zone suffix,
    renamed time column -> standard columns with tags."""
    ev = fx.table(spark, sf, "events")
    landed = ev.select(
        F.col("event_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts (UTC)"),
        F.col("value").alias("temperature (degree_C)"),
        F.col("user_id").alias("station_id"))
    n = normalize_scan(landed, ["event_id", "ts", "temperature", "station_id"], time_col="ts")
    return rounded(to_standard(tag(n, "CFRF", 0), keep=["event_id"]))


@query("reconcile_schema", sql([OBS, GRID, LOCATED], """
SELECT date_trunc('second', time) AS time, round(latitude, 6) AS latitude,
  round(longitude, 6) AS longitude, round(temperature, 6) AS temperature, data_provider,
  CAST(fishery_dependent AS BIGINT) AS fishery_dependent, id, CAST(stat_area AS BIGINT) AS stat_area,
  round(dissolved_oxygen, 6) AS dissolved_oxygen, round(depth, 6) AS depth
FROM located"""))
def q_reconcile_schema(spark, sf):
    """Hand-off without salinity, time and temperature as text ->
    required + present optional columns, typed."""
    loc = located(spark, sf).drop("salinity")
    handoff = (loc.withColumn("time", F.date_format("time", "yyyy-MM-dd HH:mm:ss"))
                  .withColumn("temperature", F.col("temperature").cast("string")))
    return rounded(reconcile(handoff))


@query("product_recent_window", sql([OBS, GRID, LOCATED, daily_cte()], """
SELECT time, temperature, stat_area FROM d
WHERE time >= (SELECT max(time) FROM d) - INTERVAL 14 DAY AND time <= (SELECT max(time) FROM d)"""))
def q_product_recent_window(spark, sf):
    """Temperature and area over the last 14 days of the product."""
    d = product(spark, sf)
    now = d.agg(F.max("time")).first()[0]
    return rounded(recent(d, ["time", "temperature", "stat_area"], 14, now))


# ---------------------------------------------------------------------------
# filters and column functions
# ---------------------------------------------------------------------------

@query("seabed_filter", sql([OBS, RASTER, *nearest_ctes("obs", ["obs_id"], "n")], """
SELECT o.obs_id, o.depth, n.inferred_depth FROM obs o JOIN n_nr n USING (obs_id)
WHERE o.depth IS NOT NULL AND n.inferred_depth IS NOT NULL AND o.depth - n.inferred_depth < 20"""))
def q_seabed_filter(spark, sf):
    """J1 + P3: seabed depth, then the one-sided 20 m check."""
    o = fx.obs(spark, sf).select("obs_id", "latitude", "longitude", "depth")
    return seabed_check(nearest_raster(o, fx.raster(spark, sf)), "depth").select(
        "obs_id", "depth", "inferred_depth")


@query("do_missing_or_positive", sql([OBS], """
SELECT obs_id, round(dissolved_oxygen, 6) AS dissolved_oxygen FROM obs
WHERE dissolved_oxygen IS NULL OR dissolved_oxygen > 0"""))
def q_do_missing_or_positive(spark, sf):
    """P4."""
    return rounded(missing_or_positive(fx.obs(spark, sf), "dissolved_oxygen")
                   .select("obs_id", "dissolved_oxygen"))


@query("do_positive", sql([OBS], """
SELECT obs_id, round(dissolved_oxygen, 6) AS dissolved_oxygen FROM obs WHERE dissolved_oxygen > 0"""))
def q_do_positive(spark, sf):
    """P5."""
    return rounded(positive(fx.obs(spark, sf), "dissolved_oxygen").select("obs_id", "dissolved_oxygen"))


GROSS_SQL = sql([OBS, GRID, LOCATED, daily_cte("d0", rounded_=False)], f"""
SELECT {', '.join(f'round({c}, 6) AS {c}' if c not in ('time', 'grid_id', 'fishery_dependent', 'stat_area', 'data_provider') and not c.endswith('_count') else c
                  for c in DAILY_COLS.split(', '))}
FROM d0 WHERE depth > 1 AND depth < 900 AND temperature > 0 AND temperature < 27""")


@query("gross_range", GROSS_SQL)
def q_gross_range(spark, sf):
    """P6 on the daily product (strict; missing temperature fails)."""
    return rounded(gross_range(product(spark, sf)))


@query("drop_unlocated", sql([OBS, GRID], f"""
SELECT o.obs_id, g.id FROM obs o JOIN grid g ON {IN_CELL}"""))
def q_drop_unlocated(spark, sf):
    """P7 after the point-in-cell left join."""
    pts = fx.obs(spark, sf).select("obs_id", "latitude", "longitude")
    return drop_unlocated(within_cells(pts, fx.grid(spark, sf)), ["id"]).select("obs_id", "id")


NARROW_SQL = sql([OBS, GRID, LOCATED, daily_cte("d0", rounded_=False)], """
SELECT CAST(date_diff('day', DATE '1970-01-01', time) AS BIGINT) AS time, grid_id,
  CAST(latitude AS FLOAT) AS latitude, CAST(longitude AS FLOAT) AS longitude,
  CAST(fishery_dependent AS SMALLINT) AS fishery_dependent, stat_area,
  CAST(depth AS BIGINT) AS depth,
  CAST(temperature AS FLOAT) AS temperature, CAST(temperature_min AS FLOAT) AS temperature_min,
  CAST(temperature_max AS FLOAT) AS temperature_max, CAST(temperature_std AS FLOAT) AS temperature_std,
  temperature_count,
  CAST(dissolved_oxygen AS FLOAT) AS dissolved_oxygen,
  CAST(dissolved_oxygen_min AS FLOAT) AS dissolved_oxygen_min,
  CAST(dissolved_oxygen_max AS FLOAT) AS dissolved_oxygen_max,
  CAST(dissolved_oxygen_std AS FLOAT) AS dissolved_oxygen_std, dissolved_oxygen_count,
  CAST(salinity AS FLOAT) AS salinity, CAST(salinity_min AS FLOAT) AS salinity_min,
  CAST(salinity_max AS FLOAT) AS salinity_max, CAST(salinity_std AS FLOAT) AS salinity_std,
  salinity_count, data_provider
FROM d0""")


@query("narrow_types", NARROW_SQL)
def q_narrow_types(spark, sf):
    """P12 + P8: days since epoch, then the narrowed product types."""
    return narrow(epoch_day(product(spark, sf)))


@query("column_metadata", sql([OBS, GRID, LOCATED, daily_cte()], "SELECT * FROM d"))
def q_column_metadata(spark, sf):
    """The product with units and names attached as column metadata
    (values unchanged; the metadata itself is checked in the tests)."""
    return rounded(with_metadata(product(spark, sf)))


@query("unit_convert", sql([OBS], """
SELECT obs_id, round(dissolved_oxygen * 0.0328, 6) AS dissolved_oxygen FROM obs"""))
def q_unit_convert(spark, sf):
    """P10: molar oxygen to mg/L."""
    from ..functions.columns import OXYGEN_MOLAR_TO_MGL
    return rounded(scale(fx.obs(spark, sf), "dissolved_oxygen", OXYGEN_MOLAR_TO_MGL)
                   .select("obs_id", "dissolved_oxygen"))


@query("profile_key", sql([OBS], """
SELECT obs_id, concat_ws('_', coalesce(dataset_id, 'nan'), coalesce(CAST(tow_id AS VARCHAR), 'nan'))
  AS profile_id FROM obs"""))
def q_profile_key(spark, sf):
    """Composite profile key; a missing part reads 'nan'."""
    return profile_key(fx.obs(spark, sf), "dataset_id", "tow_id").select("obs_id", "profile_id")


@query("epoch_day", sql([OBS], """
SELECT obs_id, CAST(date_diff('day', DATE '1970-01-01', CAST(time AS DATE)) AS INTEGER) AS time,
  CAST(year(time) AS INTEGER) AS year, CAST(month(time) AS INTEGER) AS month,
  CAST(day(time) AS INTEGER) AS day FROM obs"""))
def q_epoch_day(spark, sf):
    """Days since 1970-01-01 and the calendar parts of the layout."""
    return epoch_day(fx.obs(spark, sf), parts=True).select("obs_id", "time", "year", "month", "day")


# ---------------------------------------------------------------------------
# joins
# ---------------------------------------------------------------------------

@query("grid_attributes", sql([OBS, GRID], f"""
SELECT o.obs_id, g.id, round(g.centroid_lat, 6) AS latitude, round(g.centroid_lon, 6) AS longitude,
  g.stat_area, round(g.depth, 6) AS depth
FROM obs o LEFT JOIN grid g ON {IN_CELL}"""))
def q_grid_attributes(spark, sf):
    """J4 after J2: the centroid replaces the position; area and depth added
    (left join: unlocated rows keep NULLs)."""
    o = fx.obs(spark, sf).select("obs_id", "latitude", "longitude", "depth")
    g = fx.grid(spark, sf)
    return rounded(attach_cell(within_cells(o, g), g).select(
        "obs_id", "id", "latitude", "longitude", "stat_area", "depth"))


@query("grid_assignment", sql([OBS, GRID, LOCATED], """
SELECT obs_id, id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude,
  stat_area, round(depth, 6) AS depth FROM located"""))
def q_grid_assignment(spark, sf):
    """C11: J2 -> J4 -> P7."""
    return rounded(located(spark, sf).select("obs_id", "id", "latitude", "longitude",
                                             "stat_area", "depth"))


# institutions as the feed names them; one is not in the map
INSTITUTION = ("CASE dataset_id WHEN 'view' THEN 'University of Maine' WHEN 'click' THEN 'Rutgers University' "
               "WHEN 'purchase' THEN 'NAVOCEANO,University of Delaware' "
               "WHEN 'signup' THEN 'OOI Coastal & Global Scale Nodes (CGSN)' ELSE dataset_id END")
INSTITUTION_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in INSTITUTION_CODES.items())


@query("map_default", sql([OBS], f"""
SELECT obs_id, CASE {INSTITUTION} {INSTITUTION_CASE} ELSE 'glider_other' END AS data_provider FROM obs"""))
def q_map_default(spark, sf):
    """Provider code of the institution, default for absent keys."""
    o = fx.obs(spark, sf).withColumn("institution", F.expr(INSTITUTION))
    return map_default(o.drop("data_provider"), "institution").select("obs_id", "data_provider")


@query("distinct_key_join", sql([OBS, RASTER, *nearest_ctes("obs", ["obs_id"], "n")], """
SELECT o.obs_id, n.inferred_depth FROM obs o LEFT JOIN n_nr n USING (obs_id)"""))
def q_distinct_key_join(spark, sf):
    """J3 + U3: the nearest-raster lookup computed once per distinct position
    and joined back to every observation."""
    o = fx.obs(spark, sf).select("obs_id", "latitude", "longitude")
    r = fx.raster(spark, sf)
    return once_per_key(o, ["latitude", "longitude"], lambda k: nearest_raster(k, r)).select(
        "obs_id", "inferred_depth")


@query("distinct_positions", sql([OBS], "SELECT DISTINCT latitude, longitude FROM obs"))
def q_distinct_positions(spark, sf):
    """U3."""
    return distinct_positions(fx.obs(spark, sf))


def _albers_sql(lat: str, lon: str) -> tuple[str, str]:
    """The same projection written as DuckDB arithmetic (oracle side)."""
    from ..operators.spatial import albers_constants
    k = albers_constants()
    s = f"sin(radians({lat}))"
    q = (f"({1 - k['e2']!r} * ({s} / (1 - {k['e2']!r} * {s} * {s}) - {1 / (2 * k['e'])!r} * "
         f"ln((1 - {k['e']!r} * {s}) / (1 + {k['e']!r} * {s}))))")
    rho = f"({k['a'] / k['n']!r} * sqrt({k['c']!r} - {k['n']!r} * {q}))"
    theta = f"({k['n']!r} * (radians({lon}) - {k['lon0']!r}))"
    return f"{rho} * sin({theta})", f"{k['rho0']!r} - {rho} * cos({theta})"


_CX, _CY = _albers_sql("centroid_lat", "centroid_lon")
_PX, _PY = _albers_sql("latitude", "longitude")
AREAS = f"""areas AS (SELECT CAST(stat_area AS BIGINT) AS stat_area, avg({_CX}) AS x, avg({_CY}) AS y
   FROM grid GROUP BY 1)"""


ORACLE_NEAREST_CENTROID = sql([OBS, GRID, AREAS, f"pp AS (SELECT obs_id, {_PX} AS px, {_PY} AS py FROM obs)"], """
SELECT obs_id, stat_area FROM (
  SELECT p.obs_id, a.stat_area, row_number() OVER (PARTITION BY p.obs_id ORDER BY
    (p.px - a.x) * (p.px - a.x) + (p.py - a.y) * (p.py - a.y), a.stat_area) AS rn
  FROM pp p, areas a) WHERE rn = 1""")


@query("nearest_centroid", ORACLE_NEAREST_CENTROID)
def q_nearest_centroid(spark, sf):
    """Nearest statistical-area centroid in the Albers equal-area
    projection of the contiguous US (area centroid = mean of its cells'
    projected centroids, derived from the grid)."""
    g = fx.grid(spark, sf)
    cx, cy = albers_xy(F.col("centroid_lat"), F.col("centroid_lon"))
    areas = g.groupBy("stat_area").agg(F.avg(cx).alias("x"), F.avg(cy).alias("y"))
    o = fx.obs(spark, sf)
    px, py = albers_xy(F.col("latitude"), F.col("longitude"))
    pts = o.select("obs_id", px.alias("px"), py.alias("py"))
    return nearest_centroid(pts, areas).select("obs_id", "stat_area")


def _centroid_inputs(spark, sf):
    g = fx.grid(spark, sf)
    cx, cy = albers_xy(F.col("centroid_lat"), F.col("centroid_lon"))
    areas = g.groupBy("stat_area").agg(F.avg(cx).alias("x"), F.avg(cy).alias("y"))
    px, py = albers_xy(F.col("latitude"), F.col("longitude"))
    return fx.obs(spark, sf).select("obs_id", px.alias("px"), py.alias("py")), areas


@query("nearest_centroid_tiled", ORACLE_NEAREST_CENTROID)
def q_nearest_centroid_tiled(spark, sf):
    """J6 through the path used when the area table is too large to ship:
    an exact search over square tiles (radius doubled for unsettled points)."""
    from ..operators.spatial import nearest_centroid_tiled
    pts, areas = _centroid_inputs(spark, sf)
    return nearest_centroid_tiled(pts, areas).select("obs_id", "stat_area")


# ---------------------------------------------------------------------------
# aggregations
# ---------------------------------------------------------------------------

@query("hourly_by_tow", sql([OBS], """
SELECT tow_id, date_trunc('hour', time) AS time, round(avg(latitude), 6) AS latitude,
  round(avg(longitude), 6) AS longitude, round(avg(temperature), 6) AS temperature,
  round(avg(depth), 6) AS depth
FROM obs WHERE tow_id IS NOT NULL GROUP BY 1, 2"""))
def q_hourly_by_tow(spark, sf):
    """A1: calendar-hour means per tow."""
    return rounded(hourly_mean(fx.obs(spark, sf), "tow_id",
                               ["latitude", "longitude", "temperature", "depth"]))


@query("hourly_by_station", sql([OBS], """
SELECT dataset_id, date_trunc('hour', time) AS time, round(avg(temperature), 6) AS temperature,
  round(avg(salinity), 6) AS salinity, round(avg(dissolved_oxygen), 6) AS dissolved_oxygen
FROM obs GROUP BY 1, 2"""))
def q_hourly_by_station(spark, sf):
    """A2: hourly means per station."""
    o = fx.obs(spark, sf).select("dataset_id", "time", "temperature", "salinity", "dissolved_oxygen")
    return rounded(hourly_by_station(o, "dataset_id"))


@query("deepest_per_profile", sql([OBS], """
SELECT obs_id, profile_id, round(depth, 6) AS depth, time FROM (
  SELECT *, row_number() OVER (PARTITION BY profile_id ORDER BY depth DESC, obs_id) AS rn
  FROM obs WHERE profile_id IS NOT NULL AND depth IS NOT NULL) WHERE rn = 1"""))
def q_deepest_per_profile(spark, sf):
    """A3: deepest row per profile, first row on ties."""
    o = fx.obs(spark, sf).select("obs_id", "profile_id", "depth", "time")
    return rounded(deepest(o, "profile_id", "depth", tie="obs_id"))


@query("daily_cell_compat", sql([OBS, GRID, LOCATED, """pf AS (
  SELECT CAST(time AS DATE) AS day, id, data_provider, min(time) AS t0,
    arg_min(obs_id, time) AS o0
  FROM located WHERE data_provider IS NOT NULL GROUP BY 1, 2, 3)""", """pl AS (
  SELECT day, id, string_agg(data_provider, ' ' ORDER BY t0, o0) AS data_provider FROM pf GROUP BY 1, 2)""",
                                 """d5 AS (
SELECT CAST(time AS DATE) AS time, id AS grid_id,
  round(first(latitude ORDER BY time, obs_id) FILTER (WHERE latitude IS NOT NULL), 6) AS latitude,
  round(first(longitude ORDER BY time, obs_id) FILTER (WHERE longitude IS NOT NULL), 6) AS longitude,
  first(fishery_dependent ORDER BY time, obs_id) FILTER (WHERE fishery_dependent IS NOT NULL) AS fishery_dependent,
  first(stat_area ORDER BY time, obs_id) FILTER (WHERE stat_area IS NOT NULL) AS stat_area,
  round(first(depth ORDER BY time, obs_id) FILTER (WHERE depth IS NOT NULL), 6) AS depth,
""" + f"""  {_stats_sql('temperature')}, {_stats_sql('dissolved_oxygen')}, {_stats_sql('salinity')}
FROM located GROUP BY 1, 2)"""], """
SELECT d5.*, pl.data_provider FROM d5 LEFT JOIN pl ON pl.day = d5.time AND pl.id = d5.grid_id"""))
def q_daily_cell_compat(spark, sf):
    """A5: the older variant: 'first' skips missing values, providers in
    first-seen order joined by a blank."""
    return rounded(daily_cell(located(spark, sf), order=["time", "obs_id"], provider_sep=" ",
                              first_ignore_nulls=True, providers_first_seen=True))


HOURLY_CELL = """h AS (
  SELECT id, tow_id, data_provider, date_trunc('hour', time) AS time,
    avg(temperature) AS temperature, avg(salinity) AS salinity, avg(dissolved_oxygen) AS dissolved_oxygen,
    count(temperature) AS temperature_count, count(salinity) AS salinity_count,
    count(dissolved_oxygen) AS dissolved_oxygen_count
  FROM located WHERE id IS NOT NULL AND tow_id IS NOT NULL AND data_provider IS NOT NULL
  GROUP BY 1, 2, 3, 4
  HAVING NOT (avg(temperature) IS NULL AND avg(salinity) IS NULL AND avg(dissolved_oxygen) IS NULL))"""


def _pre_stats(m: str) -> str:
    return (f"round(avg({m}), 6) AS {m}, round(min({m}), 6) AS {m}_min, round(max({m}), 6) AS {m}_max, "
            f"round(stddev_samp({m}), 6) AS {m}_std, CAST(sum({m}_count) AS BIGINT) AS {m}_count")


@query("daily_cell_precounted", sql([OBS, GRID, LOCATED, HOURLY_CELL], f"""
SELECT CAST(time AS DATE) AS time, id AS grid_id, {_pre_stats('temperature')},
  {_pre_stats('salinity')}, {_pre_stats('dissolved_oxygen')},
  string_agg(DISTINCT data_provider, ', ' ORDER BY data_provider) AS data_provider
FROM h GROUP BY 1, 2"""))
def q_daily_cell_precounted(spark, sf):
    """A1 (with counts) per cell and tow, then A6: unweighted daily stats of
    the hourly rows and summed counts."""
    measures = ["temperature", "salinity", "dissolved_oxygen"]
    h = hourly_mean(located(spark, sf), ["id", "tow_id", "data_provider"], measures, counts=True)
    return rounded(daily_cell_precounted(h, measures))


@query("merge_partials", sql([OBS, GRID, LOCATED], f"""
SELECT CAST(time AS DATE) AS time, id AS grid_id, round(min(latitude), 6) AS latitude,
  round(min(longitude), 6) AS longitude, min(stat_area) AS stat_area, round(min(depth), 6) AS depth,
  {_stats_sql('temperature')}, {_stats_sql('dissolved_oxygen')}, {_stats_sql('salinity')},
  string_agg(DISTINCT data_provider, ', ' ORDER BY data_provider) AS data_provider
FROM located GROUP BY 1, 2"""))
def q_merge_partials(spark, sf):
    """Partial daily statistics per feed (A4 grouped by feed too), merged
    back to one row per (day, cell); equal to statistics over the raw rows."""
    parts = daily_cell(located(spark, sf), order=["time", "obs_id"], by=["dataset_id"])
    return rounded(merge_daily(parts.drop("dataset_id", "fishery_dependent")))


@query("feed_counts", sql([OBS, RASTER, *nearest_ctes("obs", ["obs_id"], "n")], """,
k AS (SELECT o.dataset_id, count(*) AS n FROM obs o JOIN n_nr n USING (obs_id)
      WHERE o.depth IS NOT NULL AND n.inferred_depth IS NOT NULL AND o.depth - n.inferred_depth < 20
      GROUP BY 1),
r AS (SELECT dataset_id, count(*) AS n FROM obs GROUP BY 1)
SELECT coalesce(r.dataset_id, k.dataset_id) AS dataset_id, coalesce(r.n, 0) AS observation_count,
  coalesce(k.n, 0) AS post_filter_count
FROM r FULL JOIN k ON r.dataset_id = k.dataset_id""".replace(",\nk AS", "\n, k AS", 1)))
def q_feed_counts(spark, sf):
    """Raw vs kept (after the seabed check) rows per feed."""
    o = fx.obs(spark, sf)
    kept = seabed_check(nearest_raster(o.select("dataset_id", "latitude", "longitude", "depth"),
                                       fx.raster(spark, sf)), "depth")
    return feed_counts(o, kept)


@query("retention_curve", sql([OBS, RASTER, *nearest_ctes("obs", ["obs_id"], "n"),
                               """dd AS (SELECT n.inferred_depth - o.depth AS d FROM obs o
                                         LEFT JOIN n_nr n USING (obs_id))"""], """
SELECT CAST(t.t AS INTEGER) AS threshold, count(dd.d) FILTER (WHERE abs(dd.d) <= t.t) AS count,
  round(100.0 * count(dd.d) FILTER (WHERE abs(dd.d) <= t.t) / (SELECT count(*) FROM dd), 6) AS percent
FROM generate_series(1, 500) t(t), dd GROUP BY 1"""))
def q_retention_curve(spark, sf):
    """Rows kept by each seabed threshold 1..500 m (depth difference)."""
    o = nearest_raster(fx.obs(spark, sf).select("obs_id", "latitude", "longitude", "depth"),
                       fx.raster(spark, sf))
    d = o.select((F.col("inferred_depth") - F.col("depth")).alias("diff"))
    return rounded(retention_curve(d, "diff"))


@query("latest_run", sql([RUN_LOG], """
SELECT max(runtime) AS runtime, reload_type FROM run_log GROUP BY reload_type
ORDER BY max(runtime) DESC, reload_type LIMIT 1"""))
def q_latest_run(spark, sf):
    """A10: latest runtime and its reload type (top-1 is the feature)."""
    return latest_run(fx.run_log(spark, sf))


@query("last_full_run", sql([RUN_LOG], "SELECT max(runtime) AS runtime FROM run_log WHERE reload_type = 'full'"))
def q_last_full_run(spark, sf):
    """A11."""
    return last_full_run(fx.run_log(spark, sf))


# ---------------------------------------------------------------------------
# per-group windows
# ---------------------------------------------------------------------------

@query("sigma_outliers", sql([OBS], """
SELECT obs_id FROM (SELECT obs_id, tow_id, dissolved_oxygen,
    avg(dissolved_oxygen) OVER (PARTITION BY tow_id) AS mu,
    stddev_samp(dissolved_oxygen) OVER (PARTITION BY tow_id) AS sd FROM obs)
WHERE NOT (tow_id IS NOT NULL AND coalesce(abs(dissolved_oxygen - mu) > 3 * sd, false))"""))
def q_sigma_outliers(spark, sf):
    """Rows kept after 3-sigma removal of oxygen per tow."""
    return drop_outliers(fx.obs(spark, sf), "tow_id", "dissolved_oxygen").select("obs_id")


@query("min_group", sql([OBS], """
SELECT obs_id FROM (SELECT obs_id, profile_id, count(*) OVER (PARTITION BY profile_id) AS n FROM obs)
WHERE profile_id IS NOT NULL AND n >= 10"""))
def q_min_group(spark, sf):
    """Rows of profiles with at least 10 rows."""
    return min_group_size(fx.obs(spark, sf), "profile_id", 10).select("obs_id")


@query("running_median", sql([OBS], """
SELECT obs_id, CASE WHEN tow_id IS NULL THEN NULL
  ELSE round(list_sort(list_resize(w, 5, 0.0))[3], 6) END AS temperature
FROM (SELECT obs_id, tow_id, list(temperature) OVER (PARTITION BY tow_id ORDER BY time, obs_id
        ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS w FROM obs)"""))
def q_running_median(spark, sf):
    """Zero-padded 5-point running median of temperature along each tow."""
    o = fx.obs(spark, sf).select("obs_id", "tow_id", "time", "temperature")
    return rounded(running_median(o, "tow_id", ["time", "obs_id"], "temperature")
                   .select("obs_id", "temperature"))


# ---------------------------------------------------------------------------
# set operations and calendar
# ---------------------------------------------------------------------------

_SUBSETS = {"view": ["temperature"], "click": ["temperature", "salinity"],
            "purchase": ["temperature", "dissolved_oxygen"]}


@query("union_feeds", sql([OBS], """
SELECT obs_id, dataset_id, round(temperature, 6) AS temperature,
  CASE WHEN dataset_id IN ('view', 'purchase') THEN NULL ELSE round(salinity, 6) END AS salinity,
  CASE WHEN dataset_id IN ('view', 'click') THEN NULL ELSE round(dissolved_oxygen, 6) END AS dissolved_oxygen
FROM obs"""))
def q_union_feeds(spark, sf):
    """Feeds with different column sets unioned by name (missing -> NULL).
    Each feed is the obs rows of one dataset id with its own columns."""
    o = fx.obs(spark, sf)
    ids = [r[0] for r in o.select("dataset_id").distinct().collect()]
    frames = [o.where(F.col("dataset_id") == i).select(
        "obs_id", "dataset_id", *_SUBSETS.get(i, ["temperature", "salinity", "dissolved_oxygen"]))
        for i in sorted(ids)]
    return rounded(union_feeds(frames))


@query("union_sideload", sql([OBS, GRID, LOCATED], """
SELECT obs_id, CASE dataset_id WHEN 'signup' THEN 0 WHEN 'purchase' THEN 1 ELSE 2 END AS source_ord
FROM located"""))
def q_union_sideload(spark, sf):
    """Side-loads first (gmgi, study fleet) then gridded feeds, with
    the explicit source order column."""
    loc = located(spark, sf).select("obs_id", "dataset_id")
    gmgi = loc.where(F.col("dataset_id") == "signup")
    fleet = loc.where(F.col("dataset_id") == "purchase")
    rest = loc.where(~F.col("dataset_id").isin("signup", "purchase"))
    return union_with_sideloads(gmgi, fleet, rest).select("obs_id", "source_ord")


@query("refresh_calendar", """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS run_date FROM orders)
SELECT run_date,
  CASE WHEN month(run_date) = 1 AND day(run_date) = 1 THEN 'full'
       WHEN month(run_date) IN (4, 7, 10) AND day(run_date) <= 1 THEN 'quarterly'
       WHEN day(run_date) IN (1, 15) THEN 'bi-weekly' ELSE 'daily' END AS reload_type,
  CAST(CASE WHEN month(run_date) = 1 AND day(run_date) = 1 THEN DATE '2000-01-01'
       WHEN month(run_date) IN (4, 7, 10) AND day(run_date) <= 1 THEN run_date - INTERVAL 1 YEAR
       WHEN day(run_date) IN (1, 15) THEN run_date - INTERVAL 1 MONTH
       ELSE run_date - INTERVAL 5 DAY END AS TIMESTAMP) AS start
FROM d""")
def q_refresh_calendar(spark, sf):
    """R1 over every order date taken as a run date."""
    d = fx.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("run_date")).distinct()
    w = refresh_window(F.col("run_date"))
    return d.select("run_date", w["reload_type"].alias("reload_type"), w["start"].alias("start"))
