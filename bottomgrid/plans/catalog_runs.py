"""Queries for awkward days of the scheduled jobs: empty, failing and tied
inputs, restarts, NaN, and the size-dependent paths forced on."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from . import fixtures as fx
from .catalog_ops import INSTITUTION
from .catalog_std import PROFILE_NO
from .catalog_io import (ARCHIVE_AT, PRODUCT_SQL, RUN_DATE, _read_product, _scratch, _STEP1_HI, _STEP1_LO,
                         product_body)
from .queries import GRID, IN_CELL, LOCATED, OBS, ORACLES, RASTER, daily_cte, located, nearest_ctes, query, rounded, sql
from .runs import product_frame, quarantine_path, run_step1, run_step2
from .standardize import OOI_OXYGEN
from ..operators.daily import daily_cell
from ..operators.qc import retention_curve, running_median
from ..operators.spatial import nearest_raster, pack_raster, within_cells
from ..registry import FEEDS
from ..sinks.publish import publish_days, stage
from ..sources.staged import read_staged
from ..streaming.incremental import incremental_stream

# W3 over a measure with missing values: they are no part of the series
NULLABLE_MEDIAN = sql([OBS], """
SELECT obs_id, m AS dissolved_oxygen FROM obs LEFT JOIN (
  SELECT obs_id, round(list_sort(list_resize(list(dissolved_oxygen) OVER (PARTITION BY tow_id ORDER BY time, obs_id
        ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 5, 0.0))[3], 6) AS m
  FROM obs WHERE tow_id IS NOT NULL AND dissolved_oxygen IS NOT NULL) USING (obs_id)""")


def _median(spark, sf, **kw):
    o = fx.obs(spark, sf).select("obs_id", "tow_id", "time", "dissolved_oxygen")
    return rounded(running_median(o, "tow_id", ["time", "obs_id"], "dissolved_oxygen", **kw)
                   .select("obs_id", "dissolved_oxygen"))


@query("running_median_nullable", NULLABLE_MEDIAN)
def q_running_median_nullable(spark, sf):
    """W3 over oxygen, which has missing values."""
    return _median(spark, sf)


@query("running_median_hot", NULLABLE_MEDIAN)
def q_running_median_hot(spark, sf):
    """W3 with every tow above the bound: the range-sorted path, same rows."""
    return _median(spark, sf, max_group_rows=1)


# fixed values: a short list of seabed thresholds in metres
SHORT_LIST = (5, 10, 15, 20, 25, 30, 40, 50, 75, 100, 150, 200, 300, 500)


@query("retention_curve_list", sql([OBS, RASTER, *nearest_ctes("obs", ["obs_id"], "n"),
                                    """dd AS (SELECT n.inferred_depth - o.depth AS d FROM obs o
                                              LEFT JOIN n_nr n USING (obs_id))"""], f"""
SELECT CAST(t.t AS INTEGER) AS threshold, count(dd.d) FILTER (WHERE abs(dd.d) <= t.t) AS count,
  round(100.0 * count(dd.d) FILTER (WHERE abs(dd.d) <= t.t) / (SELECT count(*) FROM dd), 6) AS percent
FROM (SELECT unnest([{', '.join(map(str, SHORT_LIST))}]) AS t) t, dd GROUP BY 1"""))
def q_retention_curve_list(spark, sf):
    """A9 for a given list of thresholds."""
    o = nearest_raster(fx.obs(spark, sf).select("obs_id", "latitude", "longitude", "depth"), fx.raster(spark, sf))
    return rounded(retention_curve(o.select((F.col("inferred_depth") - F.col("depth")).alias("diff")), "diff", SHORT_LIST))


@query("reconcile_nan", sql([OBS, GRID, LOCATED, """n AS (SELECT * REPLACE (
  CASE WHEN obs_id % 11 = 0 THEN NULL ELSE temperature END AS temperature,
  CASE WHEN obs_id % 13 = 0 THEN NULL ELSE salinity END AS salinity) FROM located)""", daily_cte("d", src="n")],
                            "SELECT * REPLACE (CAST(fishery_dependent AS BIGINT) AS fishery_dependent) FROM d"))
def q_reconcile_nan(spark, sf):
    """S8 then A4: NaN numbers and the text 'NaN' in the hand-off count as missing."""
    rows = located(spark, sf).withColumns({
        "temperature": F.when(F.col("obs_id") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("temperature")),
        "salinity": F.when(F.col("obs_id") % 13 == 0, F.lit("NaN")).otherwise(F.col("salinity").cast("string")),
        "tie": F.col("obs_id")})
    path = _scratch(spark, "staged")
    stage(rows, path)
    return rounded(daily_cell(read_staged(spark, path), order=["time", "tie"]))


ALL_FEEDS_DATE = dt.date(2024, 12, 31)
_GOOD = "fixed_gear_oceanography"
_OTHERS = ", ".join(f"('{f.feed_id}')" for f in FEEDS if f.feed_id != _GOOD)


@query("fetch_with_failing_feeds", sql([
    OBS.replace("obs AS", "obs_all AS", 1),
    f"obs AS (SELECT * FROM obs_all WHERE time >= {_STEP1_LO} AND time <= {_STEP1_HI})"], f"""
SELECT '{_GOOD}' AS dataset_id, (SELECT count(*) FROM obs) AS observation_count,
  (SELECT count(*) FROM (SELECT *, avg(dissolved_oxygen) OVER (PARTITION BY tow_id) AS mu,
      stddev_samp(dissolved_oxygen) OVER (PARTITION BY tow_id) AS sd FROM obs)
   WHERE NOT (tow_id IS NOT NULL AND coalesce(abs(dissolved_oxygen - mu) > 3 * sd, false))) AS post_filter_count,
  1 AS fetch_erddap_success, (SELECT count(*) FROM obs) > 0 AS staged
UNION ALL
SELECT f, 0, 0, CASE WHEN f = 'eMOLT_RT' THEN 1 ELSE 0 END, false FROM (VALUES {_OTHERS}) v(f)"""))
def q_fetch_with_failing_feeds(spark, sf):
    """C12 on a bad day: one good feed, one (hourly means) without a row in
    the window, one that lacks a column, one with an unreadable file, the
    others missing. The run log has every feed, and the good one is staged."""
    root = _scratch(spark, "landing")
    o = fx.obs(spark, sf)
    o.select("time", "latitude", "longitude", "temperature", "dissolved_oxygen", "tow_id").write.parquet(f"{root}/{_GOOD}")
    (o.select((F.col("time") - F.expr("INTERVAL 20 YEARS")).alias("time"), "latitude", "longitude", "temperature",
              F.col("tow_id").cast("string").alias("tow_id"), "depth", F.lit(3).alias("segment_type"))
     .write.parquet(f"{root}/eMOLT_RT"))
    (o.select("time", "latitude", "longitude", "temperature", F.col("dissolved_oxygen").alias("DO"),
              F.lit(90).alias("water_detect_perc")).write.parquet(f"{root}/eMOLT_RT_LOWELL"))
    o.select(F.col("dataset_id").alias("value")).write.text(f"{root}/wind_farm_acoustic_receivers")
    staged, log = _scratch(spark, "staged"), _scratch(spark, "runlog")
    run_step1(spark, root, fx.grid(spark, sf), fx.raster(spark, sf), RUN_DATE, staged, log)
    have = spark.read.parquet(staged).groupBy("dataset_id").agg(F.count("*").alias("n"))
    return (spark.read.parquet(log).join(have, "dataset_id", "left")
            .select("dataset_id", "observation_count", "post_filter_count", "fetch_erddap_success",
                    F.coalesce(F.col("n") > 0, F.lit(False)).alias("staged")))


@query("publish_nothing", PRODUCT_SQL)
def q_publish_nothing(spark, sf):
    """K3 with a run whose every row fails the range test, over an existing
    product: nothing is published and the product stays."""
    loc = located(spark, sf)
    path = _scratch(spark, "product")
    publish_days(product_frame(loc), path)
    days = publish_days(product_frame(loc.withColumn("temperature", F.lit(-5.0))), path)
    return _read_product(spark, path).where(F.lit(not days))


@query("aggregate_and_publish_ties", sql([
    OBS, GRID, LOCATED, "located_h AS (SELECT * REPLACE (date_trunc('hour', time) AS time) FROM located)",
    daily_cte("d0", src="located_h", rounded_=False)], product_body()))
def q_aggregate_and_publish_ties(spark, sf):
    """C13 where many rows of a cell share their hour and differ in flag: the
    staged tie column decides, not the order of the files."""
    rows = located(spark, sf).withColumns({"time": F.date_trunc("hour", "time").cast("timestamp_ntz"),
                                           "tie": F.col("obs_id")})
    staged, prod = _scratch(spark, "staged"), _scratch(spark, "product")
    stage(rows.repartition(7, "temperature"), staged)
    run_step2(spark, staged, prod, _scratch(spark, "archive"), _scratch(spark, "catalogue"),
              _scratch(spark, "diagnostics"), now=ARCHIVE_AT)
    return _read_product(spark, prod)


@query("incremental_restart", PRODUCT_SQL)
def q_incremental_restart(spark, sf):
    """T2 incremental whose checkpoint is lost after the first run: the stream
    refuses to count the same files again, and the product stays right."""
    staged, parts, prod = (_scratch(spark, n) for n in ("staged", "partials", "product"))
    stage(located(spark, sf), staged)
    incremental_stream(spark, staged, parts, prod, checkpoint=_scratch(spark, "ckpt")).awaitTermination()
    try:
        incremental_stream(spark, staged, parts, prod, checkpoint=_scratch(spark, "ckpt")).awaitTermination()
        refused = False
    except ValueError:
        refused = True
    return _read_product(spark, prod).where(F.lit(refused))


# ---------------------------------------------------------------------------
# all registered feeds in one run
# ---------------------------------------------------------------------------

# Rows of one profile never tie in depth here: a run orders ties by content,
# the oracles of the standardizers by observation number.
UNTIED_OBS = f"obs AS (SELECT * REPLACE (depth + obs_id * 1e-9 AS depth) FROM ({fx.OBS_SQL}))"
# region of one feed's constraints
_BOX = {"oleanderXbt": "latitude >= 38.18 AND latitude <= 41.04 AND longitude >= -74.12 AND longitude <= -71.26",
        "ocdbs_v_erddap1": "latitude > 34", "demersal_gliders_aggregated": "salinity > 20 AND salinity < 39",
        "eMOLT_RT_LOWELL": "dissolved_oxygen > 0 AND temperature > 0 AND temperature < 27"}
# feed -> the query whose oracle standardizes the same rows
_STANDARD = {"fixed_gear_oceanography": "std_fixed_gear", "shelf_fleet_profiles_1m_binned": "std_shelf_profiles",
             "wind_farm_profiles_1m_binned": "std_wind_profiles", "wind_farm_acoustic_receivers": "std_receivers",
             "demersal_gliders_aggregated": "std_gliders", "eMOLT_RT": "std_emolt_rt", "eMOLT_RT_LOWELL": "std_emolt_lowell",
             "ocdbs_v_erddap1": "std_ecomon", "oleanderXbt": "std_oleander"}


def land_all_feeds(spark, sf, root: str) -> None:
    """Every registered feed, shaped from the observations as its provider
    lands it: some by day folders, some with times as text. One of the files
    of one feed is not readable."""
    o = fx.obs(spark, sf).withColumn("depth", F.col("depth") + F.col("obs_id") * 1e-9)
    tow, text = F.col("tow_id").cast("string").alias("tow_id"), F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    place = ["time", "latitude", "longitude"]
    profiles = o.select(*place, F.col("temperature").alias("conservative_temperature"), F.col("depth").alias("sea_pressure"),
                        "profile_id", F.col("salinity").alias("absolute_salinity"))
    ooi = o.select(*place, F.col("temperature").alias("sea_water_temperature"),
                   F.col("salinity").alias("sea_water_practical_salinity"), F.col("dissolved_oxygen").alias(OOI_OXYGEN))
    feeds = {
        "fixed_gear_oceanography": o.select(*place, "temperature", "dissolved_oxygen", "tow_id"),
        "shelf_fleet_profiles_1m_binned": profiles, "wind_farm_profiles_1m_binned": profiles,
        "wind_farm_acoustic_receivers": o.select(*place, F.col("dataset_id").alias("station_id"), "temperature"),
        "demersal_gliders_aggregated": located(spark, sf).select(
            "time", F.col("id").alias("grid_id"), "temperature", "salinity", "dissolved_oxygen", F.expr(INSTITUTION).alias("institution")),
        "eMOLT_RT": o.select(*place, "temperature", tow, "depth", F.lit(3).alias("segment_type")),
        "eMOLT_RT_LOWELL": o.select(*place, "temperature", F.col("dissolved_oxygen").alias("DO"), tow,
                                    F.lit(80).alias("water_detect_perc")),
        "ocdbs_v_erddap1": o.select(text.alias("UTC_DATETIME"), "latitude", "longitude",
                                    F.col("temperature").alias("sea_water_temperature (degree_C)"), F.col("depth").alias("pressure_dbars"),
                                    "dissolved_oxygen", F.col("salinity").alias("sea_water_salinity"),
                                    F.expr(PROFILE_NO).alias("cast_number"), F.col("dataset_id").alias("cruise_id"),
                                    F.lit("CTD").alias("GEAR_TYPE")),
        "oleanderXbt": o.select(*place, F.col("temperature").alias("temp"), "depth", F.expr(PROFILE_NO).alias("profile_number"),
                                F.col("dataset_id").alias("cruise_num"), F.lit(1).alias("hit_bottom"), F.lit(2024).alias("start_year"))}
    feeds |= {f.feed_id: ooi for f in FEEDS if f.feed_id.startswith("ooi-")}
    for fid, df in feeds.items():
        if fid.startswith("ooi-"):
            df.withColumn("day", F.to_date("time")).write.partitionBy("day").parquet(f"{root}/{fid}")
        else:
            df.write.parquet(f"{root}/{fid}")
    o.limit(1).select(F.lit("not a table").alias("value")).coalesce(1).write.mode("append").text(f"{root}/wind_farm_acoustic_receivers")


def _all_feeds_oracle() -> str:
    rows = []
    for f in FEEDS:
        box = _BOX.get(f.feed_id)
        if f.feed_id.startswith("ooi-"):
            # one station: an hour of the feed is one row
            raw, kept = "SELECT 1 FROM obs", "SELECT DISTINCT date_trunc('hour', time) FROM obs"
        else:
            src = UNTIED_OBS if not box or f.feed_id == "demersal_gliders_aggregated" else UNTIED_OBS.replace(
                f"FROM ({fx.OBS_SQL}))", f"FROM ({fx.OBS_SQL}) WHERE {box})")
            kept = ORACLES[_STANDARD[f.feed_id]].replace(OBS, src)
            raw = f"SELECT 1 FROM obs WHERE {box}" if box else "SELECT 1 FROM obs"
        if f.feed_id == "demersal_gliders_aggregated":
            kept = kept.replace("FROM located l LEFT", f"FROM (SELECT * FROM located WHERE {box}) l LEFT")
            raw = f"SELECT 1 FROM located WHERE {box}"
        rows.append(f"SELECT '{f.feed_id}' AS dataset_id, (SELECT count(*) FROM ({raw})) AS observation_count, "
                    f"(SELECT count(*) FROM ({kept})) AS post_filter_count, 1 AS fetch_erddap_success, '{f.group}' AS data_provider, "
                    f"'manual_full' AS reload_type, {1 if f.feed_id == 'wind_farm_acoustic_receivers' else 0} AS files_set_aside")
    return sql([UNTIED_OBS, GRID, LOCATED], "\nUNION ALL\n".join(rows))


@query("fetch_all_feeds", _all_feeds_oracle())
def q_fetch_all_feeds(spark, sf):
    """C12 over all fifteen feeds: the run log with its raw and kept counts,
    and the files that each feed had set aside."""
    root, log = _scratch(spark, "landing"), _scratch(spark, "runlog")
    land_all_feeds(spark, sf, root)
    for _ in range(2):      # the second time as a retry of the same run: it logs nothing again
        run_step1(spark, root, fx.grid(spark, sf), fx.raster(spark, sf), ALL_FEEDS_DATE, _scratch(spark, "staged"), log,
                  force_full=True, run_id="2024")
    aside = spark.read.parquet(quarantine_path(log)).groupBy("dataset_id").agg(F.count("*").alias("n"))
    return (spark.read.parquet(log).join(aside, "dataset_id", "left")
            .select("dataset_id", "observation_count", "post_filter_count", "fetch_erddap_success", "data_provider",
                    "reload_type", F.coalesce("n", F.lit(0)).cast("int").alias("files_set_aside")))


# ---------------------------------------------------------------------------
# cells of very different sizes, and a packed raster
# ---------------------------------------------------------------------------

# every tenth cell again four hundred times smaller inside itself, and one
# cell around everything
_SIZES = """sized AS (
  SELECT id, x0, y0, w, h, shear FROM grid
  UNION ALL SELECT 1000000 + id, x0 + w * 0.3, y0 + h * 0.3, w / 400, h / 400, 0e0 FROM grid WHERE id % 10 = 0
  UNION ALL SELECT 2000000, -100e0, 0e0, 60e0, 60e0, 0e0)"""


@query("point_in_cell_sizes", sql([OBS, GRID, _SIZES], f"SELECT o.obs_id, g.id FROM obs o LEFT JOIN sized g ON {IN_CELL}"))
def q_point_in_cell_sizes(spark, sf):
    """J2 on a grid whose cells differ in size by five orders of magnitude."""
    pts = fx.obs(spark, sf).select("obs_id", "latitude", "longitude")
    x0, y0, w, h, s = (F.col(c) for c in ("x0", "y0", "w", "h", "shear"))
    c = fx.grid_corners(spark, sf).select("id", *[x.cast("double") for x in (x0, y0, w, h, s)])
    zero = F.lit(0.0)
    small = c.where("id % 10 = 0").select((F.col("id") + 1000000).alias("id"), (x0 + w * 0.3).alias("x0"), (y0 + h * 0.3).alias("y0"),
                                          (w / 400).alias("w"), (h / 400).alias("h"), zero.alias("shear"))
    large = spark.createDataFrame([(2000000, -100.0, 0.0, 60.0, 60.0, 0.0)], c.schema)
    cells = c.unionByName(small).unionByName(large)
    pt = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    ring = F.array(pt(x0, y0), pt(x0 + w, y0), pt(x0 + w + s, y0 + h), pt(x0 + s, y0 + h), pt(x0, y0))
    return within_cells(pts, cells.select(F.col("id").cast("bigint").alias("id"), ring.alias("ring"))).select("obs_id", "id")


@query("raster_nearest_shuffled", sql([OBS, RASTER, *nearest_ctes("obs", ["obs_id"], "n")],
                                      "SELECT o.obs_id, n.inferred_depth FROM obs o LEFT JOIN n_nr n USING (obs_id)"))
def q_raster_nearest_shuffled(spark, sf):
    """J1 with a raster packed once and beyond the broadcast limit: its blocks are shuffled."""
    packed = pack_raster(fx.raster(spark, sf), _scratch(spark, "packed"))
    pts = fx.obs(spark, sf).select("obs_id", "latitude", "longitude")
    return nearest_raster(pts, packed, broadcast_limit=0).select("obs_id", "inferred_depth")
