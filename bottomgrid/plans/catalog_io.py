"""Queries for sources, sinks, streams and the two scheduled runs. Each
writes under the session's shared checkpoint folder (a fresh sub-folder per
call) and returns what it reads back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from . import fixtures as fx
from .queries import GRID, LOCATED, OBS, RASTER, daily_cte, located, nearest_ctes, query, rounded, sql
from .runs import product_frame, run_step1, run_step2
from ..operators.qc import seabed_check
from ..operators.runlog import feed_counts
from ..operators.spatial import nearest_raster, within_cells
from ..registry import feed as registry_feed
from ..session import scratch_path
from ..sinks.logs import append_diagnostics, append_run_log, diagnostics_rows, read_log, run_log_rows
from ..sinks.publish import export_catalogue, log_archive, publish_days, stage
from ..sinks.snapshots import archive, read_snapshot
from ..sources.dims import read_grid, read_raster
from ..sources.feeds import read_feeds, read_sideload
from ..sources.staged import read_previous, read_staged
from ..streaming.publish_stream import publish_stream, refresh


def _scratch(spark, name: str) -> str:
    return scratch_path(spark, "queries", f"{name}-{uuid.uuid4().hex[:12]}")


# Oracle of the published product: A4 -> epoch day -> gross range -> narrow.
def product_body(src: str = "d0", where: str = "") -> str:
    cond = "depth > 1 AND depth < 900 AND temperature > 0 AND temperature < 27"
    if where:
        cond = f"{cond} AND {where}"
    f = lambda c: f"CAST({c} AS FLOAT) AS {c}"
    ms = []
    for m in ("temperature", "dissolved_oxygen", "salinity"):
        ms += [f(m), f(f"{m}_min"), f(f"{m}_max"), f(f"{m}_std"), f"{m}_count"]
    return f"""SELECT CAST(date_diff('day', DATE '1970-01-01', time) AS INTEGER) AS time,
  CAST(year(time) AS INTEGER) AS year, CAST(month(time) AS INTEGER) AS month, grid_id,
  {f('latitude')}, {f('longitude')}, CAST(fishery_dependent AS SMALLINT) AS fishery_dependent,
  stat_area, CAST(trunc(depth) AS BIGINT) AS depth, {', '.join(ms)}, data_provider
FROM {src} WHERE {cond}"""


PRODUCT_SQL = sql([OBS, GRID, LOCATED, daily_cte("d0", rounded_=False)], product_body())


def _read_product(spark, path):
    return spark.read.parquet(path)


# ---------------------------------------------------------------------------
# sinks
# ---------------------------------------------------------------------------

@query("stage_roundtrip", sql([OBS, GRID, LOCATED], """
SELECT id, time, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude,
  round(temperature, 6) AS temperature, data_provider, stat_area FROM located"""))
def q_stage_roundtrip(spark, sf):
    """K1: point-in-cell rows (unlocated ones included) staged; rows without
    a cell are dropped by the stage itself; read back through S8."""
    from ..operators.spatial import attach_cell
    g = fx.grid(spark, sf)
    rows = attach_cell(within_cells(fx.obs(spark, sf), g), g)
    path = _scratch(spark, "stage")
    stage(rows, path)
    return rounded(read_staged(spark, path).select(
        "id", "time", "latitude", "longitude", "temperature", "data_provider", "stat_area"))


# A re-published day is replaced as a whole; a day the new run has no rows
# for keeps its old content.
REPLACED_DAYS = ("SELECT * FROM old_p WHERE time NOT IN (SELECT time FROM new_p)\n"
                 "UNION ALL SELECT * FROM new_p")

REPUBLISH_LO, REPUBLISH_HI = "2024-01-10", "2024-01-15"
_IN_WIN = f"time BETWEEN DATE '{REPUBLISH_LO}' AND DATE '{REPUBLISH_HI}'"


@query("publish_days", sql([OBS, GRID, LOCATED, daily_cte("full_d", rounded_=False),
                            "sub AS (SELECT * FROM located WHERE data_provider <> 'error')",
                            daily_cte("sub_d", src="sub", rounded_=False),
                            f"old_p AS ({product_body('full_d')})",
                            f"new_p AS ({product_body('sub_d', _IN_WIN)})"],
                           REPLACED_DAYS))
def q_publish_days(spark, sf):
    """K3: publish every day, then publish a corrected run for six days only
    (fewer rows): those days are replaced, all other days stay as they were."""
    loc = located(spark, sf)
    path = _scratch(spark, "product")
    publish_days(product_frame(loc), path)
    day = F.to_date("time")
    corrected = loc.where((F.col("data_provider") != "error")
                          & day.between(F.lit(REPUBLISH_LO).cast("date"), F.lit(REPUBLISH_HI).cast("date")))
    publish_days(product_frame(corrected), path)
    return _read_product(spark, path)


ARCHIVE_AT = dt.datetime(2024, 2, 1, 6, 30)


@query("archive_snapshot", sql([OBS, GRID, LOCATED, daily_cte("d0", rounded_=False),
                                f"p AS ({product_body()})"], f"""
SELECT p.*, '2.0' AS version, TIMESTAMP '{ARCHIVE_AT:%Y-%m-%d %H:%M:%S}' AS archive_time,
  '10.5281/zenodo.123' AS doi, 'https://zenodo.org/records/123' AS citation_url FROM p"""))
def q_archive_snapshot(spark, sf):
    """K4: the whole previous product snapshotted with version, archive time,
    doi and citation URL; read back from the snapshot folder."""
    prod = _scratch(spark, "product")
    publish_days(product_frame(located(spark, sf)), prod)
    snap, _size = archive(spark, prod, _scratch(spark, "archive"), "2.0", ARCHIVE_AT, "10.5281/zenodo.123")
    return read_snapshot(spark, snap)


_SECOND_AT = dt.datetime(2024, 2, 2, 6, 30)


@query("archive_changed_days", sql([
    OBS, GRID, LOCATED, daily_cte("d0", rounded_=False), f"p AS ({product_body()})",
    "late AS (SELECT * FROM located WHERE time >= TIMESTAMP '2024-01-20 00:00:00' AND data_provider <> 'error')",
    daily_cte("d1", src="late", rounded_=False), f"q AS ({product_body('d1')})"], f"""
SELECT p.*, '1.0' AS version, TIMESTAMP '{ARCHIVE_AT:%Y-%m-%d %H:%M:%S}' AS archive_time, '' AS doi, '' AS citation_url FROM p
UNION ALL
SELECT q.*, '2.0', TIMESTAMP '{_SECOND_AT:%Y-%m-%d %H:%M:%S}', '', '' FROM q
UNION ALL
SELECT p.*, '2.0', TIMESTAMP '{_SECOND_AT:%Y-%m-%d %H:%M:%S}', '', '' FROM p WHERE time NOT IN (SELECT time FROM q)"""))
def q_archive_changed_days(spark, sf):
    """K4 twice: some days are published anew between two snapshots; the
    second copies only those, and both read back whole."""
    prod, root = _scratch(spark, "product"), _scratch(spark, "archive")
    loc = located(spark, sf)
    publish_days(product_frame(loc), prod)
    first, _ = archive(spark, prod, root, "1.0", ARCHIVE_AT)
    late = F.col("time") >= F.lit("2024-01-20").cast("timestamp_ntz")
    publish_days(product_frame(loc.where(late & (F.col("data_provider") != "error"))), prod)
    second, _ = archive(spark, prod, root, "2.0", _SECOND_AT)
    return read_snapshot(spark, first).unionByName(read_snapshot(spark, second))


@query("archive_catalogue", f"""
SELECT '2.0' AS version, '10.5281/zenodo.123' AS doi, 'daily' AS reload_type,
  DATE '{ARCHIVE_AT:%Y-%m-%d}' AS time, 'archive_date={ARCHIVE_AT:%Y-%m-%d}' AS file_name,
  true AS has_size, 'https://zenodo.org/records/123' AS citation_url,
  (SELECT count(*) FROM events) > 0 AS has_rows""")
def q_archive_catalogue(spark, sf):
    """K4 + K5: archive the product, append the catalogue row, export the
    public catalogue as CSV and read it back."""
    prod = _scratch(spark, "product")
    publish_days(product_frame(located(spark, sf)), prod)
    snap, size = archive(spark, prod, _scratch(spark, "archive"), "2.0", ARCHIVE_AT, "10.5281/zenodo.123")
    cat = _scratch(spark, "catalogue")
    log_archive(spark, cat, snap, snap, ARCHIVE_AT, "2.0", "10.5281/zenodo.123", "daily", size)
    out = _scratch(spark, "catalogue_csv")
    export_catalogue(spark.read.parquet(cat), out)
    rows = read_snapshot(spark, snap).count()
    csv = spark.read.option("header", True).csv(out)
    return csv.select("version", "doi", "reload_type", F.to_date("time").alias("time"),
                      F.element_at(F.split("file_url", "/"), -1).alias("file_name"),
                      (F.col("file_size_mb").cast("double") >= 0).alias("has_size"),
                      "citation_url", F.lit(rows > 0).alias("has_rows"))


RUNS = (dt.datetime(2024, 1, 30, 5, 0), dt.datetime(2024, 1, 31, 5, 0))


def _runlog_oracle() -> str:
    body = []
    for r in RUNS:
        body.append(f"""SELECT c.dataset_id, c.observation_count, c.post_filter_count,
  TIMESTAMP '{r:%Y-%m-%d %H:%M:%S}' AS runtime, '1' AS version, CAST(NULL AS VARCHAR) AS data_provider,
  'tabledap' AS file_protocol, 'daily' AS reload_type, 1 AS fetch_erddap_success,
  CAST(0.0 AS DOUBLE) AS execution_time_seconds, '' AS doi FROM c""")
    return sql([OBS, RASTER, *nearest_ctes("obs", ["obs_id"], "n"), """c AS (
  SELECT o.dataset_id, count(*) AS observation_count,
    count(*) FILTER (WHERE o.depth IS NOT NULL AND n.inferred_depth IS NOT NULL
                     AND o.depth - n.inferred_depth < 20) AS post_filter_count
  FROM obs o LEFT JOIN n_nr n USING (obs_id) GROUP BY 1)"""], "\nUNION ALL\n".join(body))


@query("runlog_append", _runlog_oracle())
def q_runlog_append(spark, sf):
    """A8 -> K2: per-feed raw/kept counts of two runs appended to the run
    log and read back."""
    o = fx.obs(spark, sf)
    kept = seabed_check(nearest_raster(o.select("dataset_id", "latitude", "longitude", "depth"),
                                       fx.raster(spark, sf)), "depth")
    counts = feed_counts(o, kept)
    path = _scratch(spark, "runlog")
    for r in RUNS:
        for _ in range(2):      # the second time as a retry of the same run: it adds nothing
            append_run_log(run_log_rows(counts, r, "1", "daily"), path, run_id=f"{r:%Y%m%d}")
    return read_log(spark, path)


@query("diagnostics_append", sql([OBS, GRID, LOCATED, daily_cte("d0", rounded_=False),
                                  f"p AS ({product_body()})"], """
SELECT TIMESTAMP '2024-02-01 06:30:00' AS runtime, 'step2' AS program, '1' AS version,
  CAST((SELECT count(DISTINCT time) FROM p) AS INTEGER) AS nc_files_created,
  ['aggregate', 'publish'] AS phases"""))
def q_diagnostics_append(spark, sf):
    """K6: a diagnostics row from a real publish (files = days written),
    per-phase seconds as JSON; timings are not compared, their keys are."""
    path = _scratch(spark, "product")
    days = publish_days(product_frame(located(spark, sf)), path)
    diag = _scratch(spark, "diagnostics")
    append_diagnostics(diagnostics_rows(spark, ARCHIVE_AT, "step2", "1", 1.0,
                                        {"aggregate": 0.5, "publish": 0.5}, len(days)), diag)
    d = spark.read.parquet(diag)
    keys = F.array_sort(F.map_keys(F.from_json("phase_durations", "map<string,double>")))
    return d.select("runtime", "program", "version", "nc_files_created", keys.alias("phases"))


# ---------------------------------------------------------------------------
# sources
# ---------------------------------------------------------------------------

FEED_LO, FEED_HI = dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 25, 23, 59, 59)


def land_feeds(spark, sf, root: str) -> None:
    """Write three registry feeds shaped from obs, as a provider would land
    them (extra constraint columns, a unit-suffixed header, text time)."""
    o = fx.obs(spark, sf)
    (o.select("time", "latitude", "longitude", "temperature",
              F.col("tow_id").cast("string").alias("tow_id"), "depth",
              F.when(F.col("dataset_id") == "error", 2).otherwise(3).alias("segment_type"))
      .write.mode("overwrite").parquet(f"{root}/eMOLT_RT"))
    (o.select(F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("UTC_DATETIME"), "latitude",
              "longitude", F.col("temperature").alias("sea_water_temperature (degree_C)"),
              F.col("depth").alias("pressure_dbars"), "dissolved_oxygen",
              F.col("salinity").alias("sea_water_salinity"),
              F.col("tow_id").cast("int").alias("cast_number"), F.col("dataset_id").alias("cruise_id"),
              F.when(F.col("dataset_id") == "view", "Bottle").otherwise("CTD").alias("GEAR_TYPE"))
      .write.mode("overwrite").parquet(f"{root}/ocdbs_v_erddap1"))
    (o.select("time", "latitude", "longitude", F.col("temperature").alias("temp"), "depth",
              F.col("tow_id").cast("int").alias("profile_number"),
              F.col("dataset_id").alias("cruise_num"),
              F.when(F.col("dataset_id") == "click", 0).otherwise(1).alias("hit_bottom"),
              F.year("time").alias("start_year"))
      .write.mode("overwrite").parquet(f"{root}/oleanderXbt"))


_WIN = f"time >= TIMESTAMP '{FEED_LO:%Y-%m-%d %H:%M:%S}' AND time <= TIMESTAMP '{FEED_HI:%Y-%m-%d %H:%M:%S}'"


@query("registry_scan", sql([OBS], f"""
SELECT 'eMOLT_RT' AS dataset_id, time, latitude, longitude FROM obs
  WHERE dataset_id <> 'error' AND {_WIN}
UNION ALL
SELECT 'ocdbs_v_erddap1', date_trunc('second', time), latitude, longitude FROM obs
  WHERE dataset_id <> 'view' AND latitude > 34
    AND date_trunc('second', time) >= TIMESTAMP '{FEED_LO:%Y-%m-%d %H:%M:%S}'
    AND date_trunc('second', time) <= TIMESTAMP '{FEED_HI:%Y-%m-%d %H:%M:%S}'
UNION ALL
SELECT 'oleanderXbt', time, latitude, longitude FROM obs
  WHERE dataset_id <> 'click' AND latitude >= 38.18 AND latitude <= 41.04
    AND longitude >= -74.12 AND longitude <= -71.26 AND year(time) > 1999 AND {_WIN}"""))
def q_registry_scan(spark, sf):
    """S1 (+ S2, S3, S4): scan every registered feed under a landing root;
    three are landed, the rest are missing and only get a status."""
    root = _scratch(spark, "landing")
    land_feeds(spark, sf, root)
    scans = read_feeds(spark, root, FEED_LO, FEED_HI)
    frames = [s.frame.select(F.lit(fid).alias("dataset_id"), "time", "latitude", "longitude")
              for fid, s in scans.items() if s.frame is not None]
    from ..operators.union import union_feeds
    return union_feeds(frames)


SIDE_LO = dt.datetime(2024, 1, 10)


@query("sideload", sql([OBS, GRID, LOCATED], f"""
SELECT id, time, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, stat_area,
  round(depth, 6) AS depth, round(temperature, 6) AS temperature, data_provider
FROM located WHERE time > TIMESTAMP '{SIDE_LO:%Y-%m-%d %H:%M:%S}'"""))
def q_sideload(spark, sf):
    """A CSV that already carries the cell id: position dropped, cell
    centroid/area/depth joined, strict ``time > start``."""
    path = _scratch(spark, "sideload")
    (located(spark, sf)
     .select("id", F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("time"),
             "latitude", "longitude", "temperature", "salinity", "dissolved_oxygen",
             "data_provider", "fishery_dependent")
     .write.option("header", True).csv(path))
    s = read_sideload(spark, path, fx.grid(spark, sf), SIDE_LO)
    return rounded(s.select("id", "time", "latitude", "longitude", "stat_area", "depth",
                            "temperature", "data_provider"))


@query("grid_load", sql([GRID], """
SELECT id, CAST(stat_area AS BIGINT) AS stat_area, depth, round(centroid_lon, 6) AS centroid_lon,
  round(centroid_lat, 6) AS centroid_lat, 5 AS n_vertices FROM grid"""))
def q_grid_load(spark, sf):
    """Grid cells landed as Parquet rings, read back with validation."""
    path = _scratch(spark, "grid")
    fx.grid(spark, sf).write.parquet(path)
    g = read_grid(spark, path, check_unique=True)
    return rounded(g.select("id", "stat_area", "depth", "centroid_lon", "centroid_lat",
                            F.size("ring").alias("n_vertices")))


@query("raster_scan", sql([RASTER], """
SELECT lat_idx, lon_idx, round(lat, 6) AS lat, round(lon, 6) AS lon, elevation,
  (SELECT count(DISTINCT lat_idx) FROM raster) AS n_lat FROM raster"""))
def q_raster_scan(spark, sf):
    """The bathymetry long table read back, with its latitude axis size."""
    path = _scratch(spark, "raster")
    fx.raster(spark, sf).write.parquet(path)
    r, packed = read_raster(spark, path)
    return rounded(r.withColumn("n_lat", F.lit(packed.axes.lat.n).cast("bigint")))


@query("previous_product", PRODUCT_SQL)
def q_previous_product(spark, sf):
    """The published product scanned whole."""
    path = _scratch(spark, "product")
    publish_days(product_frame(located(spark, sf)), path)
    return read_previous(spark, path)


@query("product_recent_published", sql([OBS, GRID, LOCATED, daily_cte("d0", rounded_=False),
                                        f"p AS ({product_body()})"], """
SELECT time, temperature, stat_area FROM p
WHERE time >= (SELECT max(time) FROM p) - 14 AND time <= (SELECT max(time) FROM p)"""))
def q_product_recent_published(spark, sf):
    """S10 on the published product: the last 14 days of temperature and
    area, read with partition pruning on the day folders."""
    path = _scratch(spark, "product")
    publish_days(product_frame(located(spark, sf)), path)
    prod = read_previous(spark, path)
    last = prod.agg(F.max("time")).first()[0]
    now = dt.date(1970, 1, 1) + dt.timedelta(days=int(last))
    from ..sources.staged import recent
    return recent(prod, ["time", "temperature", "stat_area"], 14, now)


# ---------------------------------------------------------------------------
# streams and the scheduled runs
# ---------------------------------------------------------------------------

@query("stream_publish", PRODUCT_SQL)
def q_stream_publish(spark, sf):
    """Staged rows land -> the file stream recomputes the touched days
    from all staged rows -> the product is published."""
    staged = _scratch(spark, "staged")
    stage(located(spark, sf), staged)
    prod = _scratch(spark, "product")
    publish_stream(spark, staged, prod).awaitTermination()
    return _read_product(spark, prod)


REFRESH_RUN = dt.date(2024, 1, 20)
_REFRESH_WIN = "time BETWEEN DATE '2024-01-15' AND DATE '2024-01-20'"


@query("refresh_publish", sql([OBS, GRID, LOCATED, daily_cte("full_d", rounded_=False),
                               "sub AS (SELECT * FROM located WHERE data_provider <> 'error')",
                               daily_cte("sub_d", src="sub", rounded_=False),
                               f"old_p AS ({product_body('sub_d')})",
                               f"new_p AS ({product_body('full_d', _REFRESH_WIN)})"],
                              REPLACED_DAYS))
def q_refresh_publish(spark, sf):
    """A stale product (one provider's rows missing) is refreshed on
    2024-01-20: the daily window (5 days back) is recomputed from all staged
    rows, older days keep their stale content."""
    loc = located(spark, sf)
    staged = _scratch(spark, "staged")
    stage(loc, staged)
    prod = _scratch(spark, "product")
    publish_days(product_frame(loc.where(F.col("data_provider") != "error")), prod)
    refresh(spark, staged, prod, REFRESH_RUN)
    return _read_product(spark, prod)


RUN_DATE = dt.date(2024, 1, 25)
_STEP1_LO = "TIMESTAMP '2024-01-20 00:00:00'"
_STEP1_HI = "TIMESTAMP '2024-01-25 23:59:59.999999'"
_IN_CELL_S = ("s.latitude > g.y0 AND s.latitude < g.y0 + g.h "
              "AND s.longitude > g.x0 + (s.latitude - g.y0) * g.shear / g.h "
              "AND s.longitude < g.x0 + g.w + (s.latitude - g.y0) * g.shear / g.h")
_STAGED_COLS = ("dataset_id, time, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, "
                "round(temperature, 6) AS temperature, round(dissolved_oxygen, 6) AS dissolved_oxygen, "
                "data_provider, fishery_dependent, id, stat_area, round(depth, 6) AS depth, source_ord")

FETCH_AND_STAGE_SQL = sql([
    OBS.replace("obs AS", "obs_all AS", 1),
    f"obs AS (SELECT * FROM obs_all WHERE time >= {_STEP1_LO} AND time <= {_STEP1_HI})",
    GRID, RASTER,
    """e_h AS (
  SELECT CAST(tow_id AS VARCHAR) AS tow_id, date_trunc('hour', time) AS time, avg(latitude) AS latitude,
    avg(longitude) AS longitude, avg(temperature) AS temperature, avg(depth) AS depth
  FROM obs WHERE tow_id IS NOT NULL AND dataset_id <> 'error' GROUP BY 1, 2)""",
    *nearest_ctes("e_h", ["tow_id", "time"], "n"),
    """std AS (
  SELECT 'eMOLT_RT' AS dataset_id, h.time, h.latitude, h.longitude, h.temperature,
    CAST(NULL AS DOUBLE) AS dissolved_oxygen, 'eMOLT' AS data_provider, 1 AS fishery_dependent
  FROM e_h h JOIN n_nr n USING (tow_id, time)
  WHERE h.depth IS NOT NULL AND n.inferred_depth IS NOT NULL AND h.depth - n.inferred_depth < 20
  UNION ALL
  SELECT 'fixed_gear_oceanography', time, latitude, longitude, temperature, dissolved_oxygen, 'CFRF', 1
  FROM (SELECT *, avg(dissolved_oxygen) OVER (PARTITION BY tow_id) AS mu,
          stddev_samp(dissolved_oxygen) OVER (PARTITION BY tow_id) AS sd FROM obs)
  WHERE NOT (tow_id IS NOT NULL AND coalesce(abs(dissolved_oxygen - mu) > 3 * sd, false))
  UNION ALL
  SELECT 'wind_farm_acoustic_receivers', time, latitude, longitude, temperature,
    CAST(NULL AS DOUBLE), 'CFRF', 0 FROM obs)""",
    f"""gridded AS (
  SELECT s.dataset_id, s.time, g.centroid_lat AS latitude, g.centroid_lon AS longitude, s.temperature,
    s.dissolved_oxygen, s.data_provider, s.fishery_dependent, g.id, g.stat_area, g.depth, 2 AS source_ord
  FROM std s JOIN grid g ON {_IN_CELL_S})""",
    f"""side AS (
  SELECT CAST(NULL AS VARCHAR) AS dataset_id, s.time, g.centroid_lat AS latitude,
    g.centroid_lon AS longitude, s.temperature, s.dissolved_oxygen, s.data_provider,
    s.fishery_dependent, g.id, g.stat_area, g.depth, 0 AS source_ord
  FROM obs_all s JOIN grid g ON {_IN_CELL_S}
  WHERE s.time > {_STEP1_LO})"""],
    f"SELECT {_STAGED_COLS} FROM gridded UNION ALL SELECT {_STAGED_COLS} FROM side")


def land_step1_feeds(spark, sf, root: str) -> None:
    """Land three registry feeds shaped from obs, as providers deliver them."""
    o = fx.obs(spark, sf)
    (o.select("time", "latitude", "longitude", "temperature",
              F.col("tow_id").cast("string").alias("tow_id"), "depth",
              F.when(F.col("dataset_id") == "error", 2).otherwise(3).alias("segment_type"))
      .write.mode("overwrite").parquet(f"{root}/{registry_feed('eMOLT_RT').feed_id}"))
    (o.select("time", "latitude", "longitude", "temperature", "dissolved_oxygen", "tow_id")
      .write.mode("overwrite").parquet(f"{root}/fixed_gear_oceanography"))
    (o.select("time", "latitude", "longitude", F.col("dataset_id").alias("station_id"), "temperature")
      .write.mode("overwrite").parquet(f"{root}/wind_farm_acoustic_receivers"))


@query("fetch_and_stage", FETCH_AND_STAGE_SQL)
def q_fetch_and_stage(spark, sf):
    """Refresh window for 2024-01-25 (daily, from 2024-01-20) -> scan the
    registry (three feeds landed, the others missing) -> standardize (C1, C4,
    C5) -> union -> grid assignment -> union with a side-loaded CSV that
    carries cell ids (strict ``time > start``) -> stage + run log; the staged
    rows are read back."""
    root = _scratch(spark, "landing")
    land_step1_feeds(spark, sf, root)
    csv = _scratch(spark, "gmgi")
    (located(spark, sf)
     .select("id", F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("time"),
             "latitude", "longitude", "temperature", "salinity", "dissolved_oxygen",
             "data_provider", "fishery_dependent")
     .write.option("header", True).csv(csv))
    from ..sources.feeds import SIDELOAD_SCHEMA
    gmgi = spark.read.schema(SIDELOAD_SCHEMA).option("header", True).csv(csv)
    staged = _scratch(spark, "staged")
    run_step1(spark, root, fx.grid(spark, sf), fx.raster(spark, sf), RUN_DATE, staged,
              _scratch(spark, "runlog"), sideloads={"gmgi": gmgi})
    s = spark.read.parquet(staged)
    return rounded(s.select("dataset_id", "time", "latitude", "longitude", "temperature",
                            "dissolved_oxygen", "data_provider", "fishery_dependent", "id",
                            "stat_area", "depth", "source_ord"))


@query("incremental_publish", PRODUCT_SQL)
def q_incremental_publish(spark, sf):
    """T2 incremental: the feeds arrive as three batches (by provider, so the
    same cell-day gets partials from several batches); each batch stores its
    daily partials and re-publishes its days from the merge of all partials.
    The result equals the product computed from all rows at once."""
    from ..sinks.publish import stage_append
    from ..streaming.incremental import incremental_stream
    loc = located(spark, sf)
    staged, parts = _scratch(spark, "staged"), _scratch(spark, "partials")
    prod, ckpt = _scratch(spark, "product"), _scratch(spark, "incremental-ckpt")
    for providers in (["view", "click"], ["purchase"], ["signup", "error"]):
        stage_append(loc.where(F.col("data_provider").isin(providers)), staged)
        incremental_stream(spark, staged, parts, prod, checkpoint=ckpt).awaitTermination()
    return _read_product(spark, prod)


@query("incremental_folded", PRODUCT_SQL)
def q_incremental_folded(spark, sf):
    """T2 incremental whose partials are folded: one batch per provider, and
    a day's deltas become its base as soon as there are two of them."""
    from ..sinks.publish import stage_append
    from ..streaming.incremental import incremental_stream
    loc = located(spark, sf)
    staged, parts = _scratch(spark, "staged"), _scratch(spark, "partials")
    prod, ckpt = _scratch(spark, "product"), _scratch(spark, "incremental-ckpt")
    for provider in ("view", "click", "purchase", "signup", "error"):
        stage_append(loc.where(F.col("data_provider") == provider), staged)
        incremental_stream(spark, staged, parts, prod, checkpoint=ckpt, fold_after=2).awaitTermination()
    return _read_product(spark, prod)


@query("aggregate_and_publish", PRODUCT_SQL)
def q_aggregate_and_publish(spark, sf):
    """C13 (flagship job): staged rows -> daily cell statistics -> epoch
    day -> gross range -> narrow -> metadata -> publish by day; run twice so
    the second run archives the first product (K4, K5) and logs (K6)."""
    staged = _scratch(spark, "staged")
    stage(located(spark, sf), staged)
    prod, arch = _scratch(spark, "product"), _scratch(spark, "archive")
    cat, diag = _scratch(spark, "catalogue"), _scratch(spark, "diagnostics")
    for _ in range(2):
        run_step2(spark, staged, prod, arch, cat, diag, now=ARCHIVE_AT)
    return _read_product(spark, prod)
