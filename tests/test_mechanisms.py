"""Hierarchical tiles, blocked rasters, pruned windows, narrow arg-max,
changed-day snapshots, file quarantine and keyed appends."""

import contextlib
import datetime as dt
import io
import random

import pytest
from pyspark.sql import functions as F

from bottomgrid.operators.reduce import deepest, rows_have_numbers
from bottomgrid.operators.spatial import assign_grid, grid_tiles, nearest_raster, open_packed, pack_raster, within_cells
from bottomgrid.plans import fixtures as fx
from bottomgrid.plans.queries import located
from bottomgrid.plans.runs import fetch_feeds, product_frame, quarantine_path, run_step1
from bottomgrid.plans.standardize import Dims
from bottomgrid.registry import FEEDS, Feed, feed
from bottomgrid.sinks.logs import append_diagnostics, append_run_log, diagnostics_rows, read_log, run_log_rows
from bottomgrid.sinks.publish import publish_days
from bottomgrid.sinks.snapshots import archive, manifest, read_snapshot
from bottomgrid.sources.feeds import scan_feed

SF = "/root/testdata/sf0.001"
GRID = "id long, ring array<struct<x:double,y:double>>, stat_area long, depth double, centroid_lon double, centroid_lat double"


def plan_of(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


# --- J2 --------------------------------------------------------------------

def box(i, x, y, w, h):
    ring = [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]
    return i, ring, i % 7, float(i), x + w / 2, y + h / 2


def plain_cells(points, cells):
    out = []
    for k, lon, lat in points:
        hit = [i for i, ring, *_ in cells if lon is not None and lat is not None
               and ring[0][0] < lon < ring[1][0] and ring[0][1] < lat < ring[2][1]]
        out += [(k, i) for i in hit] or [(k, None)]
    return sorted(out, key=str)


def test_cells_of_all_sizes(spark):
    rnd = random.Random(7)
    even = [box(i, (i % 30) * 0.1, (i // 30) * 0.1, 0.1, 0.1) for i in range(600)]
    odd = [box(1000, -50.0, -50.0, 100.0, 100.0),                       # 1,000 times larger: holds everything
           box(1001, 1.0, 1.0, 1.5, 0.2), box(1002, 0.21, 0.21, 0.0001, 0.0001), box(1003, 0.2101, 0.2101, 1e-7, 1e-7),
           box(1004, 2.0, 0.5, 30.0, 0.01), box(1005, 0.5, 0.5, 0.0, 0.0)]
    points = [(k, rnd.uniform(-1, 4), rnd.uniform(-1, 3)) for k in range(400)]
    points += [(400, 0.21005, 0.21005), (401, 0.21010005, 0.21010005), (402, None, 1.0), (403, 60.0, 60.0), (404, 0.1, 0.05),
               (405, 10.0, 0.505), (406, 0.5, 0.5)]
    pts = spark.createDataFrame(points, "k long, longitude double, latitude double")
    tiles = grid_tiles(spark.createDataFrame(even, GRID))
    assert tiles.broadcast and not tiles.others
    for cells in (even, even + odd[:1], even + odd, odd):
        grid = spark.createDataFrame(cells, GRID)
        for limit in (None, 0):
            gt = grid_tiles(grid, broadcast_limit=limit)
            got = sorted(map(tuple, within_cells(pts, gt).select("k", "id").collect()), key=str)
            assert got == plain_cells(points, cells)
        inner = sorted(map(tuple, within_cells(pts, grid, how="inner").select("k", "id").collect()), key=str)
        assert inner == [x for x in plain_cells(points, cells) if x[1] is not None]
        for r in assign_grid(pts, grid).collect():
            assert (r.stat_area, r.depth) == (r.id % 7, float(r.id)) and r.latitude is not None
    # one giant cell neither multiplies the tile rows nor loses the broadcast
    gt = grid_tiles(spark.createDataFrame(even + odd[:1], GRID))
    assert gt.broadcast and all(o.broadcast for o in gt.others)
    assert gt.tiles.count() <= tiles.tiles.count() and gt.others[0].tiles.count() <= 4
    assert grid_tiles(spark.createDataFrame([], GRID)).cells == 0
    assert within_cells(pts, spark.createDataFrame([], GRID)).where("id IS NOT NULL").count() == 0


# --- J1 --------------------------------------------------------------------

RASTER = "lat_idx long, lon_idx long, lat double, lon double, elevation int"


def test_blocks_hold_every_cell(spark, tmp_out):
    rnd = random.Random(3)
    cells = {(i, j): rnd.randint(-500, 500) for i in range(-70, 75) for j in range(130) if rnd.random() < 0.9 or i % 60 == 0}
    for j in range(130):
        cells.setdefault((0, j), 1)
    rows = [(i, j, i * 0.5, 10 + j * 0.25, v) for (i, j), v in cells.items()]
    raster = spark.createDataFrame(rows, RASTER)
    packed = pack_raster(raster, f"{tmp_out}/packed")
    assert packed.blocks == 4 * 3 and packed.axes.cells == len(rows)
    pts = [(k, rnd.uniform(-40, 40), rnd.uniform(5, 45)) for k in range(300)]
    df = spark.createDataFrame(pts, "k long, latitude double, longitude double")

    def near(x, lo, n, step, first):
        return min(range(n), key=lambda i: (abs(x - (lo + i * step)), -i)) + first

    want = [(k, abs(v) if (v := cells.get((near(a, -35.0, 145, 0.5, -70), near(b, 10.0, 130, 0.25, 0)))) is not None else None)
            for k, a, b in pts]
    for r in (raster, packed, open_packed(spark, f"{tmp_out}/packed")):
        for limit in (None, 0):       # blocks broadcast, and shuffled
            got = nearest_raster(df, r, broadcast_limit=limit).select("k", "inferred_depth")
            assert sorted(map(tuple, got.collect())) == want
    with pytest.raises(ValueError, match="twice"):
        pack_raster(raster.unionByName(raster.limit(1)))
    with pytest.raises(ValueError, match="empty"):
        pack_raster(raster.limit(0))


def test_raster_is_read_once(spark, tmp_out):
    """The written raster is gone once it is packed; the join still works."""
    from bottomgrid.session import delete_path
    raster = fx.raster(spark, SF)
    raster.write.parquet(f"{tmp_out}/raster")
    packed = pack_raster(spark.read.parquet(f"{tmp_out}/raster"), f"{tmp_out}/packed")
    delete_path(spark, f"{tmp_out}/raster")
    pts = fx.obs(spark, SF).select("obs_id", "latitude", "longitude")
    want = nearest_raster(pts, raster).select("obs_id", "inferred_depth")
    assert sorted(map(tuple, nearest_raster(pts, packed).select("obs_id", "inferred_depth").collect()), key=str) == \
        sorted(map(tuple, want.collect()), key=str)
    assert plan_of(nearest_raster(pts, packed), "simple").count("FileScan") <= 6


# --- S3 --------------------------------------------------------------------

FIXED = feed("fixed_gear_oceanography")
LO, HI = dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 12, 23, 59, 59)


def _gear(spark):
    return fx.obs(spark, SF).select("time", "latitude", "longitude", "temperature", "dissolved_oxygen", "tow_id")


def _values(df):
    return sorted((r.time, r.temperature) for r in df.collect())


def test_window_prunes_day_folders(spark, tmp_out):
    rows = _gear(spark)
    want = _values(rows.where(F.col("time").between(F.lit(str(LO)).cast("timestamp_ntz"), F.lit(str(HI)).cast("timestamp_ntz"))))
    (rows.withColumn("day", F.when(F.dayofyear("time") % 2 == 0, F.to_date("time")))      # half the rows land without a day
     .write.partitionBy("day").parquet(f"{tmp_out}/{FIXED.feed_id}"))
    scan = scan_feed(spark, FIXED, tmp_out, LO, HI)
    assert scan.status == "ok" and _values(scan.frame) == want and want
    filters = [x for x in plan_of(scan.frame).splitlines() if "PartitionFilters" in x]
    assert filters and all("day" in f and "2024-01-10" in f and "2024-01-12" in f for f in filters)


@pytest.mark.parametrize("form", ["yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"])
def test_window_on_text_times_reaches_the_reader(spark, tmp_out, form):
    rows = _gear(spark).withColumn("time", F.date_trunc("second", "time").cast("timestamp_ntz"))
    want = _values(rows.where(F.col("time").between(F.lit(str(LO)).cast("timestamp_ntz"), F.lit(str(HI)).cast("timestamp_ntz"))))
    rows.withColumn("time", F.date_format("time", form)).write.parquet(f"{tmp_out}/{FIXED.feed_id}")
    scan = scan_feed(spark, FIXED, tmp_out, LO, HI)
    assert _values(scan.frame) == want and want
    pushed = [x for x in plan_of(scan.frame).splitlines() if "PushedFilters" in x]
    assert pushed and all("GreaterThanOrEqual(time,2024-01-09)" in f and "LessThan(time,2024-01-14)" in f for f in pushed)


def test_text_window_keeps_other_zones(spark, tmp_out):
    rows = [("2024-01-09T20:00:00-06:00", 1.0), ("2024-01-13T03:00:00+05:00", 2.0), ("2024-01-13T03:00:00Z", 3.0), (None, 4.0)]
    spark.createDataFrame(rows, "time string, temperature double").write.parquet(f"{tmp_out}/{FIXED.feed_id}")
    assert sorted(r.temperature for r in scan_feed(spark, FIXED, tmp_out, LO, HI).frame.collect()) == [1.0, 2.0]
    free = Feed("fixed_gear_oceanography", "x", FIXED.variables, protocol="file")
    assert "GreaterThanOrEqual" not in plan_of(scan_feed(spark, free, tmp_out, LO, HI).frame)


# --- A3 --------------------------------------------------------------------

def test_deepest_sorts_narrow_rows_only(spark, tmp_out):
    rnd = random.Random(2)
    rows = [(rnd.choice(["a", "b", "c", "d", None]), rnd.choice([None, 1.0, 5.0, 9.0, float(k % 3)]), k % 4, k, f"pad{k}" * 5) for k in range(500)]
    rows += [("e", None, 1, 600, "x"), ("f", 2.0, 1, 601, "y"), ("f", 2.0, 1, 602, "z")]
    df = spark.createDataFrame(rows, "key string, value double, tie int, rid int, pad string")
    df.coalesce(1).write.parquet(f"{tmp_out}/wide")
    wide = spark.read.parquet(f"{tmp_out}/wide").withColumn("more", F.upper("pad")).where("rid >= 0")
    assert rows_have_numbers(wide) and not rows_have_numbers(df) and not rows_have_numbers(wide.join(df, "rid"))
    assert not rows_have_numbers(wide.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("x"))) and not rows_have_numbers(wide.unionByName(wide))
    want = sorted((r.key, r.value, r.tie) for r in deepest(df, "key", "value", "tie").collect())
    for limit in (None, 0):
        out = deepest(wide, "key", "value", "tie", broadcast_limit=limit)
        got = out.collect()
        assert out.columns == wide.columns and sorted((r.key, r.value, r.tie) for r in got) == want
        assert [r.rid for r in got if r.key == "f"] == [601]
        plan = plan_of(out, "simple")
        assert "SortAggregate" not in plan and "Sort [" not in plan and "SortMergeJoin" not in plan


# --- K4 --------------------------------------------------------------------

def _snapshot_rows(df):
    return sorted((r.time, r.grid_id, r.temperature, r.data_provider) for r in df.collect())


def test_snapshots_copy_changed_days_only(spark, tmp_out, monkeypatch):
    from bottomgrid.sinks import snapshots
    loc, prod, root = located(spark, SF), f"{tmp_out}/product", f"{tmp_out}/archive"
    publish_days(product_frame(loc), prod)
    want, taken = [], []
    days = [r[0] for r in spark.read.parquet(prod).select("time").distinct().orderBy("time").collect()]
    for k, day in enumerate([None, days[1], days[4], None, days[7]]):
        if day:
            one = loc.where(F.unix_date(F.to_date("time")) == day)
            publish_days(product_frame(one), prod)
        if k == 4:
            monkeypatch.setattr(snapshots, "MAX_LISTED_DAYS", 0)
        want.append(_snapshot_rows(spark.read.parquet(prod)))
        taken.append(archive(spark, prod, root, str(k), dt.datetime(2024, 2, 1 + k)))
    total = spark.read.parquet(prod).select("time").distinct().count()
    for k, (snap, size) in enumerate(taken):
        assert _snapshot_rows(read_snapshot(spark, snap)) == want[k] and size >= 0
        m = manifest(spark, snap)
        new = m.where(F.col("folder").startswith(f"copied=2024-02-{1 + k:02d}")).count()
        assert m.count() == total and new == {0: total, 1: 1, 2: 1, 3: 0, 4: 1}[k]
        assert {r.version for r in read_snapshot(spark, snap).select("version").distinct().collect()} == {str(k)}
    # a second snapshot on a date, after a third publication; one that ends before its manifest is no snapshot
    publish_days(product_frame(loc.where(F.unix_date(F.to_date("time")) == days[2])), prod)
    again, _ = archive(spark, prod, root, "9", dt.datetime(2024, 2, 5, 12))
    assert again == taken[-1][0] and _snapshot_rows(read_snapshot(spark, again)) == _snapshot_rows(spark.read.parquet(prod))
    spark.range(1).write.parquet(f"{again}/manifest=000099/_temporary/x")
    assert _snapshot_rows(read_snapshot(spark, again)) == _snapshot_rows(spark.read.parquet(prod))


# --- S1, C12 ---------------------------------------------------------------

def _corrupt(path):
    with open(path, "r+b") as f:
        f.seek(4)
        f.write(b"\x00" * 64)
        f.seek(-20, 2)
        f.write(b"\xff" * 20)


def test_one_corrupt_file_costs_one_file(spark, tmp_out):
    import glob
    root, log = f"{tmp_out}/landing", f"{tmp_out}/log"
    _gear(spark).repartition(3).write.parquet(f"{root}/{FIXED.feed_id}")
    whole = spark.read.parquet(f"{root}/{FIXED.feed_id}").count()
    bad = sorted(glob.glob(f"{root}/{FIXED.feed_id}/part-*.parquet"))[1]
    lost = spark.read.parquet(bad).count()
    _corrupt(bad)
    for _ in range(2):      # the second time as a retry
        res = run_step1(spark, root, fx.grid(spark, SF), fx.raster(spark, SF), dt.date(2024, 1, 30), f"{tmp_out}/staged", log,
                        force_full=True, run_id="r1")
    assert res.statuses[FIXED.feed_id] == "ok" and [x[0] for x in res.set_aside] == [FIXED.feed_id]
    rows = {r.dataset_id: r for r in spark.read.parquet(log).collect()}
    assert spark.read.parquet(log).count() == len(FEEDS)
    assert rows[FIXED.feed_id].observation_count == whole - lost and rows[FIXED.feed_id].fetch_erddap_success == 1
    aside = spark.read.parquet(quarantine_path(log)).collect()
    assert len(aside) == 1 and aside[0].file.endswith(bad.rsplit("/", 1)[1]) and aside[0].error.startswith("error")


def test_a_location_that_fails_is_one_feeds_status(spark, tmp_out, monkeypatch):
    from bottomgrid.sources import feeds as src
    _gear(spark).write.parquet(f"{tmp_out}/{FIXED.feed_id}")
    real = src.path_exists

    def broken(s, path):
        if path.endswith("eMOLT_RT"):
            raise OSError("file system is away")
        return real(s, path)

    monkeypatch.setattr(src, "path_exists", broken)
    dims = Dims(grid=fx.grid(spark, SF), raster=pack_raster(fx.raster(spark, SF)))
    got = {r.feed_id: r for r in fetch_feeds(spark, tmp_out, LO, HI, dims, f"{tmp_out}/work")}
    assert got["eMOLT_RT"].status.startswith("error: OSError") and got[FIXED.feed_id].status == "ok"
    assert got[FIXED.feed_id].raw > 0 and got["oleanderXbt"].status == "missing"


# --- K2, K6 ----------------------------------------------------------------

def test_a_retried_job_logs_nothing_twice(spark, tmp_out):
    counts = spark.createDataFrame([("a", 3, 2), ("b", 1, 1), (None, 1, 1)],
                                   "dataset_id string, observation_count long, post_filter_count long")
    when = dt.datetime(2024, 2, 1)
    rows = run_log_rows(counts, when, "1", "daily")
    log, diag = f"{tmp_out}/log", f"{tmp_out}/diag"
    rows.write.parquet(log)                                   # a table from before there were run ids
    append_run_log(rows.where("dataset_id = 'a'"), log, "r1")     # the first try ended half way
    for _ in range(2):
        append_run_log(rows, log, "r1")
    append_run_log(rows, log, "r2")
    append_run_log(rows, log)
    assert read_log(spark, log).columns == rows.columns
    assert sorted((r.dataset_id or "", r["count"]) for r in read_log(spark, log).groupBy("dataset_id").count().collect()) == [("", 4), ("a", 4), ("b", 4)]
    one, two = (diagnostics_rows(spark, when, p, "1", 1.0, {}) for p in ("step1", "step2"))
    for _ in range(2):
        append_diagnostics(two, diag, one, run_id="r1")
    assert sorted(r.program for r in read_log(spark, diag).collect()) == ["step1", "step2"]
