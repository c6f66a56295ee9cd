"""Hand-made edge rows, one group per operator (FIXTURES.md §3)."""

import datetime as dt
import math

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bottomgrid.functions.calendar import refresh_window
from bottomgrid.functions.columns import narrow, profile_key, to_standard, with_metadata
from bottomgrid.operators.daily import daily_cell, merge_daily
from bottomgrid.operators.qc import (drop_outliers, gross_range, min_group_size, running_median,
                                     seabed_check, retention_curve)
from bottomgrid.operators.reduce import deepest, hourly_mean
from bottomgrid.operators.spatial import nearest_centroid, nearest_raster, within_cells, albers_xy
from bottomgrid.sources.feeds import apply_constraints, normalize_scan
from bottomgrid.sources.staged import reconcile

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def ts(h=0, m=0, s=0):
    return T0 + dt.timedelta(hours=h, minutes=m, seconds=s)


# --- S4 / S8 / S2 ---------------------------------------------------------------

def test_normalize_scan_units_nan_zone(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00Z", float("nan"), 1.0),
                                ("2024-01-01T05:30:00+02:00", 2.5, 2.0)],
                               "`time (UTC)` string, `temperature (degree_C)` double, extra double")
    out = normalize_scan(df, ["time", "temperature"]).collect()
    assert [r.temperature for r in out] == [None, 2.5]
    assert out[0].time == dt.datetime(2024, 1, 1, 0, 0)
    assert out[1].time == dt.datetime(2024, 1, 1, 3, 30)
    assert "extra" not in normalize_scan(df, ["time", "temperature"]).columns


def test_reconcile_missing_optional_text_number_fraction(spark):
    df = spark.createDataFrame(
        [("2024-01-01 10:00:00", "1.5", "oops", "p", 1, 7, 500),
         ("2024-01-01 10:00:00.250", "2.0", "3.0", "p", 0, 8, 501)],
        "time string, latitude string, temperature string, data_provider string, "
        "fishery_dependent int, id long, stat_area long").withColumn("longitude", F.lit(-70.0))
    out = reconcile(df)
    assert "salinity" not in out.columns and "depth" not in out.columns
    rows = out.orderBy("id").collect()
    assert rows[0].temperature is None and rows[1].temperature == 3.0
    assert rows[0].time == dt.datetime(2024, 1, 1, 10, 0)
    assert rows[1].time == dt.datetime(2024, 1, 1, 10, 0, 0, 250000)
    with pytest.raises(ValueError):
        reconcile(df.drop("stat_area"))


def test_constraints_not_equal_keeps_null_and_unprojected(spark):
    df = spark.createDataFrame([(1, "Bottle", 35.0), (2, None, 35.0), (3, "CTD", 30.0), (4, "CTD", 40.0)],
                               "k int, GEAR_TYPE string, latitude double")
    out = apply_constraints(df, {"GEAR_TYPE!=": "Bottle", "latitude>": 34}).select("k")
    assert sorted(r.k for r in out.collect()) == [2, 4]


# --- J1 -------------------------------------------------------------------------

@pytest.fixture()
def small_raster(spark):
    rows = [(i, j, 36.0 + i * 0.5, -70.0 + j * 0.5, e)
            for i in range(3) for j in range(3) for e in [-(10 * i + j) + (50 if (i, j) == (2, 2) else 0)]]
    return spark.createDataFrame(rows, "lat_idx long, lon_idx long, lat double, lon double, elevation int")


def test_nearest_raster_tie_clamp_positive(spark, small_raster):
    pts = spark.createDataFrame([(1, 36.25, -70.0),   # half way -> larger latitude (idx 1)
                                 (2, 10.0, -80.0),    # outside -> clamped to (0, 0)
                                 (3, 37.0, -69.0),    # (2, 2): elevation +28 -> depth 28
                                 (4, None, -69.0)],
                                "k int, latitude double, longitude double")
    out = {r.k: r.inferred_depth for r in nearest_raster(pts, small_raster).collect()}
    assert out == {1: 10, 2: 0, 3: 28, 4: None}


# --- J2 -------------------------------------------------------------------------

def _sq(x0, y0, w=1.0):
    return [Row(x=x0, y=y0), Row(x=x0 + w, y=y0), Row(x=x0 + w, y=y0 + w), Row(x=x0, y=y0 + w),
            Row(x=x0, y=y0)]


@pytest.fixture()
def cells(spark):
    concave = [Row(x=3.0, y=0.0), Row(x=5.0, y=0.0), Row(x=5.0, y=2.0), Row(x=4.0, y=1.0),
               Row(x=3.0, y=2.0), Row(x=3.0, y=0.0)]
    rows = [(1, _sq(0.0, 0.0)), (2, _sq(1.0, 0.0)), (3, concave), (4, _sq(0.5, 0.5, 0.2))]
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField(
        "ring", T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()),
                                          T.StructField("y", T.DoubleType())])))])
    return spark.createDataFrame(rows, schema)


def test_within_cells_edges_vertices_concave_overlap(spark, cells):
    pts = spark.createDataFrame([
        (1, 0.25, 0.25),   # inside cell 1
        (2, 0.0, 0.5),     # on the outer edge of cell 1
        (3, 1.0, 0.5),     # on the shared edge of cells 1 and 2
        (4, 1.0, 1.0),     # on a vertex
        (5, 1.5, 4.0),     # nowhere
        (6, 4.0, 1.5),     # in the notch of the concave cell -> outside
        (7, 4.8, 1.5),     # inside the concave cell
        (8, 0.6, 0.6),     # inside cells 1 and 4 (overlap) -> two rows
        (9, None, None),   # no position
    ], "k int, longitude double, latitude double")
    out = within_cells(pts, cells, tile=0.5).select("k", "id").collect()
    got = sorted((r.k, r.id if r.id is not None else -1) for r in out)
    assert got == [(1, 1), (2, -1), (3, -1), (4, -1), (5, -1), (6, -1), (7, 3), (8, 1), (8, 4), (9, -1)]


def test_within_cells_distinct_positions_same_result(spark, cells):
    from bottomgrid.operators.spatial import once_per_key
    pts = spark.createDataFrame([(i, 0.25 + (i % 3) * 0.5, 0.25) for i in range(12)],
                                "k int, longitude double, latitude double")
    direct = sorted(tuple(r) for r in within_cells(pts, cells, tile=0.5).select("k", "id").collect())
    via = once_per_key(pts, ["latitude", "longitude"],
                       lambda d: within_cells(d, cells, tile=0.5)).select("k", "id").collect()
    assert direct == sorted(tuple(r) for r in via)


# --- P3 / P6 --------------------------------------------------------------------

def test_seabed_check(spark):
    df = spark.createDataFrame([(1, 120.0, 100), (2, 100.0, 600), (3, 50.0, None), (4, 119.9, 100)],
                               "k int, depth double, inferred_depth int")
    assert sorted(r.k for r in seabed_check(df, "depth").collect()) == [2, 4]


def test_gross_range_strict(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 900.0, 5.0), (3, 50.0, 0.0), (4, 50.0, 27.0),
                                (5, 50.0, None), (6, 50.0, 10.0)], "k int, depth double, temperature double")
    assert [r.k for r in gross_range(df).collect()] == [6]


# --- A1 / A3 --------------------------------------------------------------------

def test_hourly_mean(spark):
    df = spark.createDataFrame([
        ("a", ts(0, 10), 1.0, 2.0), ("a", ts(0, 50), 3.0, None), ("a", ts(2, 5), None, None),
        ("a", ts(3, 0), 5.0, 1.0), (None, ts(0, 1), 9.0, 9.0)], "tow string, time timestamp_ntz, x double, y double")
    out = {r.time: (r.x, r.y) for r in hourly_mean(df, "tow", ["x", "y"]).collect()}
    assert out == {ts(0): (2.0, 2.0), ts(3): (5.0, 1.0)}


def test_deepest_tie_and_null_profile(spark):
    df = spark.createDataFrame([("p", 1, 10.0), ("p", 2, 30.0), ("p", 3, 30.0), ("q", 4, None),
                                (None, 5, 99.0)], "profile string, rid int, depth double")
    out = deepest(df, "profile", "depth", tie="rid").collect()
    assert [(r.profile, r.rid) for r in out] == [("p", 2)]


# --- A4 / A7 --------------------------------------------------------------------

def test_daily_cell_edge_cases(spark):
    df = spark.createDataFrame([
        (1, ts(0), 10.0, None, "a", 1), (1, ts(1), 12.0, None, "b", 0), (1, ts(2), 14.0, None, "a", 0),
        (2, ts(0), 5.0, None, "c", 1)],
        "id long, time timestamp_ntz, temperature double, salinity double, data_provider string, "
        "fishery_dependent int")
    out = {r.grid_id: r for r in daily_cell(df).collect()}
    a, b = out[1], out[2]
    assert a.temperature == 12.0 and a.temperature_count == 3 and a.data_provider == "a, b"
    assert a.fishery_dependent == 1 and a.salinity_count == 0 and a.salinity is None
    assert math.isclose(a.temperature_std, 2.0)
    assert b.temperature_std is None and b.temperature_count == 1


def test_merge_daily_counts_and_provider_text(spark):
    parts = spark.createDataFrame([
        (dt.date(2024, 1, 1), 1, 10.0, 10.0, 10.0, None, 1, "a, b"),
        (dt.date(2024, 1, 1), 1, 14.0, 14.0, 14.0, None, 1, "b, c"),
        (dt.date(2024, 1, 1), 2, 3.0, 3.0, 3.0, None, 1, "a"),
        (dt.date(2024, 1, 1), 3, None, None, None, None, 0, "z")],
        "time date, grid_id long, temperature double, temperature_min double, temperature_max double, "
        "temperature_std double, temperature_count long, data_provider string")
    out = {r.grid_id: r for r in merge_daily(parts, ["temperature"]).collect()}
    assert out[1].temperature == 12.0 and out[1].temperature_count == 2
    assert math.isclose(out[1].temperature_std, math.sqrt(8.0))
    assert out[1].data_provider == "a, b, c"
    assert out[2].temperature_std is None
    assert out[3].temperature is None and out[3].temperature_count == 0


# --- W1 / W2 / W3 ---------------------------------------------------------------

def test_drop_outliers_keeps_singletons_nulls_and_groupless(spark):
    rows = [("t", i, 10.0) for i in range(20)] + [("t", 20, 1000.0), ("t", 21, None),
                                                   ("one", 0, 500.0), (None, 0, 1e9)]
    df = spark.createDataFrame(rows, "tow string, i int, v double")
    kept = {(r.tow, r.i) for r in drop_outliers(df, "tow", "v").collect()}
    assert ("t", 20) not in kept and ("t", 21) in kept and ("one", 0) in kept and (None, 0) in kept
    assert len(kept) == 23


def test_min_group_size(spark):
    rows = [("nine", i) for i in range(9)] + [("ten", i) for i in range(10)] + [(None, 0)]
    df = spark.createDataFrame(rows, "g string, i int")
    assert {r.g for r in min_group_size(df, "g", 10).collect()} == {"ten"}


def test_running_median_zero_padded(spark):
    vals = [5.0, 9.0, 1.0, 7.0, 3.0, 8.0]
    rows = [("t", ts(0, i), v) for i, v in enumerate(vals)] + [("u", ts(0, 0), 4.0)] + \
           [("w", ts(0, i), v) for i, v in enumerate([3.0, 1.0, 2.0])] + [(None, ts(0, 0), 7.0)]
    df = spark.createDataFrame(rows, "tow string, time timestamp_ntz, v double")
    out = running_median(df, "tow", ["time"], "v", out="m")
    got = {}
    for r in out.collect():
        got.setdefault(r.tow, []).append((r.time, r.m))
    assert [m for _, m in sorted(got["t"])] == [1.0, 5.0, 5.0, 7.0, 3.0, 3.0]
    assert [m for _, m in got["u"]] == [0.0]
    assert [m for _, m in sorted(got["w"])] == [1.0, 1.0, 1.0]
    assert got[None] == [(ts(0, 0), None)]


def test_retention_curve(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (-2.0,), (600.0,), (None,)], "d double")
    out = {r["threshold"]: (r["count"], r["percent"]) for r in retention_curve(df, "d", [1, 2, 3]).collect()}
    assert out[1] == (2, 100 * 2 / 6) and out[2] == (4, 100 * 4 / 6) and out[3][0] == 4


# --- R1 -------------------------------------------------------------------------

@pytest.mark.parametrize("day,kind,start", [
    (dt.date(2025, 1, 1), "full", dt.datetime(2000, 1, 1)),
    (dt.date(2025, 4, 1), "quarterly", dt.datetime(2024, 4, 1)),
    (dt.date(2025, 1, 15), "bi-weekly", dt.datetime(2024, 12, 15)),
    (dt.date(2025, 2, 1), "bi-weekly", dt.datetime(2025, 1, 1)),
    (dt.date(2025, 7, 15), "bi-weekly", dt.datetime(2025, 6, 15)),
    (dt.date(2025, 3, 2), "daily", dt.datetime(2025, 2, 25)),
])
def test_refresh_window(spark, day, kind, start):
    r = spark.range(1).select(refresh_window(F.lit(day)).alias("w")).first().w
    assert (r.reload_type, r.start) == (kind, start)


def test_refresh_window_forced(spark):
    r = spark.range(1).select(refresh_window(F.lit(dt.date(2025, 3, 2)), True).alias("w")).first().w
    assert (r.reload_type, r.start) == ("manual_full", dt.datetime(2000, 1, 1))


# --- P1 / P8 / P9 / P11 ---------------------------------------------------------

def test_standard_narrow_metadata_key(spark):
    df = spark.createDataFrame([(ts(), 1.0, "x", 3, None)], "time timestamp_ntz, temperature double, "
                               "data_provider string, cast_number int, cruise string")
    std = to_standard(df)
    assert std.columns[:3] == ["time", "latitude", "longitude"] and len(std.columns) == 8
    n = narrow(spark.createDataFrame([(1.5, 4000000000.0, 7)], "temperature double, depth double, "
                                     "fishery_dependent int"))
    assert dict(n.dtypes) == {"temperature": "float", "depth": "bigint", "fishery_dependent": "smallint"}
    m = with_metadata(spark.createDataFrame([(1.0,)], "temperature double"))
    assert m.schema["temperature"].metadata["units"] == "degrees_Celsius"
    k = profile_key(df, "cruise", "cast_number").first().profile_id
    assert k == "nan_3"


def test_nearest_centroid_and_albers(spark):
    areas = spark.createDataFrame([(1, 0.0, 0.0), (2, 10.0, 0.0), (3, 5.0, 0.0)], "stat_area long, x double, y double")
    pts = spark.createDataFrame([(1, 1.0, 1.0), (2, 7.6, 0.0), (3, 2.5, 0.0)], "k int, px double, py double")
    out = {r.k: r.stat_area for r in nearest_centroid(pts, areas).collect()}
    assert out == {1: 1, 2: 2, 3: 1}
    x, y = albers_xy(F.lit(23.0), F.lit(-96.0))
    r = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert abs(r.x) < 1e-6 and abs(r.y) < 1e-6


def test_nearest_centroid_tiled_matches_array_form(spark):
    from bottomgrid.operators.spatial import nearest_centroid_tiled
    import random
    rnd = random.Random(5)
    areas = spark.createDataFrame([(i, rnd.uniform(0, 10), rnd.uniform(0, 10)) for i in range(60)],
                                  "stat_area long, x double, y double")
    pts = spark.createDataFrame([(i, rnd.uniform(-5, 15), rnd.uniform(-5, 15)) for i in range(300)]
                                + [(999, None, 1.0)], "k int, px double, py double")
    a = {r.k: r.stat_area for r in nearest_centroid(pts, areas).collect()}
    b = {r.k: r.stat_area for r in nearest_centroid_tiled(pts, areas).collect()}
    assert a == b and a[999] is None


def test_times_do_not_depend_on_session_zone(spark):
    from bottomgrid.sources.feeds import time_window
    df = spark.createDataFrame([("2024-01-01T00:00:00Z",), ("2024-01-01T05:30:00+02:00",),
                                ("2024-01-01 10:00:00",)], "`time (UTC)` string")
    results = []
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            n = normalize_scan(df, ["time"])
            w = time_window(n, dt.datetime(2024, 1, 1, 3, 30), dt.datetime(2024, 1, 1, 10, 0))
            results.append(([r.time for r in n.collect()], w.count()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert results[0] == results[1] == results[2]
    assert results[0] == ([dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 3, 30),
                           dt.datetime(2024, 1, 1, 10, 0)], 2)


def test_albers_matches_published_example(spark):
    # worked example of the Albers equal-area conic (Clarke 1866 ellipsoid,
    # parallels 29.5 / 45.5, origin 23 N 96 W): 35 N 75 W -> (1885472.7, 1535925.0)
    from bottomgrid.operators.spatial import ALBERS
    e2 = 0.00676866
    p = dict(ALBERS, a=6378206.4, f=1 - math.sqrt(1 - e2))
    x, y = albers_xy(F.lit(35.0), F.lit(-75.0), p)
    r = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert round(r.x, 1) == 1885472.7 and round(r.y, 1) == 1535925.0


def test_read_feeds_records_missing_and_failing_sources(spark, tmp_out):
    from bottomgrid.sources.feeds import read_feeds
    root = f"{tmp_out}/landing"
    ok = spark.createDataFrame([(dt.datetime(2024, 1, 2), 40.0, -70.0, 5.0, "a", 1)],
                               "time timestamp_ntz, latitude double, longitude double, "
                               "temperature double, station_id string, extra int")
    ok.write.parquet(f"{root}/wind_farm_acoustic_receivers")
    # eMOLT_RT's constraint needs segment_type, which this landing lacks
    ok.write.parquet(f"{root}/eMOLT_RT")
    scans = read_feeds(spark, root, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3))
    assert scans["wind_farm_acoustic_receivers"].status == "ok"
    assert scans["wind_farm_acoustic_receivers"].frame.count() == 1
    assert scans["eMOLT_RT"].status.startswith("error")
    assert scans["oleanderXbt"].status == "missing"
