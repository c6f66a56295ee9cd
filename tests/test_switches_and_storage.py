"""Size switches that must not change results, and storage that must not be
lost: forced paths, skewed joins, failing file systems."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from bottomgrid import session
from bottomgrid.operators.qc import drop_outliers, retention_curve, running_median
from bottomgrid.operators.spatial import nearest_centroid, nearest_centroid_tiled
from bottomgrid.plans import runs


def test_median_paths_agree_on_missing_values(spark):
    rnd = random.Random(4)
    rows = [(k, rnd.choice(["a", "b", None]), k % 50, rnd.choice([None, -5.0, -1.0, 2.0, rnd.random()])) for k in range(400)]
    df = spark.createDataFrame(rows, "i int, g string, t int, v double")
    small = sorted(map(tuple, running_median(df, "g", ["t", "i"], "v", out="m").select("i", "m").collect()))
    big = sorted(map(tuple, running_median(df, "g", ["t", "i"], "v", out="m", max_group_rows=1).select("i", "m").collect()))
    assert small == big
    one = spark.createDataFrame([(k, "g", k, v) for k, v in enumerate([None, -5.0, -4.0, -3.0, -2.0, None, None, 1.0, 2.0])],
                                "i int, g string, t int, v double")
    for bound in (None, 1):
        got = sorted(map(tuple, running_median(one, "g", ["t"], "v", out="m", max_group_rows=bound).select("i", "m").collect()))
        assert [m for _, m in got] == [None, -3.0, -3.0, -3.0, -2.0, None, None, 0.0, 0.0]


def _points(spark, rows):
    return spark.createDataFrame(rows, "i int, px double, py double")


def test_centroids_with_no_area_and_without_position(spark):
    pts = _points(spark, [(1, 0.0, 0.0), (2, None, 1.0), (3, float("nan"), 1.0)])
    areas = spark.createDataFrame([(5, 0.0, 0.0)], "stat_area int, x double, y double")
    for fn in (nearest_centroid, nearest_centroid_tiled):
        assert [r.stat_area for r in fn(pts, areas.limit(0)).collect()] == [None] * 3
        assert sorted((r.i, r.stat_area) for r in fn(pts, areas).collect()) == [(1, 5), (2, None), (3, None)]


def test_centroids_beyond_the_array_limit_and_far_away(spark):
    rnd = random.Random(9)
    n = 10_001
    cells = [(k, rnd.random() * 1000, rnd.random() * 1000) for k in range(n)]
    areas = spark.createDataFrame(cells, "stat_area int, x double, y double")
    pts = [(k, rnd.random() * 1000, rnd.random() * 1000) for k in range(20)] + [(20, 5.0e7, -3.0e7), (21, cells[0][1], cells[0][2])]
    want = [(i, min(cells, key=lambda c: ((x - c[1]) ** 2 + (y - c[2]) ** 2, c[0]))[0]) for i, x, y in pts]
    assert sorted((r.i, r.stat_area) for r in nearest_centroid(_points(spark, pts), areas).collect()) == want


def test_outlier_join_splits_a_hot_group(spark):
    """With broadcasts off and a third of the rows in one group, AQE splits
    that group's shuffle partition in the final plan."""
    rows = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("g"), (F.col("id") % 97).cast("double").alias("v"),
        F.concat(F.lit("x" * 20), F.col("id").cast("string")).alias("pad"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = drop_outliers(rows, "g", "v", broadcast_limit=0)
        n = out.count()
        plan = out._jdf.queryExecution()
        out.write.format("noop").mode("overwrite").save()
        df = out.groupBy().count()
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert n == 300_000 and "skew=true" in plan


def test_retention_with_fractions_and_no_rows(spark):
    df = spark.createDataFrame([(0.4,), (1.0,), (-2.5,), (float("nan"),), (None,)], "d double")
    assert [tuple(r) for r in retention_curve(df, "d", [0.5, 2.5]).collect()] == [(0.5, 1, 20.0), (2.5, 3, 60.0)]
    assert [tuple(r) for r in retention_curve(df.limit(0), "d", [1, 2]).collect()] == [(1, 0, None), (2, 0, None)]


def test_storage_checks_fail_closed(spark, tmp_out, monkeypatch):
    assert session.path_exists(spark, tmp_out) is False
    with pytest.raises(Exception):  # noqa: B017  (no file system for the scheme)
        session.path_exists(spark, "nosuchscheme://x/y")
    staged, prod = f"{tmp_out}/staged", f"{tmp_out}/product"
    published = []

    def broken(_spark, path):
        raise OSError("file system is away")

    monkeypatch.setattr(runs, "path_exists", broken)
    monkeypatch.setattr(runs, "publish_days", lambda *a, **k: published.append(a))
    with pytest.raises(OSError):
        runs.run_step2(spark, staged, prod, f"{tmp_out}/a", f"{tmp_out}/c", f"{tmp_out}/d", reload_type="daily", doi="",
                       now=dt.datetime(2024, 2, 1))
    assert not published


def test_handoff_names_the_reload_type(spark, tmp_out):
    staged = f"{tmp_out}/staged"
    spark.createDataFrame([("quarterly", "10.1/x")], "reload_type string, doi string").write.parquet(runs.handoff_path(staged))
    from bottomgrid.plans.fixtures import grid, obs
    from bottomgrid.operators.spatial import assign_grid
    from bottomgrid.sinks.publish import stage
    sf = "/root/testdata/sf0.001"
    stage(assign_grid(obs(spark, sf), grid(spark, sf)), staged)
    paths = [f"{tmp_out}/{p}" for p in ("product", "archive", "catalogue", "diag")]
    for _ in range(2):
        runs.run_step2(spark, staged, *paths, now=dt.datetime(2024, 2, 1))
    row = spark.read.parquet(paths[2]).first()
    assert (row.reload_type, row.doi) == ("quarterly", "10.1/x")
    csv = spark.read.option("header", True).csv(paths[2] + "_csv").collect()
    assert [r.reload_type for r in csv] == ["quarterly"]
    from bottomgrid.sinks.snapshots import read_snapshot
    snapshot = read_snapshot(spark, f"{paths[1]}/archive_date=2024-02-01").inputFiles()
    assert any("/year=" in f and "/time=" in f for f in snapshot)


def _raster(spark, lats, lons, skip=()):
    return spark.createDataFrame([(i, j, float(a), float(b), i * 100 + j) for i, a in enumerate(lats) for j, b in enumerate(lons)
                                  if (i, j) not in skip], "lat_idx long, lon_idx long, lat double, lon double, elevation int")


def test_raster_axes_are_checked(spark):
    from bottomgrid.operators.spatial import nearest_raster, pack_raster
    pts = spark.createDataFrame([(0.2, 2.5), (None, 1.0), (9.0, -3.0)], "latitude double, longitude double")
    full = _raster(spark, [0, 1, 2], [0, 1, 2, 3])
    want = [3, None, 200]
    for limit in (None, 0):       # blocks broadcast, and shuffled
        got = nearest_raster(pts, full, broadcast_limit=limit).orderBy(F.col("latitude").asc_nulls_last()).collect()
        assert [(r.latitude, r.inferred_depth) for r in got] == [(0.2, want[0]), (9.0, want[2]), (None, None)]
    holed = nearest_raster(pts, _raster(spark, [0, 1, 2], [0, 1, 2, 3], skip={(0, 3)}))
    assert [r.inferred_depth for r in holed.where("latitude = 0.2").collect()] == [None]
    with pytest.raises(ValueError, match="not regular"):
        pack_raster(_raster(spark, [0, 1, 2], [0, 1, 2, 10]))
    with pytest.raises(ValueError, match="without a value"):
        pack_raster(full.where("lat_idx <> 1"))


class _Cluster:
    """A session on a cluster whose checkpoint folder is not set."""

    class conf:
        @staticmethod
        def get(_key, default=None):
            return default

    class sparkContext:
        master = "yarn"

        @staticmethod
        def getConf():
            return _Cluster.conf


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(_Cluster())


def test_incremental_stream_refuses_foreign_partials(spark, tmp_out):
    from bottomgrid.streaming.incremental import _claim, owner_path
    parts = f"{tmp_out}/partials"
    _claim(spark, parts, f"{tmp_out}/a")
    _claim(spark, parts, f"{tmp_out}/a")          # nothing written yet: the same stream may start again
    with pytest.raises(ValueError, match="belong to the stream checkpoint"):
        _claim(spark, parts, f"{tmp_out}/b")
    spark.range(1).write.parquet(parts)
    with pytest.raises(ValueError, match="is gone"):
        _claim(spark, parts, f"{tmp_out}/a")
    other = f"{tmp_out}/other"
    spark.range(1).write.parquet(other)
    with pytest.raises(ValueError, match="no known"):
        _claim(spark, other, f"{tmp_out}/a")
    assert session.path_exists(spark, owner_path(parts))
