"""End-to-end: land every registered feed (shaped from the obs view), run
the fetch-and-stage job, then the aggregate-and-publish job twice."""

import datetime as dt

from pyspark.sql import functions as F

from bottomgrid.plans import fixtures as fx
from bottomgrid.plans.queries import located
from bottomgrid.plans.runs import product_frame, run_step1, run_step2
from bottomgrid.plans.standardize import OOI_OXYGEN
from bottomgrid.registry import FEEDS
from bottomgrid.sinks.snapshots import read_snapshot
from bottomgrid.sources.staged import read_staged

SF = "/root/testdata/sf0.001"


def land_all(spark, root):
    o = fx.obs(spark, SF)
    tow = F.col("tow_id").cast("string").alias("tow_id")
    feeds = {
        "fixed_gear_oceanography": o.select("time", "latitude", "longitude", "temperature",
                                            "dissolved_oxygen", tow),
        "shelf_fleet_profiles_1m_binned": o.select(
            "time", "latitude", "longitude", F.col("temperature").alias("conservative_temperature"),
            F.col("depth").alias("sea_pressure"), "profile_id",
            F.col("salinity").alias("absolute_salinity")),
        "wind_farm_acoustic_receivers": o.select("time", "latitude", "longitude",
                                                 F.col("dataset_id").alias("station_id"), "temperature"),
        "demersal_gliders_aggregated": located(spark, SF).select(
            "time", F.col("id").alias("grid_id"), "temperature", "salinity", "dissolved_oxygen",
            F.lit("Rutgers University").alias("institution")),
        "eMOLT_RT": o.select("time", "latitude", "longitude", "temperature", tow, "depth",
                             F.lit(3).alias("segment_type")),
        "eMOLT_RT_LOWELL": o.select("time", "latitude", "longitude", "temperature",
                                    F.col("dissolved_oxygen").alias("DO"), tow,
                                    F.lit(80.0).alias("water_detect_perc")),
        "ocdbs_v_erddap1": o.select(F.col("time").alias("UTC_DATETIME"), "latitude", "longitude",
                                    F.col("temperature").alias("sea_water_temperature"),
                                    F.col("depth").alias("pressure_dbars"), "dissolved_oxygen",
                                    F.col("salinity").alias("sea_water_salinity"),
                                    F.col("tow_id").cast("int").alias("cast_number"),
                                    F.col("dataset_id").alias("cruise_id"),
                                    F.lit("CTD").alias("GEAR_TYPE")),
        "oleanderXbt": o.select("time", "latitude", "longitude", F.col("temperature").alias("temp"),
                                "depth", F.col("tow_id").cast("int").alias("profile_number"),
                                F.col("dataset_id").alias("cruise_num"), F.lit(1).alias("hit_bottom"),
                                F.lit(2024).alias("start_year")),
    }
    ooi = o.select("time", "latitude", "longitude", F.col("temperature").alias("sea_water_temperature"),
                   F.col("salinity").alias("sea_water_practical_salinity"),
                   F.col("dissolved_oxygen").alias(OOI_OXYGEN))
    for f in FEEDS:
        if f.feed_id.startswith("ooi-"):
            feeds[f.feed_id] = ooi
    # the wind-farm profiles feed is left out on purpose: it must only get a status
    for fid, df in feeds.items():
        df.write.parquet(f"{root}/{fid}")
    return feeds


def test_both_jobs_end_to_end(spark, tmp_out):
    root, staged, log = f"{tmp_out}/landing", f"{tmp_out}/staged", f"{tmp_out}/runlog"
    feeds = land_all(spark, root)
    res = run_step1(spark, root, fx.grid(spark, SF), fx.raster(spark, SF), dt.date(2024, 1, 30),
                    staged, log, force_full=True)
    assert res.reload_type == "manual_full"
    assert res.statuses["wind_farm_profiles_1m_binned"] == "missing"
    assert all(res.statuses[f] == "ok" for f in feeds)
    logged = {r.dataset_id: r for r in spark.read.parquet(log).collect()}
    assert len(logged) == len(FEEDS)
    assert logged["wind_farm_profiles_1m_binned"].fetch_erddap_success == 0
    assert logged["fixed_gear_oceanography"].observation_count == 1000
    assert logged["fixed_gear_oceanography"].data_provider == "cfrf"
    lowell = fx.obs(spark, SF).where("dissolved_oxygen > 0 AND temperature > 0 AND temperature < 27")
    assert logged["eMOLT_RT_LOWELL"].observation_count == lowell.count()
    assert logged["fixed_gear_oceanography"].file_protocol == "erddap"
    per_feed = {r.dataset_id: r["count"] for r in
                spark.read.parquet(staged).groupBy("dataset_id").count().collect()}
    for fid in feeds:
        assert logged[fid].post_filter_count > 0, fid
        # the sf0.001 grid ends at 37 N; the Oleander box starts at 38.18 N
        if fid != "oleanderXbt":
            assert per_feed.get(fid, 0) > 0, fid
    providers = {r.data_provider for r in spark.read.parquet(staged).select("data_provider").distinct().collect()}
    assert {"CFRF", "eMOLT", "ECOMON", "OOI", "glider_RU"} <= providers
    for fid in feeds:
        assert logged[fid].post_filter_count >= per_feed.get(fid, 0)

    prod, arch = f"{tmp_out}/product", f"{tmp_out}/archive"
    cat, diag = f"{tmp_out}/catalogue", f"{tmp_out}/diag"
    now = dt.datetime(2024, 1, 31, 5)
    days = run_step2(spark, staged, prod, arch, cat, diag, now=now)
    expected = product_frame(read_staged(spark, staged))
    got = spark.read.parquet(prod).drop("year", "month")
    assert sorted(days) == sorted(r[0] for r in expected.select("time").distinct().collect())
    n = got.count()
    assert n == expected.count()
    assert got.exceptAll(expected.select(*got.columns)).count() == 0
    run_step2(spark, staged, prod, arch, cat, diag, now=now)
    assert spark.read.parquet(cat).count() == 1
    assert read_snapshot(spark, f"{arch}/archive_date=2024-01-31").count() == n
    programs = [r.program for r in spark.read.parquet(diag).collect()]
    assert sorted(programs) == ["step1", "step1", "step2", "step2"]
    attrs = spark.read.parquet(f"{prod}/_attributes").first()
    assert attrs.version == "1" and attrs.title


def test_cli_runs_both_jobs(spark, tmp_out):
    from bottomgrid.cli import main
    land_all(spark, f"{tmp_out}/landing")
    fx.grid(spark, SF).write.parquet(f"{tmp_out}/grid")
    fx.raster(spark, SF).write.parquet(f"{tmp_out}/raster")
    out1 = main(["step1", "--landing", f"{tmp_out}/landing", "--grid", f"{tmp_out}/grid",
                 "--raster", f"{tmp_out}/raster", "--staged", f"{tmp_out}/staged",
                 "--run-log", f"{tmp_out}/runlog", "--date", "2024-01-30", "--full"], spark=spark)
    assert out1["reload_type"] == "manual_full"
    out2 = main(["step2", "--staged", f"{tmp_out}/staged", "--product", f"{tmp_out}/product",
                 "--archive", f"{tmp_out}/archive", "--catalogue", f"{tmp_out}/catalogue",
                 "--diagnostics", f"{tmp_out}/diag"], spark=spark)
    assert out2["days_published"] > 0
    out3 = main(["refresh", "--staged", f"{tmp_out}/staged", "--product", f"{tmp_out}/product",
                 "--date", "2024-01-20"], spark=spark)
    assert 0 < out3["days_published"] <= 6
