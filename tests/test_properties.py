"""Properties: merge of partials = direct statistics, partition-count
invariance, idempotent publishing and stream replays."""

import math

from pyspark.sql import functions as F

from bottomgrid.operators.daily import daily_cell, merge_daily
from bottomgrid.plans.queries import located
from bottomgrid.plans.runs import product_frame
from bottomgrid.sinks.publish import publish_days, stage, stage_append
from bottomgrid.streaming.publish_stream import publish_stream

SF = "/root/testdata/sf0.001"
M = ["temperature", "dissolved_oxygen", "salinity"]


def _by_key(df, keys=("time", "grid_id")):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def test_merge_of_random_split_equals_direct(spark):
    loc = located(spark, SF).withColumn("part", (F.rand(7) * 3).cast("int"))
    direct = _by_key(daily_cell(loc, order=["time", "obs_id"]))
    parts = daily_cell(loc, order=["time", "obs_id"], by=["part"]).drop("part", "fishery_dependent")
    merged = _by_key(merge_daily(parts))
    assert direct.keys() == merged.keys()
    for k, d in direct.items():
        for m in M:
            for suffix in ("", "_min", "_max", "_std", "_count"):
                assert _close(d[m + suffix], merged[k][m + suffix]), (k, m + suffix)
        assert d["data_provider"] == merged[k]["data_provider"]


def test_partition_count_does_not_change_results(spark):
    loc = located(spark, SF)
    one = _by_key(daily_cell(loc.repartition(1), order=["time", "obs_id"]))
    many = _by_key(daily_cell(loc.repartition(7), order=["time", "obs_id"]))
    assert one.keys() == many.keys()
    for k in one:
        for c, v in one[k].items():
            assert _close(v, many[k][c]), (k, c)


def _rows(spark, path):
    df = spark.read.parquet(path).drop("year", "month")
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_publish_twice_is_idempotent(spark, tmp_out):
    p = product_frame(located(spark, SF))
    publish_days(p, tmp_out)
    first = _rows(spark, tmp_out)
    publish_days(p, tmp_out)
    assert _rows(spark, tmp_out) == first


def test_stream_replay_and_new_files(spark, tmp_out):
    loc = located(spark, SF)
    staged, prod, ckpt = f"{tmp_out}/staged", f"{tmp_out}/product", f"{tmp_out}/ckpt"
    early = loc.where(F.to_date("time") < F.lit("2024-01-15").cast("date"))
    late = loc.where(F.to_date("time") >= F.lit("2024-01-15").cast("date"))
    stage(early, staged)
    publish_stream(spark, staged, prod, checkpoint=ckpt).awaitTermination()
    after_first = _rows(spark, prod)
    publish_stream(spark, staged, prod, checkpoint=ckpt).awaitTermination()   # nothing new
    assert _rows(spark, prod) == after_first
    stage_append(late, staged)
    publish_stream(spark, staged, prod, checkpoint=ckpt).awaitTermination()
    direct = f"{tmp_out}/direct"
    publish_days(product_frame(loc), direct)
    assert _rows(spark, prod) == _rows(spark, direct)


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0 and "temperature" in df.columns


def test_recent_prunes_published_days(spark, tmp_out):
    import datetime as dt
    import contextlib
    import io
    from bottomgrid.sources.staged import recent
    p = product_frame(located(spark, SF))
    publish_days(p, tmp_out)
    prod = spark.read.parquet(tmp_out)
    out = recent(prod, ["time", "temperature", "stat_area"], 3, dt.date(2024, 1, 20))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    assert "PartitionFilters: [isnotnull(time" in buf.getvalue()
    days = sorted({r.time for r in out.collect()})
    lo, hi = (dt.date(2024, 1, 17) - dt.date(1970, 1, 1)).days, (dt.date(2024, 1, 20) - dt.date(1970, 1, 1)).days
    assert days and days[0] >= lo and days[-1] <= hi


def test_touched_days_prune_staged_partitions(spark, tmp_out):
    import contextlib
    import datetime as dt
    import io
    from bottomgrid.streaming import publish_stream as ps
    loc = located(spark, SF)
    stage(loc, f"{tmp_out}/staged")
    day = sorted(r[0] for r in product_frame(loc).select("time").distinct().collect())[0]
    date = dt.date(1970, 1, 1) + dt.timedelta(days=day)
    days = spark.createDataFrame([(date,)], "day date")
    captured = {}
    real = ps.publish_days

    def spy(df, path):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        captured["plan"] = buf.getvalue()
        return real(df, path)

    ps.publish_days = spy
    try:
        written = ps.publish_touched_days(spark, f"{tmp_out}/staged", f"{tmp_out}/product", days, 1)
    finally:
        ps.publish_days = real
    filters = [line for line in captured["plan"].splitlines() if "PartitionFilters" in line]
    assert filters and all(date.isoformat() in f or str(day) in f for f in filters), filters
    assert written == [day]


def test_incremental_partials_replay_is_idempotent(spark, tmp_out):
    from bottomgrid.streaming.incremental import day_parts, publish_from_partials, stage_batch_partials
    loc = located(spark, SF)
    a = loc.where(F.col("data_provider").isin("view", "click"))
    b = loc.where(~F.col("data_provider").isin("view", "click"))
    parts, prod = f"{tmp_out}/partials", f"{tmp_out}/product"
    stage_batch_partials(a, parts, 0)
    stage_batch_partials(b, parts, 1)
    stage_batch_partials(b, parts, 1)            # the same batch delivered again
    n_parts = spark.read.parquet(f"{parts}/delta").count()
    days = [r[0] for r in loc.select(F.to_date("time")).distinct().collect()]
    publish_from_partials(spark, parts, prod, [day_parts(spark, parts, d) for d in days])
    direct = f"{tmp_out}/direct"
    publish_days(product_frame(loc), direct)
    assert _rows(spark, prod) == _rows(spark, direct)
    stage_batch_partials(b, parts, 1)
    assert spark.read.parquet(f"{parts}/delta").count() == n_parts


def test_archive_size_from_listing_matches_file_metadata(spark, tmp_out):
    from bottomgrid.functions.columns import dataset_attributes
    from bottomgrid.session import content_bytes
    publish_days(product_frame(located(spark, SF)), tmp_out)
    dataset_attributes(spark, "1").write.parquet(f"{tmp_out}/_attributes")   # not product data
    files = (spark.read.parquet(tmp_out)
             .select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s"))
             .distinct())
    assert content_bytes(spark, tmp_out) == files.agg(F.sum("s")).first()[0]
