"""Streams: folded partials at every point where a run may end, checkpoint
ownership, bounded batches, and both ways of selecting touched days."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bottomgrid.plans.queries import located
from bottomgrid.plans.runs import product_frame
from bottomgrid.session import child_names
from bottomgrid.sinks.publish import publish_days, stage, stage_append
from bottomgrid.streaming import incremental as inc
from bottomgrid.streaming import publish_stream as ps

SF = "/root/testdata/sf0.001"
PROVIDERS = ("view", "click", "purchase", "signup", "error")


def _rows(spark, path):
    cols = ["time", "grid_id", "temperature", "temperature_std", "temperature_count", "salinity", "data_provider", "latitude"]
    rows = spark.read.parquet(path).select(*cols).collect()
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows)


@pytest.fixture(scope="module")
def direct(spark):
    import uuid
    from bottomgrid.session import scratch_path
    path = scratch_path(spark, "tests", uuid.uuid4().hex)
    publish_days(product_frame(located(spark, SF)), path)
    return _rows(spark, path)


def _run(spark, root, fold_after=2):
    q = inc.incremental_stream(spark, f"{root}/staged", f"{root}/parts", f"{root}/product", f"{root}/ckpt", fold_after=fold_after)
    q.awaitTermination()


@pytest.mark.parametrize("step", ["stage_batch_partials", "publish_from_partials", "write_base", "mark_base", "remove_stale"])
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_run_may_end_at_any_step(spark, tmp_out, direct, monkeypatch, step, when):
    """The third batch ends at one step, before or after it did its work; the
    stream starts again and the product is that of all rows."""
    loc = located(spark, SF)
    real, calls = getattr(inc, step), []

    def dies(*args, **kw):
        calls.append(step)
        if when == "after":
            real(*args, **kw)
        raise RuntimeError("the job is killed here")

    for k, provider in enumerate(PROVIDERS):
        stage_append(loc.where(F.col("data_provider") == provider), f"{tmp_out}/staged")
        if k == 2:
            monkeypatch.setattr(inc, step, dies)
            with pytest.raises(Exception):  # noqa: B017  (the stream's own error type)
                _run(spark, tmp_out)
            monkeypatch.setattr(inc, step, real)
            assert calls == [step]
        _run(spark, tmp_out)
    assert _rows(spark, f"{tmp_out}/product") == direct


def test_listing_of_a_day_does_not_grow_with_batches(spark, tmp_out, direct):
    loc = located(spark, SF)
    stage(loc.limit(0), f"{tmp_out}/staged")
    for k in range(6):
        stage_append(loc.where(F.col("obs_id") % 6 == k), f"{tmp_out}/staged")
        _run(spark, tmp_out)
        for day in child_names(spark, f"{tmp_out}/parts/delta"):
            d = inc.day_parts(spark, f"{tmp_out}/parts", dt.date.fromisoformat(day.split("=")[1]))
            assert len(d.deltas) < 2 and not d.stale
            assert len(child_names(spark, f"{tmp_out}/parts/base/{day}")) <= 1
    assert _rows(spark, f"{tmp_out}/product") == direct


def test_streams_own_their_checkpoints(spark, tmp_out):
    loc = located(spark, SF)
    for k in (0, 1):
        stage(loc.where(F.col("obs_id") % 2 == k), f"{tmp_out}/staged{k}")
    # two streams side by side, each with the default checkpoint of its product
    both = [ps.publish_stream(spark, f"{tmp_out}/staged{k}", f"{tmp_out}/product{k}") for k in (0, 1)]
    for q in both:
        q.awaitTermination()
    for k in (0, 1):
        publish_days(product_frame(loc.where(F.col("obs_id") % 2 == k)), f"{tmp_out}/direct{k}")
        assert _rows(spark, f"{tmp_out}/product{k}") == _rows(spark, f"{tmp_out}/direct{k}")
    with pytest.raises(ValueError, match="belongs to a stream"):
        ps.publish_stream(spark, f"{tmp_out}/staged0", f"{tmp_out}/product1")
    with pytest.raises(ValueError, match="belongs to a stream"):
        ps.publish_stream(spark, f"{tmp_out}/staged1", f"{tmp_out}/other", checkpoint=ps.stream_checkpoint(f"{tmp_out}/product1"))


def test_a_backlog_is_drained_in_bounded_batches(spark, tmp_out):
    loc = located(spark, SF)
    stage(loc, f"{tmp_out}/staged")
    files = len(spark.read.parquet(f"{tmp_out}/staged").inputFiles())
    assert files > 10
    q = ps.publish_stream(spark, f"{tmp_out}/staged", f"{tmp_out}/product", max_files=10)
    q.awaitTermination()
    batches = child_names(spark, f"{ps.stream_checkpoint(f'{tmp_out}/product')}/commits")
    assert len([b for b in batches if b.isdigit()]) >= files // 10
    publish_days(product_frame(loc), f"{tmp_out}/direct")
    assert _rows(spark, f"{tmp_out}/product") == _rows(spark, f"{tmp_out}/direct")


def test_listed_and_joined_days_are_the_same(spark, tmp_out, monkeypatch):
    loc = located(spark, SF)
    stage(loc, f"{tmp_out}/staged")
    days = loc.select(F.to_date("time").alias("day")).distinct().where("day <= DATE'2024-01-10'")
    n = days.count()
    listed = ps.publish_touched_days(spark, f"{tmp_out}/staged", f"{tmp_out}/a", days, n)
    monkeypatch.setattr(ps, "MAX_LISTED_DAYS", 0)
    joined = ps.publish_touched_days(spark, f"{tmp_out}/staged", f"{tmp_out}/b", days, n)
    assert listed == joined and 0 < len(listed) <= n
    assert _rows(spark, f"{tmp_out}/a") == _rows(spark, f"{tmp_out}/b")


def test_days_in_several_lists(spark, tmp_out, direct, monkeypatch):
    monkeypatch.setattr(inc, "MAX_LISTED_DAYS", 3)
    stage(located(spark, SF), f"{tmp_out}/staged")
    _run(spark, tmp_out)
    assert _rows(spark, f"{tmp_out}/product") == direct
