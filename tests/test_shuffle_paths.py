"""The size-checked joins give the same rows when their dimension is too
large to broadcast and they run as shuffle joins instead."""

from bottomgrid.operators import sizing
from bottomgrid.operators.daily import daily_cell
from bottomgrid.operators.lookup import map_default
from bottomgrid.operators.spatial import assign_grid, nearest_raster, within_cells
from bottomgrid.plans import fixtures as fx

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    # shuffle and broadcast plans sum in different orders: compare doubles
    # to 9 decimals
    r9 = lambda v: round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(r9(v) for v in r) for r in df.collect()), key=repr)


def test_point_in_cell_shuffle_path(spark, monkeypatch):
    pts = fx.obs(spark, SF).select("obs_id", "latitude", "longitude")
    g = fx.grid(spark, SF)
    expected = _rows(within_cells(pts, g).select("obs_id", "id"))
    monkeypatch.setattr(sizing, "DEFAULT_BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = within_cells(pts, g).select("obs_id", "id")
        assert "BroadcastExchange" not in _plan(df)
        assert _rows(df) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_raster_and_attributes_shuffle_path(spark, monkeypatch):
    o = fx.obs(spark, SF).select("obs_id", "latitude", "longitude", "dataset_id", "time",
                                 "temperature", "data_provider", "fishery_dependent")
    r, g = fx.raster(spark, SF), fx.grid(spark, SF)
    exp_r = _rows(nearest_raster(o, r).select("obs_id", "inferred_depth"))
    exp_d = _rows(daily_cell(assign_grid(o, g), order=["time", "obs_id"]))
    exp_m = _rows(map_default(o, "dataset_id", {"view": "V"}).select("obs_id", "data_provider"))
    monkeypatch.setattr(sizing, "DEFAULT_BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got_r = nearest_raster(o, r).select("obs_id", "inferred_depth")
        assert "BroadcastExchange" not in _plan(got_r)
        assert _rows(got_r) == exp_r
        assert _rows(daily_cell(assign_grid(o, g), order=["time", "obs_id"])) == exp_d
        assert _rows(map_default(o, "dataset_id", {"view": "V"}).select("obs_id", "data_provider")) == exp_m
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_per_call_limit_forces_shuffle(spark):
    pts = fx.obs(spark, SF).select("obs_id", "latitude", "longitude")
    g = fx.grid(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = assign_grid(pts, g, broadcast_limit=0).select("obs_id", "id")
        assert "BroadcastExchange" not in _plan(df)
        r = fx.raster(spark, SF)
        assert "BroadcastExchange" not in _plan(nearest_raster(pts, r, broadcast_limit=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert _rows(df) == _rows(assign_grid(pts, g).select("obs_id", "id"))
