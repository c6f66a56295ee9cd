"""One tow holding a third of all rows: the per-group operators stay exact
(checked against a brute-force computation on this small fixture) and the
running median never groups a tow into one window partition."""

import contextlib
import io

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from bottomgrid.operators.qc import drop_outliers, running_median
from bottomgrid.operators.reduce import deepest

N = 30000


def skewed(spark):
    i = F.col("id")
    tow = F.when(i % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), (i % 400).cast("string")))
    return spark.range(N).select(
        i.alias("rid"), tow.alias("tow"),
        F.timestamp_add("SECOND", i, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("time"),
        (((i * 7919) % 1000) / 10.0).alias("v"))


def _medfilt_zero(x, k=5):
    h = k // 2
    padded = np.concatenate([np.zeros(h), x, np.zeros(h)])
    return np.array([np.median(padded[j:j + k]) for j in range(len(x))])


def _check_median(spark, out):
    got = out.select("rid", "m").toPandas().set_index("rid")["m"]
    pdf = skewed(spark).toPandas().sort_values(["tow", "time", "rid"])
    exp = pdf.groupby("tow", group_keys=False)["v"].apply(
        lambda s: pd.Series(_medfilt_zero(s.to_numpy()), index=pdf.loc[s.index, "rid"]))
    assert got.sort_index().equals(exp.sort_index().rename("m"))


def test_running_median_hot_tow_split_off(spark):
    # the hot tow (10,000 rows) is above the bound and takes the range-sorted
    # path; the 400 small tows use the per-tow window
    df = skewed(spark).repartition(8)
    out = running_median(df, "tow", ["time", "rid"], "v", out="m", max_group_rows=1000)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    assert "Window" in buf.getvalue() and "Union" in buf.getvalue()
    _check_median(spark, out)


def test_running_median_all_groups_small(spark):
    out = running_median(skewed(spark), "tow", ["time", "rid"], "v", out="m")
    _check_median(spark, out)


def test_running_median_every_group_hot(spark):
    out = running_median(skewed(spark), "tow", ["time", "rid"], "v", out="m", max_group_rows=0)
    _check_median(spark, out)


def test_outliers_and_deepest_hot_tow(spark):
    df = skewed(spark).withColumn("v", F.when(F.col("rid") == 3, 1e6).otherwise(F.col("v")))
    kept = {r.rid for r in drop_outliers(df, "tow", "v").select("rid").collect()}
    pdf = df.toPandas()
    g = pdf.groupby("tow")["v"]
    flag = (pdf["v"] - g.transform("mean")).abs() > 3 * g.transform("std")
    assert kept == set(pdf.loc[~flag, "rid"]) and 3 not in kept
    d = {r.tow: r.rid for r in deepest(df, "tow", "v", tie="rid").collect()}
    exp = pdf.sort_values(["v", "rid"], ascending=[False, True]).groupby("tow").head(1)
    assert d == dict(zip(exp["tow"], exp["rid"]))


def test_daily_cell_hot_cell_day(spark):
    from bottomgrid.operators.daily import daily_cell
    i = F.col("id")
    df = spark.range(N).select(
        F.when(i % 3 == 0, F.lit(7)).otherwise(i % 500).cast("long").alias("id"),
        F.when(i % 3 == 0, F.lit("2024-01-05 12:00:00").cast("timestamp_ntz"))
         .otherwise(F.timestamp_add("MINUTE", i, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")))
         .alias("time"),
        (((i * 7919) % 1000) / 10.0).alias("temperature"),
        F.concat(F.lit("p"), (i % 4).cast("string")).alias("data_provider"),
        i.alias("obs_id")).repartition(8)
    got = {(r.time, r.grid_id): r for r in daily_cell(df, order=["time", "obs_id"]).collect()}
    pdf = df.toPandas()
    pdf["day"] = pdf["time"].dt.date
    g = pdf.groupby(["day", "id"])
    assert len(got) == g.ngroups
    for (day, cid), part in g:
        r = got[(day, cid)]
        assert r.temperature_count == len(part)
        assert abs(r.temperature - part["temperature"].mean()) < 1e-9
        if len(part) > 1:
            assert abs(r.temperature_std - part["temperature"].std()) < 1e-9
        assert r.data_provider == ", ".join(sorted(part["data_provider"].unique()))
