"""What must not grow faster than the input: the code and the tasks of the
grid join, and the number of times a product is computed."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from bottomgrid.operators.sizing import read_again_alike
from bottomgrid.operators.spatial import grid_tiles, within_cells
from bottomgrid.sinks.publish import publish_days


def ring(x, y, w, h):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]


RING = "id bigint, ring array<struct<x:double,y:double>>"
HUGE_METHOD = 8000      # bytes of code beyond which the JVM does not compile a method


def code_size(df) -> int:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("codegen")
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue()))


def computed_grid(spark, n=400):
    """Cells whose rings are computed from their number, as a view over a table would."""
    c = spark.range(n).select("id", (F.col("id") % 40 * 0.3 - 76.00037 + F.floor(F.col("id") / 40) * 0.01).alias("x0"),
                              (36.00041 + F.floor(F.col("id") / 40) * 0.2).alias("y0"))
    pt = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    x, y = F.col("x0"), F.col("y0")
    ring = F.array(pt(x, y), pt(x + 0.3, y), pt(x + 0.31, y + 0.2), pt(x + 0.01, y + 0.2), pt(x, y))
    return c.select("id", ring.alias("ring"), (F.col("id") % 40).alias("stat_area"), (F.col("id") * 1.0).alias("depth"))


@pytest.fixture()
def static_plans(spark):
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", was)


def test_points_in_a_large_cell_are_spread(spark, static_plans):
    """every point lies in one large cell and few in a small one; no task
    of the join gets all that the large cell was found for."""
    cells = [(i, ring(-75.0 + (i % 10) * 0.1, 36.0 + i // 10 * 0.1, 0.1, 0.1)) for i in range(100)]
    grid = spark.createDataFrame([*cells, (1000, ring(-100.0, 0.0, 60.0, 60.0))], RING)
    pts = spark.range(2000).select("id", (36.0 + F.col("id") % 97 / 30.0 + 0.001).alias("latitude"),
                                   (-75.0 + F.col("id") % 89 / 40.0 + 0.001).alias("longitude")).withColumnRenamed("id", "p")
    got = within_cells(pts, grid_tiles(grid, broadcast_limit=0))
    want = within_cells(pts, grid)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    large = got.where("id = 1000").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in large) == 2000
    assert max(r["count"] for r in large) < 1000


def test_code_of_the_grid_join_is_compiled(spark, static_plans):
    """Neither the listing of the cells nor the join makes a method that is too long."""
    tiles = grid_tiles(computed_grid(spark), broadcast_limit=0, carry=["stat_area", "depth"])
    assert code_size(tiles.tiles) < HUGE_METHOD
    pts = spark.createDataFrame([(1, 36.1, -75.9)], "p long, latitude double, longitude double").repartition(2)
    assert code_size(within_cells(pts, tiles, how="inner", keep=["stat_area", "depth"])) < HUGE_METHOD


def test_large_tiles_are_not_broadcast_by_a_guess(spark, static_plans):
    """The planner knows the size of the grid's file, not that of its tiles."""
    tiles = grid_tiles(computed_grid(spark), broadcast_limit=0)
    pts = spark.createDataFrame([(1, 36.1, -75.9)], "p long, latitude double, longitude double")
    plan = within_cells(pts, tiles)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_code_of_the_join_leaves_room(spark, static_plans):
    """points whose position may be NULL; what follows the join is compiled in the same method."""
    pts = spark.range(50).selectExpr("id AS p", "CASE WHEN id <> 7 THEN 36 + id / 10 END AS latitude",
                                     "CASE WHEN id <> 9 THEN -76 + id / 10 END AS longitude")
    tiles = grid_tiles(computed_grid(spark), carry=["stat_area", "depth"])
    got = within_cells(pts, tiles, keep=["stat_area", "depth"])
    assert code_size(got.where("id IS NOT NULL").groupBy("id").agg(F.min("p"), F.max("depth"))) < 0.75 * HUGE_METHOD
    assert {r["p"] for r in got.where("id IS NULL").collect()} >= {7, 9} and got.select("p").distinct().count() == 50


def test_only_tiles_with_points_are_joined(spark, static_plans, tmp_out):
    """of a grid too large to broadcast, the tiles of a few points are not."""
    spark.range(90).selectExpr("id AS p", "CASE WHEN id <> 7 THEN 36.01 + id % 3 / 100 END AS latitude",
                               "-75.95 + id % 10 / 100 AS longitude").write.parquet(tmp_out)
    pts = spark.read.parquet(tmp_out)
    grid = computed_grid(spark)
    want = sorted(map(tuple, within_cells(pts, grid).collect()), key=str)
    for limit, join in ((40_000, "BroadcastHashJoin"), (0, "SortMergeJoin")):
        tiles = grid_tiles(grid, broadcast_limit=limit)
        assert not tiles.broadcast
        got = within_cells(pts, tiles)
        assert join in got._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert read_again_alike(pts.unionByName(pts).where("p > 1").repartition(3))
    assert not read_again_alike(pts.groupBy("p").agg(F.avg("latitude").alias("latitude"))) and not read_again_alike(pts.withColumn("x", F.rand()))


def test_rings_with_a_missing_coordinate(spark):
    """A ring with a missing coordinate beside whole and shorter ones."""
    odd = [(0.0, 0.0), (1.0, 0.0), (None, 1.0), (0.0, 1.0), (0.0, 0.0)]
    tri = [(2.0, 0.0), (3.0, 0.0), (2.0, 1.0), (2.0, 0.0)]
    pts = spark.createDataFrame([(1, 0.2, 2.2), (2, 0.2, 5.5), (3, 0.0, 2.5), (4, 0.5, 2.5), (5, None, 2.5)],
                                "p long, latitude double, longitude double")
    for cells in ([(2, tri), (3, ring(5.0, 0.0, 1.0, 1.0))], [(1, odd), (2, tri), (3, ring(5.0, 0.0, 1.0, 1.0))]):
        got = within_cells(pts, spark.createDataFrame(cells, RING))
        assert {(r["p"], r["id"]) for r in got.collect()} == {(1, 2), (2, 3), (3, None), (4, None), (5, None)}


def test_an_emptied_product_is_computed_once(spark, tmp_out):
    """a frame that turns out empty while it is written is not computed again to say so."""
    seen = spark.sparkContext.accumulator(0)

    def look(x):
        seen.add(1)
        return x

    look = F.udf(look, "double").asNondeterministic()
    rows = spark.range(40).select((F.col("id") % 4).cast("int").alias("time"), look(F.lit(-5.0)).alias("t"))
    daily = rows.groupBy("time").agg(F.avg("t").alias("t")).where("t > 0")
    assert publish_days(daily, tmp_out) == []
    assert seen.value == 40
