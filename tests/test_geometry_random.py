"""Point in polygon on random shapes against an exact reference computed in
Python with rational arithmetic (strict interior, boundary excluded)."""

import random
from fractions import Fraction

from pyspark.sql import functions as F
from pyspark.sql import types as T

from bottomgrid.functions.geometry import strictly_within, strictly_within_vertices, vertex_columns
from bottomgrid.operators.spatial import within_cells

RING = T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))


def inside_exact(ring, px, py):
    """Strict interior by ray casting with exact fractions; on-edge -> False."""
    px, py = Fraction(px), Fraction(py)
    pts = [(Fraction(x), Fraction(y)) for x, y in ring]
    inside = False
    for (ax, ay), (bx, by) in zip(pts, pts[1:]):
        cross = (bx - ax) * (py - ay) - (by - ay) * (px - ax)
        if cross == 0 and min(ax, bx) <= px <= max(ax, bx) and min(ay, by) <= py <= max(ay, by):
            return False
        if (ay > py) != (by > py):
            if px < (bx - ax) * (py - ay) / (by - ay) + ax:
                inside = not inside
    return inside


def shapes(rnd, n):
    out = []
    for i in range(n):
        x0, y0 = rnd.randint(0, 40) / 4, rnd.randint(0, 40) / 4
        w, h, s = rnd.randint(1, 8) / 4, rnd.randint(1, 8) / 4, rnd.randint(-4, 4) / 8
        out.append((i, [(x0, y0), (x0 + w, y0), (x0 + w + s, y0 + h), (x0 + s, y0 + h), (x0, y0)]))
    for i in range(n, n + 20):       # triangles too (4-point rings)
        a = (rnd.randint(0, 40) / 4, rnd.randint(0, 40) / 4)
        b = (a[0] + rnd.randint(1, 8) / 4, a[1] + rnd.randint(-4, 4) / 4)
        c = (a[0] + rnd.randint(-4, 4) / 4, a[1] + rnd.randint(1, 8) / 4)
        out.append((i, [a, b, c, a]))
    return out


def test_random_shapes_both_forms(spark):
    rnd = random.Random(11)
    cells = shapes(rnd, 60)
    # a third of the points sit on the 1/4 lattice the shapes are built on,
    # so vertices and edges are hit exactly
    pts = [(k, rnd.randint(-4, 48) / 4 if k % 3 == 0 else rnd.uniform(-1, 12),
            rnd.randint(-4, 48) / 4 if k % 3 == 0 else rnd.uniform(-1, 12)) for k in range(3000)]
    grid = spark.createDataFrame([(i, [{"x": x, "y": y} for x, y in r]) for i, r in cells],
                                 T.StructType([T.StructField("id", T.LongType()), T.StructField("ring", RING)]))
    pdf = spark.createDataFrame(pts, "k int, longitude double, latitude double")
    expected = sorted((k, i) for k, x, y in pts for i, r in cells if inside_exact(r, x, y))
    joined = within_cells(pdf, grid, tile=0.75, how="inner").select("k", "id").collect()
    assert sorted((r.k, r.id) for r in joined) == expected
    # both predicate forms agree row by row on every (point, shape) pair
    pairs = pdf.crossJoin(grid.withColumns(vertex_columns(F.col("ring"), 5)))
    px, py = F.col("longitude"), F.col("latitude")
    forms = pairs.select(
        "k", "id", strictly_within(F.col("ring"), px, py).alias("lam"),
        strictly_within_vertices([F.col(f"_x{i}") for i in range(5)],
                                 [F.col(f"_y{i}") for i in range(5)], px, py).alias("vert"))
    assert forms.where(F.col("lam") != F.col("vert")).count() == 0
    assert sorted((r.k, r.id) for r in forms.where("lam").collect()) == expected
