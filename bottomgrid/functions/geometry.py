"""Polygon predicates as native column expressions (no Python UDF).

A ring is ``array<struct<x double, y double>>`` with the first point repeated
at the end. Everything here compiles to Catalyst higher-order functions, so it
runs inside whole-stage code generation next to the join that uses it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _edges(ring: Column) -> Column:
    return F.sequence(F.lit(0), F.size(ring) - 2)


def crossing_inside(ring: Column, px: Column, py: Column) -> Column:
    """Even-odd ray casting: True when a ray to +x crosses the ring an odd
    number of times. Points on the boundary may go either way."""
    def step(acc, i):
        a, b = ring[i], ring[i + 1]
        ax, ay, bx, by = a["x"], a["y"], b["x"], b["y"]
        straddles = (ay > py) != (by > py)
        x_cross = (bx - ax) * (py - ay) / F.nullif(by - ay, F.lit(0.0)) + ax
        return F.when(straddles & (px < x_cross), ~acc).otherwise(acc)

    return F.aggregate(_edges(ring), F.lit(False), step)


def on_boundary(ring: Column, px: Column, py: Column) -> Column:
    """True when the point lies exactly on an edge or a vertex."""
    def on_edge(i):
        a, b = ring[i], ring[i + 1]
        ax, ay, bx, by = a["x"], a["y"], b["x"], b["y"]
        cross = (bx - ax) * (py - ay) - (by - ay) * (px - ax)
        return ((cross == F.lit(0.0))
                & px.between(F.least(ax, bx), F.greatest(ax, bx))
                & py.between(F.least(ay, by), F.greatest(ay, by)))

    return F.exists(_edges(ring), on_edge)


# Rings up to this many points are tested with an unrolled expression over
# vertex columns (longer rings use the higher-order-function form).
UNROLL_MAX_POINTS = 8


def vertex_columns(ring: Column, max_points: int, whole: bool = False) -> dict[str, Column]:
    """``_x0.._x{m-1}``, ``_y0..``: the ring's vertices as plain columns,
    NULL past the ring's own length. Computed once on the dimension side.

    Where every ring is known to be ``whole`` (no coordinate is NULL), its last
    point is repeated instead: an edge from a point to itself changes nothing,
    and the columns are never NULL, which shortens the code of a test on them."""
    out = {}
    for i in range(max_points):
        v, last = F.get(ring, F.lit(i)), F.get(ring, F.size(ring) - 1)
        for c in ("x", "y"):
            out[f"_{c}{i}"] = F.coalesce(v[c], last[c], F.lit(0.0)) if whole else v[c]
    return out


def strictly_within_vertices(xs: list[Column], ys: list[Column], px: Column, py: Column) -> Column:
    """Same predicate as :func:`strictly_within` on vertex columns: plain
    arithmetic, so it compiles inside whole-stage code generation. An edge
    whose end vertex is NULL (past the ring's length) is switched off. The
    tests are written out shortly (no nested calls), so that the code of the
    join around them stays short enough to be compiled."""
    parity, boundary = F.lit(False), F.lit(False)
    for i in range(len(xs) - 1):
        ax, ay, bx, by = xs[i], ys[i], xs[i + 1], ys[i + 1]
        straddles = (ay > py) != (by > py)
        x_cross = F.try_divide((bx - ax) * (py - ay), by - ay) + ax
        crosses = F.coalesce(straddles & (px < x_cross), F.lit(False))
        cross = (bx - ax) * (py - ay) - (by - ay) * (px - ax)
        beside = (((px < ax) & (px < bx)) | ((px > ax) & (px > bx))
                  | ((py < ay) & (py < by)) | ((py > ay) & (py > by)))
        touches = F.coalesce((cross == F.lit(0.0)) & ~beside, F.lit(False))
        parity = parity != crosses
        boundary = boundary | touches
    return parity & ~boundary


def strictly_within(ring: Column, px: Column, py: Column) -> Column:
    """The 'within' predicate: interior only, the boundary matches nothing."""
    return crossing_inside(ring, px, py) & ~on_boundary(ring, px, py)


def ring_bbox(ring: Column) -> dict[str, Column]:
    # field extraction over the array of structs (no lambda, so code-generated)
    xs, ys = ring["x"], ring["y"]
    return {"min_x": F.array_min(xs), "max_x": F.array_max(xs),
            "min_y": F.array_min(ys), "max_y": F.array_max(ys)}


def ring_is_closed(ring: Column) -> Column:
    first, last = F.element_at(ring, 1), F.element_at(ring, -1)
    return (F.size(ring) >= 4) & (first["x"] == last["x"]) & (first["y"] == last["y"])
