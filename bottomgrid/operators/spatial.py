"""Spatial joins: nearest raster cell (J1), point in polygon (J2), distinct-key
compute-and-join-back (J3), grid attributes (J4), nearest centroid (J6) and
grid assignment (C11).

All of them end in equi-joins Catalyst can plan as broadcast-hash or
shuffle-hash joins; the side that is broadcast is sized first.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import (UNROLL_MAX_POINTS, ring_bbox, strictly_within,
                                  strictly_within_vertices, vertex_columns)
from ..session import checkpoint_dir, scratch_path
from .sizing import broadcast_if_small, read_again_alike

BLOCK = 64               # cells along each side of a packed raster block
BLOCK_OVERHEAD = 256     # bytes of a packed block besides its values


# --------------------------------------------------------------------------
# J1 nearest raster cell
# --------------------------------------------------------------------------

@dataclass(frozen=True)
class Axis:
    """One raster axis: index range and the coordinate at both ends."""
    idx_col: str
    val_col: str
    lo_idx: int
    hi_idx: int
    lo_val: float
    hi_val: float

    @property
    def n(self) -> int:
        return self.hi_idx - self.lo_idx + 1

    def approx_index(self, x: Column) -> Column:
        if self.hi_idx == self.lo_idx:
            return F.lit(self.lo_idx).cast("double")
        step = (self.hi_val - self.lo_val) / (self.hi_idx - self.lo_idx)
        return F.lit(self.lo_idx) + (x - F.lit(self.lo_val)) / F.lit(step)


@dataclass(frozen=True)
class RasterAxes:
    lat: Axis
    lon: Axis
    cells: int


@dataclass(frozen=True)
class PackedRaster:
    """A raster as written blocks, with its axes beside them. ``table`` has a
    row per block (``kind`` block: block numbers ``k1, k2`` and the ``cells``
    as one array, row by row, NULL where there is none) and per axis value
    (``kind`` lat or lon: index ``k1`` and coordinate ``lo``)."""
    table: DataFrame
    axes: RasterAxes
    blocks: int
    width: int             # bytes of one value

    def axis_values(self, axis: Axis) -> DataFrame:
        kind = "lat" if axis == self.axes.lat else "lon"
        return self.table.where(F.col("kind") == kind).select(F.col("k1").alias(axis.idx_col), F.col("lo").alias(axis.val_col))


def _packed_rows(raster: DataFrame, lat_idx: str, lon_idx: str, lat: str, lon: str, value: str) -> DataFrame:
    """Blocks and axis values in one aggregation: a cell goes into its block
    and, pre-aggregated by each task, into its two axis values."""
    i, j = F.col(lat_idx).cast("bigint"), F.col(lon_idx).cast("bigint")
    kind = dict(raster.dtypes)[value]
    at = (F.pmod(i, F.lit(BLOCK)) * BLOCK + F.pmod(j, F.lit(BLOCK))).cast("int")
    none, no_cell = F.lit(None).cast("double"), F.lit(None).cast(f"struct<at:int,v:{kind}>")

    def row(kind: str, k1, k2, x, cell):
        return F.struct(F.lit(kind).alias("kind"), k1.alias("k1"), k2.alias("k2"), x.alias("x"), cell.alias("cell"))

    zero = F.lit(0).cast("bigint")
    rows = raster.where(F.col(lat_idx).isNotNull() & F.col(lon_idx).isNotNull()).select(F.explode(F.array(
        row("block", F.floor(i / BLOCK), F.floor(j / BLOCK), none, F.struct(at.alias("at"), F.col(value).alias("v"))),
        row("lat", i, zero, F.col(lat).cast("double"), no_cell),
        row("lon", j, zero, F.col(lon).cast("double"), no_cell))).alias("r"))
    out = rows.select("r.*").groupBy("kind", "k1", "k2").agg(
        F.min("x").alias("lo"), F.max("x").alias("hi"), F.count(F.lit(1)).alias("n"), F.collect_list("cell").alias("cells"))
    have = F.transform("cells", lambda c: c["at"])
    rest = F.array_except(F.sequence(F.lit(0), F.lit(BLOCK * BLOCK - 1)), have)
    full = F.concat(F.col("cells"), F.transform(rest, lambda k: F.struct(k.alias("at"), F.lit(None).cast(kind).alias("v"))))
    twice = F.size("cells") - F.size(F.array_distinct(have))
    dense = F.when(F.col("kind") == "block", F.transform(F.array_sort(full), lambda c: c["v"]))
    return out.select("kind", "k1", "k2", "lo", "hi", "n", F.when(F.col("kind") == "block", twice).alias("twice"),
                      dense.alias("cells"))


def pack_raster(raster: DataFrame, path: str | None = None, lat_idx="lat_idx", lon_idx="lon_idx",
                lat="lat", lon="lon", value: str = "elevation") -> PackedRaster:
    """Pack a raster, given as a long table, into square blocks, and keep its
    axes beside them: one pass over the raster, one written table (``path``,
    by default in the shared checkpoint folder), from which the axes are taken
    and checked. ``open_packed`` opens it again."""
    spark = raster.sparkSession
    path = path or scratch_path(spark, f"raster-{uuid.uuid4().hex}")
    (_packed_rows(raster, lat_idx, lon_idx, lat, lon, value).write.mode("overwrite").partitionBy("kind").parquet(path))
    return open_packed(spark, path, lat_idx, lon_idx, lat, lon)


def open_packed(spark: SparkSession, path: str, lat_idx="lat_idx", lon_idx="lon_idx", lat="lat", lon="lon") -> PackedRaster:
    """A packed raster that ``pack_raster`` wrote. An axis is refused on which
    the nearest value cannot be found from its two ends: an index without a
    value, two values for one index, or a value off the place where a regular
    axis has it; so is a raster with two values for a cell."""
    try:
        table = spark.read.parquet(path)
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" in str(e):    # nothing was written
            raise ValueError("raster is empty") from e
        raise
    if not table.columns or "kind" not in table.columns:
        raise ValueError("raster is empty")
    ends = {r["kind"]: r for r in table.groupBy("kind").agg(
        F.min("k1").alias("a"), F.max("k1").alias("b"), F.min_by("lo", "k1").alias("c"), F.max_by("lo", "k1").alias("d"),
        F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"), F.sum("twice").alias("twice")).collect()}
    if "lat" not in ends:
        raise ValueError("raster is empty")
    axes = [Axis(idx, val, r["a"], r["b"], r["c"], r["d"])
            for idx, val, r in ((lat_idx, lat, ends["lat"]), (lon_idx, lon, ends["lon"]))]
    if ends["block"]["twice"]:
        raise ValueError(f"raster has {ends['block']['twice']} cells twice")
    _check_axes(table, dict(zip(("lat", "lon"), axes)))
    width = 8 if dict(table.dtypes)["cells"] in ("array<bigint>", "array<double>") else 4
    return PackedRaster(table, RasterAxes(*axes, ends["lat"]["n"]), ends["block"]["rows"], width)


def _check_axes(table: DataFrame, axes: dict[str, Axis], tolerance: float = 1e-3) -> None:
    step = {k: (x.hi_val - x.lo_val) / max(x.hi_idx - x.lo_idx, 1) for k, x in axes.items()}
    at = F.lit(None).cast("double")
    for k, x in axes.items():
        at = F.when(F.col("kind") == k, F.lit(x.lo_val) + (F.col("k1") - F.lit(x.lo_idx)) * F.lit(step[k])).otherwise(at)
    off = F.greatest(F.abs(F.col("lo") - at), F.abs(F.col("hi") - at))
    for r in table.where("kind <> 'block'").groupBy("kind").agg(
            F.count(F.lit(1)).alias("n"), F.max(off).alias("off"), F.max(F.col("hi") - F.col("lo")).alias("apart")).collect():
        axis = axes[r["kind"]]
        if r["n"] != axis.n:
            raise ValueError(f"raster axis {axis.idx_col} has {axis.n - r['n']} indices without a value")
        if axis.n > 1 and (not step[r["kind"]] or r["off"] > tolerance * abs(step[r["kind"]])) or r["apart"]:
            raise ValueError(f"raster axis {axis.val_col} is not regular")


def axis_pairs(values: DataFrame, axis: Axis, limit: int | None = None) -> DataFrame:
    """``(_c0, _v0, _c1, _v1)``: every axis index with its coordinate and the
    next index (clamped at the top end) with its coordinate. Built from the
    raster's own axis values (a dimension of ``axis.n`` rows)."""
    vals = values.select(F.col(axis.idx_col).alias("_i"), F.col(axis.val_col).alias("_v"))
    nxt = vals.select(F.col("_i").alias("_c1"), F.col("_v").alias("_v1"))
    nxt, _ = broadcast_if_small(nxt, axis.n, 24, limit)
    c1 = F.least(F.col("_i") + 1, F.lit(axis.hi_idx))
    return (vals.join(nxt, c1 == nxt["_c1"], "left")
                .select(F.col("_i").alias("_c0"), F.col("_v").alias("_v0"), "_c1", "_v1"))


def _nearest_on_axis(df: DataFrame, values: DataFrame, axis: Axis, x: str, out: str,
                     limit: int | None = None) -> DataFrame:
    """Index of the axis value nearest to ``x``; a tie goes to the larger
    axis value and points beyond the ends clamp to the edge.

    Arithmetic gives the lower candidate index; one equi-join with the axis
    pair table (at most ``axis.n`` rows, broadcast) brings the exact stored
    coordinates of both candidates, so the distance comparison uses the
    raster's own values, not a re-computed step.
    """
    pairs, _ = broadcast_if_small(axis_pairs(values, axis, limit), axis.n, 40, limit)
    lo, hi = F.lit(axis.lo_idx), F.lit(axis.hi_idx)
    c0 = F.least(F.greatest(F.floor(axis.approx_index(F.col(x))), lo), hi)
    df = df.withColumn("_c0", c0).join(pairs, "_c0", "left")
    d0 = F.abs(F.col(x) - F.col("_v0"))
    d1 = F.abs(F.col(x) - F.col("_v1"))
    pick = (F.when(F.col(x).isNull(), F.lit(None))
            .when(d1 < d0, F.col("_c1"))
            .when(d0 < d1, F.col("_c0"))
            .when(F.col("_v1") >= F.col("_v0"), F.col("_c1"))
            .otherwise(F.col("_c0")))
    return df.withColumn(out, pick.cast("bigint")).drop("_c0", "_c1", "_v0", "_v1")


def nearest_raster(df: DataFrame, raster: DataFrame | PackedRaster,
                   lat: str = "latitude", lon: str = "longitude",
                   value: str = "elevation", out: str = "inferred_depth",
                   broadcast_limit: int | None = None) -> DataFrame:
    """Attach ``abs(value)`` of the nearest raster cell, truncated to int;
    NULL where the raster has no such cell.

    Nearest is taken on each axis independently. The raster is packed first
    (one pass; give a ``PackedRaster`` to use it again). A point finds its
    block by number and its cell in the block by position. Blocks take 4 or 8
    bytes a cell, so rasters of tens of millions of cells pass the size check
    and are broadcast (``broadcast_limit`` bytes, default
    ``sizing.DEFAULT_BROADCAST_BYTES``); beyond it the blocks, not the cells,
    are shuffled, and AQE splits a block in which very many points lie."""
    p = raster if isinstance(raster, PackedRaster) else pack_raster(raster, value=value)
    i, j = F.col("_lat_i"), F.col("_lon_i")
    located = df
    for axis, x, name in ((p.axes.lat, lat, "_lat_i"), (p.axes.lon, lon, "_lon_i")):
        located = _nearest_on_axis(located, p.axis_values(axis), axis, x, name, broadcast_limit)
    located = located.withColumns({
        "_bi": F.floor(i / BLOCK), "_bj": F.floor(j / BLOCK),
        "_at": (F.pmod(i, F.lit(BLOCK)) * BLOCK + F.pmod(j, F.lit(BLOCK))).cast("int")}).drop("_lat_i", "_lon_i")
    blocks = p.table.where("kind = 'block'").select(F.col("k1").alias("_bi"), F.col("k2").alias("_bj"), F.col("cells").alias("_cells"))
    blocks, _ = broadcast_if_small(blocks, p.blocks, BLOCK * BLOCK * p.width + BLOCK_OVERHEAD, broadcast_limit)
    return (located.join(blocks, ["_bi", "_bj"], "left")
            .withColumn(out, F.abs(F.get("_cells", "_at")).cast("int")).drop("_bi", "_bj", "_at", "_cells"))


# --------------------------------------------------------------------------
# J2 point in polygon
# --------------------------------------------------------------------------

@dataclass(frozen=True)
class TileLevel:
    """Cells of one size class, listed per tile: ``_tx, _ty`` and ``_cells``,
    an array of structs (id, bbox, ring, carried columns)."""
    tiles: DataFrame
    tile: float
    broadcast: bool


@dataclass(frozen=True)
class GridTiles:
    tiles: DataFrame       # (_tx, _ty, id, bbox, ring or vertex columns) per cell x tile
    tile: float
    broadcast: bool
    cells: int             # number of grid cells (sizes the attribute broadcast)
    max_points: int        # longest ring of the main level (chooses the unrolled containment test)
    others: tuple[TileLevel, ...] = ()   # the other size classes, if there are any
    width: int = 256       # bytes of a tile row
    limit: int | None = None    # bytes that may be broadcast


SMALL, LARGE = 0.125, 4.0   # of the median extent: cells between them are one level


def _level(extent: Column, median: float) -> Column:
    """Size class of a cell: 0 for those near the median, then one per factor
    of four on either side. A cell without extent contains nothing."""
    up = F.ceil(F.log(4.0, extent / (LARGE * median)))
    down = -F.greatest(F.ceil(F.log(4.0, F.lit(SMALL * median) / extent)), F.lit(1))
    level = F.when(extent > LARGE * median, up).when((extent > 0) & (extent <= SMALL * median), down).otherwise(0)
    return level.cast("int")


def _edge(level: int, median: float) -> float:
    """Tile edge of a level other than 0; no cell of the level is longer."""
    return median * (LARGE * 4.0 ** level if level > 0 else SMALL * 4.0 ** (level + 1))


def _rows_of_their_own(df: DataFrame) -> DataFrame:
    """The same rows, behind a generator: what is asked of the columns is not
    moved below it. Otherwise each of the many tests of a box or a level, and
    those that the planner infers, holds the whole expression of the ring, and
    the code of the listing becomes one method too long to be compiled."""
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("_r")).select("_r.*")


def grid_tiles(grid: DataFrame, tile: float | None = None, id_col: str = "id",
               ring: str = "ring", broadcast_limit: int | None = None,
               carry: list[str] | None = None) -> GridTiles:
    """List each cell under the square tiles that its bounding box touches.

    Cells are keyed at the level of their own extent: tiles of the level with
    the most cells have the median extent as their edge (or ``tile``), and a
    cell many times larger or smaller than that goes to a level whose edge
    fits it, where it touches four tiles at most. So a few odd cells neither
    multiply the tile rows nor crowd one tile. Two aggregates over the grid (a
    dimension) give the median and, per level, the count, the largest extents
    and the longest ring; they bound each level's tile rows, which decides
    broadcast versus shuffle before anything is shipped. ``carry`` lists cell
    columns (e.g. the attributes J4 adds) that travel with every tile row, so
    one join both locates a point and attaches its cell."""
    bb = ring_bbox(F.col(ring))
    carry = list(carry or [])
    cells = _rows_of_their_own(grid.select(F.col(id_col).alias("id"), F.col(ring).alias("ring"),
                                           *[v.alias(k) for k, v in bb.items()], *carry))
    w, h = F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y")
    extent = F.greatest(w, h)
    median = float(cells.agg(F.percentile_approx(F.when(extent > 0, extent), 0.5, 1000)).first()[0] or 1.0)
    cells = cells.withColumn("_level", _level(extent, median))
    levels = {r["_level"]: r for r in cells.groupBy("_level").agg(
        F.count(F.lit(1)).alias("n"), F.max(w).alias("mw"), F.max(h).alias("mh"), F.max(F.size("ring")).alias("verts"),
        F.max(F.coalesce(F.exists("ring", lambda v: v["x"].isNull() | v["y"].isNull()), F.lit(False))).alias("holes")).collect()}
    main = max(levels, key=lambda k: (levels[k]["n"], -abs(k)), default=0)

    def listed(level: int, edge: float) -> tuple[DataFrame, int, int]:
        """Tile rows of a level, a bound of their number, and the bytes of one."""
        st = levels.get(level)
        n, mw, mh, verts = (st["n"], st["mw"] or 0, st["mh"] or 0, st["verts"] or 5) if st else (0, 0, 0, 5)
        t = F.lit(edge)
        span = {k: F.sequence(F.floor(F.col(f"min_{c}") / t), F.floor(F.col(f"max_{c}") / t)) for k, c in (("_tx", "x"), ("_ty", "y"))}
        own = cells.where(F.col("_level") == level).drop("_level")
        if level == main and verts <= UNROLL_MAX_POINTS:
            # short rings (grid cells): vertices unpacked once here, so the join
            # condition is plain column arithmetic
            own = own.withColumns(vertex_columns(F.col("ring"), verts, st is not None and not st["holes"])).drop("ring")
        for k, v in span.items():
            own = own.withColumn(k, F.explode(v))
        if level == main:       # a cell without a box has no tile
            own = own.withColumns({k: F.coalesce(k, F.lit(0.0)) for k in bb})
        return own, n * (int(mw / edge) + 2) * (int(mh / edge) + 2), 72 + 24 * verts + 16 * len(carry)

    edge = tile or (median if main == 0 else _edge(main, median))
    def sized(rows: DataFrame, bound: int, width: int) -> tuple[DataFrame, bool]:
        """Broadcast if proven small; else kept from a broadcast by the planner's
        own guess, which knows the size of the grid's files and not of its tiles."""
        rows, bc = broadcast_if_small(rows, bound, width, broadcast_limit)
        return (rows if bc else rows.hint("merge")), bc

    rows, bound, main_width = listed(main, edge)
    tiles, is_bc = sized(rows, bound, main_width)
    others = []
    for k in sorted(levels):
        if k == main:
            continue
        size = _edge(k, median) if k else median
        rows, bound, width = listed(k, size)
        per = rows.groupBy("_tx", "_ty").agg(F.collect_list(F.struct(
            "id", "ring", "min_x", "max_x", "min_y", "max_y", *carry)).alias("_cells"))
        per, bc = sized(per, bound, width)
        others.append(TileLevel(per, size, bc))
    count = sum(r["n"] for r in levels.values())
    return GridTiles(tiles, edge, is_bc, count, int(levels[main]["verts"] or 5) if levels else 5, tuple(others),
                     main_width, broadcast_limit)


def _tile_keys(points: DataFrame, tile: float, lat: str, lon: str) -> dict[str, Column]:
    t = F.lit(tile)
    return {"_tx": F.floor(points[lon] / t), "_ty": F.floor(points[lat] / t)}


def _tiles_with_points(points: DataFrame, gt: GridTiles, lat: str, lon: str) -> DataFrame:
    """The tile rows for the join with ``points``. A grid too large to ship may
    have far more tiles than these points lie in: where reading the points twice
    is cheap and sure, their distinct tiles are found first (one narrow pass,
    pre-aggregated by each task), and the rows of those tiles are counted. If
    they are few enough they alone are broadcast, and the points, rows as wide
    as they come, are neither shuffled nor sorted. Otherwise the join stays a
    shuffle of both sides. No tile without a point can match, so the rows are
    the same."""
    if gt.broadcast or not read_again_alike(points):
        return gt.tiles
    checkpoint_dir(points.sparkSession)
    keys = points.select(*[c.alias(k) for k, c in _tile_keys(points, gt.tile, lat, lon).items()]).distinct().checkpoint()
    keys, few = broadcast_if_small(keys, keys.count(), 32, gt.limit)
    if not few:
        return gt.tiles
    rows = gt.tiles.join(keys, ["_tx", "_ty"], "left_semi")
    kept, few = broadcast_if_small(rows, rows.count(), gt.width, gt.limit)
    return F.broadcast(kept.checkpoint()) if few else gt.tiles


def _cells_of_other_levels(points: DataFrame, gt: GridTiles, lat: str, lon: str, keep: list[str]) -> DataFrame:
    """``points`` with ``_more``: the cells of the other levels that strictly
    contain each point (their id and the columns to ``keep``). One lookup per
    occupied level, by a unique key."""
    out, found = points, []
    for k, level in enumerate(gt.others):
        cells = f"_cells{k}"
        out = (out.withColumns(_tile_keys(out, level.tile, lat, lon))
               .join(level.tiles.withColumnRenamed("_cells", cells), ["_tx", "_ty"], "left").drop("_tx", "_ty"))
        px, py = out[lon], out[lat]
        hit = F.filter(F.col(cells), lambda c: (px > c["min_x"]) & (px < c["max_x"]) & (py > c["min_y"]) & (py < c["max_y"])
                       & strictly_within(c["ring"], px, py))
        hit = F.transform(hit, lambda c: F.struct(*[c[k].alias(k) for k in ("id", *keep)]))
        out = out.withColumn(cells, F.coalesce(hit, F.array()))
        found.append(cells)
    return out.withColumn("_more", F.concat(*found)).drop(*found)


def within_cells(points: DataFrame, grid: DataFrame | GridTiles, tile: float | None = None,
                 lat: str = "latitude", lon: str = "longitude", id_col: str = "id",
                 how: str = "left", keep: list[str] | None = None) -> DataFrame:
    """Left-join each point to every cell that strictly contains it.

    The point gets one tile key, the cells are listed under every tile their
    box touches, and the equi-join on the tile carries the exact containment
    test as its join condition. Where the grid has cells of very different
    sizes, the point also looks up one tile per other level; what it finds
    there travels as rows of its own, which match nothing in the join. Points
    on an edge or vertex match nothing; overlapping cells give one row each;
    NULL positions keep a NULL id (with ``how="inner"`` they go)."""
    gt = grid if isinstance(grid, GridTiles) else grid_tiles(grid, tile)
    p = points
    if gt.others:
        # the marker row (NULL) takes part in the join below, the others carry their cell
        p = _cells_of_other_levels(p, gt, lat, lon, [c for c in keep or [] if c in gt.tiles.columns])
        marker = F.array(F.get("_more", F.lit(-1)))    # one NULL of the elements' type
        p = p.withColumns({"_matched": F.size("_more") > 0, "_other": F.explode(F.concat(marker, F.col("_more")))}).drop("_more")
    keys = _tile_keys(p, gt.tile, lat, lon)
    if gt.others:
        # rows that carry their cell match no tile; keys of their own spread
        # them over the tasks of the join (NULL keys would all go to one)
        own = F.xxhash64(points[lon], points[lat], F.col("_other.id"))
        keys = {k: F.when(F.col("_other").isNull(), v).otherwise(own) for k, v in keys.items()}
    # a point without a position has no key and meets no cell; known not to be
    # NULL, the position keeps the code of the tests short enough to be compiled
    # together with what follows the join
    p = p.withColumns({**keys, "_at_x": F.coalesce(points[lon], F.lit(0.0)), "_at_y": F.coalesce(points[lat], F.lit(0.0))})
    g = _tiles_with_points(points, gt, lat, lon).withColumnRenamed("id", "_cell_id")
    px, py = p["_at_x"], p["_at_y"]
    # open bounding box first: cheap comparisons reject most candidates
    # before the exact ring test runs
    in_box = (px > g["min_x"]) & (px < g["max_x"]) & (py > g["min_y"]) & (py < g["max_y"])
    if "ring" in g.columns:
        exact = strictly_within(g["ring"], px, py)
    else:
        m = gt.max_points
        exact = strictly_within_vertices([g[f"_x{i}"] for i in range(m)],
                                         [g[f"_y{i}"] for i in range(m)], px, py)
    cond = (p["_tx"] == g["_tx"]) & (p["_ty"] == g["_ty"]) & in_box & exact
    if gt.others:
        cond = cond & p["_other"].isNull()
    joined = p.join(g, cond, "left" if gt.others else how)
    extra = [c for c in gt.tiles.columns if c not in ("id", "_tx", "_ty", *(keep or []))]
    joined = joined.drop(p["_tx"]).drop(p["_ty"]).drop(g["_tx"]).drop(g["_ty"]).drop("_at_x", "_at_y")
    if gt.others:
        lost = F.col("_cell_id").isNull() & F.col("_other").isNull()
        joined = joined.where(~lost if how == "inner" else ~(lost & F.col("_matched")))
        joined = joined.withColumns({"_cell_id": F.coalesce("_cell_id", "_other.id"),
                                     **{c: F.coalesce(c, f"_other.{c}") for c in keep or [] if c in g.columns}})
        joined = joined.drop("_other", "_matched")
    return joined.drop(*extra).withColumnRenamed("_cell_id", id_col)


# --------------------------------------------------------------------------
# J3 distinct-key compute and join back
# --------------------------------------------------------------------------

def once_per_key(df: DataFrame, keys: list[str],
                 op: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run ``op`` once per distinct key and left-join its new columns back.

    Worth it when ``op`` is costly per row and keys repeat a lot: the distinct
    is pre-aggregated map-side, so a hot key costs one row per map task. NULL
    keys join back with null-safe equality, so such rows survive."""
    distinct_keys = df.select(*keys).dropDuplicates(keys)
    enriched = op(distinct_keys)
    added = [c for c in enriched.columns if c not in keys]
    right = enriched.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *added)
    cond = None
    for k in keys:
        c = df[k].eqNullSafe(right[f"_k_{k}"])
        cond = c if cond is None else cond & c
    out = df.join(right, cond, "left")
    for k in keys:
        out = out.drop(right[f"_k_{k}"])
    return out


# --------------------------------------------------------------------------
# J4 grid attributes
# --------------------------------------------------------------------------

def grid_attributes(grid: DataFrame, id_col: str = "id") -> DataFrame:
    return grid.select(F.col(id_col).alias("id"), "stat_area", "depth",
                       "centroid_lon", "centroid_lat")


def attach_cell(df: DataFrame, grid: DataFrame, id_col: str = "id",
                grid_rows: int | None = None,
                lat: str = "latitude", lon: str = "longitude",
                broadcast_limit: int | None = None) -> DataFrame:
    """The cell centroid replaces the position; stat_area and depth are
    added. Left join on id; the grid is broadcast when its row count allows."""
    attrs = grid_attributes(grid)
    if grid_rows is None:
        grid_rows = attrs.count()
    attrs, _ = broadcast_if_small(attrs, grid_rows, 64, broadcast_limit)
    base = df.drop(*[c for c in (lat, lon, "stat_area", "depth") if c in df.columns])
    if id_col != "id":
        base = base.withColumnRenamed(id_col, "id")
    out = base.join(attrs, "id", "left")
    return (out.withColumnRenamed("centroid_lon", lon)
               .withColumnRenamed("centroid_lat", lat))


def drop_unlocated(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows without a cell (or without a centroid) are dropped."""
    return df.na.drop(how="any", subset=cols)


CELL_ATTRS = ["stat_area", "depth", "centroid_lon", "centroid_lat"]


def assign_grid(df: DataFrame, grid: DataFrame, tile: float | None = None,
                tiles: GridTiles | None = None, grid_rows: int | None = None,
                lat: str = "latitude", lon: str = "longitude",
                broadcast_limit: int | None = None) -> DataFrame:
    """C11: point in cell (J2), cell attributes (J4), drop unlocated rows.

    The tile rows carry the cell attributes, so locating a point and
    attaching its cell's centroid, area and depth is one join (with prebuilt
    ``tiles`` that lack them, a second, size-checked join adds them)."""
    if tiles is None:
        tiles = grid_tiles(grid, tile, broadcast_limit=broadcast_limit, carry=CELL_ATTRS)
    if not all(c in tiles.tiles.columns for c in CELL_ATTRS):
        located = within_cells(df, tiles, lat=lat, lon=lon)
        rows = grid_rows if grid_rows is not None else tiles.cells
        return drop_unlocated(attach_cell(located, grid, grid_rows=rows, lat=lat, lon=lon,
                                          broadcast_limit=broadcast_limit), ["id", lat])
    base = df.drop(*[c for c in ("stat_area", "depth") if c in df.columns])
    located = within_cells(base, tiles, lat=lat, lon=lon, keep=CELL_ATTRS)
    located = (located.drop(lat, lon)
               .withColumnRenamed("centroid_lon", lon).withColumnRenamed("centroid_lat", lat))
    return drop_unlocated(located, ["id", lat])


# --------------------------------------------------------------------------
# J6 nearest centroid (equal-area projection)
# --------------------------------------------------------------------------

# fixed values: Albers equal-area conic on the GRS80 ellipsoid as used for the
# contiguous US (standard parallels 29.5 and 45.5, origin 23 N 96 W).
ALBERS = {"lat1": 29.5, "lat2": 45.5, "lat0": 23.0, "lon0": -96.0,
          "a": 6378137.0, "f": 1 / 298.257222101}


def albers_constants(p: dict = ALBERS) -> dict:
    """e, n, C, rho0 of the Albers equal-area conic for parameters ``p``."""
    a, f = p["a"], p["f"]
    e2 = f * (2 - f)
    e = math.sqrt(e2)

    def q(phi):
        s = math.sin(phi)
        return (1 - e2) * (s / (1 - e2 * s * s) - (1 / (2 * e)) * math.log((1 - e * s) / (1 + e * s)))

    def m(phi):
        s = math.sin(phi)
        return math.cos(phi) / math.sqrt(1 - e2 * s * s)

    p1, p2, p0 = (math.radians(p[k]) for k in ("lat1", "lat2", "lat0"))
    n = (m(p1) ** 2 - m(p2) ** 2) / (q(p2) - q(p1))
    c = m(p1) ** 2 + n * q(p1)
    return {"a": a, "e2": e2, "e": e, "n": n, "c": c, "rho0": a * math.sqrt(c - n * q(p0)) / n,
            "lon0": math.radians(p["lon0"])}


def albers_xy(lat: Column, lon: Column, p: dict = ALBERS) -> tuple[Column, Column]:
    """Forward Albers equal-area projection as column arithmetic (metres)."""
    k = albers_constants(p)
    e, e2, n = k["e"], k["e2"], k["n"]
    s = F.sin(F.radians(lat))
    one = F.lit(1.0)
    q = F.lit(1 - e2) * (s / (one - F.lit(e2) * s * s)
                         - F.lit(1 / (2 * e)) * F.log((one - F.lit(e) * s) / (one + F.lit(e) * s)))
    rho = F.lit(k["a"] / n) * F.sqrt(F.lit(k["c"]) - F.lit(n) * q)
    theta = F.lit(n) * (F.radians(lon) - F.lit(k["lon0"]))
    return rho * F.sin(theta), F.lit(k["rho0"]) - rho * F.cos(theta)


def nearest_centroid(points: DataFrame, areas: DataFrame, x: str = "x", y: str = "y",
                     px: str = "px", py: str = "py", key: str = "stat_area",
                     out: str = "stat_area", max_areas: int = 10_000) -> DataFrame:
    """Label each point with the key of the nearest area centroid (ties
    go to the smaller key).

    Statistical areas are a small fixed dimension: their count is checked,
    they are shipped once as a constant array (like a broadcast), and every
    row folds over that array in one native expression: no join, no pair
    rows, no shuffle. Beyond ``max_areas`` the exact tiled search
    :func:`nearest_centroid_tiled` runs instead."""
    n = areas.count()
    if n == 0:      # the answer of both forms
        return points.withColumn(out, F.lit(None).cast(areas.schema[key].dataType))
    if n > max_areas:
        return nearest_centroid_tiled(points, areas, x, y, px, py, key, out)
    rows = areas.select(F.col(key).alias("k"), F.col(x).alias("x"), F.col(y).alias("y")) \
        .orderBy("k").collect()
    arr = F.array(*[F.struct(F.lit(r["k"]).alias("k"), F.lit(float(r["x"])).alias("x"),
                             F.lit(float(r["y"])).alias("y")) for r in rows])
    zero = F.struct(F.lit(None).cast("double").alias("d"), F.lit(None).cast(
        areas.schema[key].dataType).alias("k"))

    def better(acc, a):
        d = (F.col(px) - a["x"]) ** 2 + (F.col(py) - a["y"]) ** 2
        take = acc["d"].isNull() | (d < acc["d"]) | ((d == acc["d"]) & (a["k"] < acc["k"]))
        return F.when(take, F.struct(d.alias("d"), a["k"].alias("k"))).otherwise(acc)

    best = F.aggregate(arr, zero, better)["k"]
    return points.withColumn(out, F.when(_placed(px, py), best))


def _placed(px: str, py: str) -> Column:
    """Whether a point has a position (missing and NaN coordinates have none)."""
    return (F.col(px).isNotNull() & F.col(py).isNotNull()
            & ~F.isnan(F.col(px).cast("double")) & ~F.isnan(F.col(py).cast("double")))


def nearest_centroid_tiled(points: DataFrame, areas: DataFrame, x: str = "x", y: str = "y",
                           px: str = "px", py: str = "py", key: str = "stat_area",
                           out: str = "stat_area", tile: float | None = None) -> DataFrame:
    """J6 for an area table too large to ship whole: an exact search over
    square tiles.

    Areas are keyed by tile. Each distinct point position looks at its own
    tile and the eight around it (an equi-join on the tile key, so only nearby
    areas are paired with it) and keeps the nearest by ``min_by``. The answer
    is exact once the best distance is at most the tile's side: every area
    outside the nine tiles is farther than that. Positions not yet settled
    search again with tiles twice as large, until one tile is as large as the
    extent of everything (then every area has been seen). A position never
    looks at more than nine tiles a round, however far away it is."""
    checkpoint_dir(points.sparkSession)   # each round's settled points are checkpointed
    kind = areas.schema[key].dataType
    a0 = areas.select(F.col(key).alias("_k"), F.col(x).alias("_ax"), F.col(y).alias("_ay"))
    st = a0.agg(F.count(F.lit(1)).alias("n"), F.min("_ax").alias("x0"), F.max("_ax").alias("x1"),
                F.min("_ay").alias("y0"), F.max("_ay").alias("y1")).first()
    pos0 = points.where(_placed(px, py)).select(F.col(px).alias("_px"), F.col(py).alias("_py"))
    ext = pos0.agg(F.min("_px").alias("x0"), F.max("_px").alias("x1"),
                   F.min("_py").alias("y0"), F.max("_py").alias("y1")).first()
    if not st["n"] or ext["x0"] is None:
        return points.withColumn(out, F.lit(None).cast(kind))
    w, h = max(st["x1"] - st["x0"], 1e-9), max(st["y1"] - st["y0"], 1e-9)
    side = tile or max(math.sqrt(w * h / st["n"]) * 2, 1e-9)   # about four areas per tile
    span = max(max(st["x1"], ext["x1"]) - min(st["x0"], ext["x0"]),
               max(st["y1"], ext["y1"]) - min(st["y0"], ext["y0"]))
    pos, settled = pos0.dropDuplicates(), None
    near = F.array(*[F.lit(k) for k in (-1, 0, 1)])
    while True:
        t = F.lit(side)
        a = a0.withColumns({"_tx": F.floor(F.col("_ax") / t), "_ty": F.floor(F.col("_ay") / t)})
        cand = (pos.withColumn("_dx", F.explode(near)).withColumn("_dy", F.explode(near))
                .withColumns({"_tx": F.floor(F.col("_px") / t) + F.col("_dx"),
                              "_ty": F.floor(F.col("_py") / t) + F.col("_dy")}).drop("_dx", "_dy"))
        d2 = (F.col("_px") - F.col("_ax")) ** 2 + (F.col("_py") - F.col("_ay")) ** 2
        rank = F.struct(d2.alias("d"), F.col("_k").alias("k"))
        best = cand.join(a, ["_tx", "_ty"]).groupBy("_px", "_py").agg(F.min_by(rank, rank).alias("_b"))
        last = side > span
        ok = best.where(F.lit(last) | (F.sqrt(F.col("_b.d")) <= t))
        ok = ok.select("_px", "_py", F.col("_b.k").alias(out)).checkpoint()
        settled = ok if settled is None else settled.unionByName(ok)
        if last:
            break
        pos = pos.join(ok.select("_px", "_py"), ["_px", "_py"], "left_anti").checkpoint()
        if pos.isEmpty():
            break
        side *= 2
    cond = (points[px].eqNullSafe(settled["_px"])) & (points[py].eqNullSafe(settled["_py"]))
    return points.drop(*([out] if out in points.columns else [])).join(settled, cond, "left").drop("_px", "_py")
