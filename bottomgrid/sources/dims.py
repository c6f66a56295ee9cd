"""Dimension scans: the polygon grid (S6) and the bathymetry raster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import ring_is_closed
from ..operators.spatial import PackedRaster, pack_raster


def validate_grid(grid: DataFrame, id_col: str = "id", ring: str = "ring") -> DataFrame:
    """Lazy check: every ring must be closed (first point = last point) with
    at least three distinct corners; a bad row fails the job when it runs.
    Multi-part cells and holes have no representation in the schema."""
    bad = ~ring_is_closed(F.col(ring)) | F.col(ring).isNull()
    checked = F.when(bad, F.raise_error(F.concat(F.lit("grid cell with an open ring: id="),
                                                 F.col(id_col).cast("string"))))
    return grid.where(checked.isNull())


def read_grid(spark: SparkSession, path: str, check_unique: bool = False) -> DataFrame:
    """Cells as ``id, ring, stat_area, depth, centroid_lon, centroid_lat``
    in WGS84. ``check_unique`` runs one aggregate to refuse duplicate ids."""
    grid = spark.read.parquet(path).select(
        F.col("id").cast("bigint").alias("id"), "ring",
        F.col("stat_area").cast("bigint").alias("stat_area"),
        F.col("depth").cast("double").alias("depth"),
        F.col("centroid_lon").cast("double").alias("centroid_lon"),
        F.col("centroid_lat").cast("double").alias("centroid_lat"))
    grid = validate_grid(grid)
    if check_unique:
        dup = grid.groupBy("id").count().where(F.col("count") > 1).limit(1).count()
        if dup:
            raise ValueError("grid has duplicate cell ids")
    return grid


def read_raster(spark: SparkSession, path: str, packed_path: str | None = None) -> tuple[DataFrame, PackedRaster]:
    """A raster stored as a long table ``(lat_idx, lon_idx, lat, lon,
    elevation)``, and its packed form with the axes beside it
    (``packed_path``, by default in the shared checkpoint folder)."""
    r = spark.read.parquet(path).select(
        F.col("lat_idx").cast("bigint").alias("lat_idx"),
        F.col("lon_idx").cast("bigint").alias("lon_idx"),
        F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"),
        "elevation")
    return r, pack_raster(r, packed_path)
