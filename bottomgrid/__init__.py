"""bottomgrid: daily gridded bottom-observation statistics on Spark.

The most used entry points, re-exported; every operator lives in its module
(see README.md for the full map).
"""

from .functions.calendar import refresh_window
from .operators.daily import daily_cell, daily_cell_precounted, merge_daily
from .operators.qc import drop_outliers, gross_range, min_group_size, running_median, seabed_check
from .operators.reduce import deepest, hourly_mean
from .operators.spatial import assign_grid, nearest_centroid, nearest_raster, within_cells
from .plans.runs import run_step1, run_step2
from .plans.standardize import Dims, standardize
from .session import build_session
from .streaming.publish_stream import publish_stream, refresh

__all__ = [
    "Dims", "assign_grid", "build_session", "daily_cell", "daily_cell_precounted", "deepest",
    "drop_outliers", "gross_range", "hourly_mean", "merge_daily", "min_group_size",
    "nearest_centroid", "nearest_raster", "publish_stream", "refresh", "refresh_window",
    "run_step1", "run_step2", "running_median", "seabed_check", "standardize", "within_cells",
]
