"""Feed standardizers (C1–C10): each is a chain of library operators that
turns one feed into the standard observation columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import OXYGEN_MOLAR_TO_MGL, empty_standard, profile_key, scale, tag, to_standard
from ..operators.lookup import map_default
from ..operators.qc import (SEAFLOOR_THRESHOLD, drop_outliers, min_group_size, missing_or_positive, positive,
                            running_median, seabed_check)
from ..operators.reduce import deepest, hourly_by_station, hourly_mean
from ..operators.spatial import PackedRaster, attach_cell, nearest_raster


@dataclass
class Dims:
    """Dimension tables a standardizer may need."""
    grid: DataFrame | None = None
    grid_rows: int | None = None
    raster: DataFrame | PackedRaster | None = None
    seabed_threshold: float = SEAFLOOR_THRESHOLD


def _finish(df: DataFrame, keep: list[str] | None) -> DataFrame:
    return to_standard(df, keep=keep)


def std_emolt_rt(df: DataFrame, dims: Dims, tie: str | None = None,
                 keep: list[str] | None = None) -> DataFrame:
    """Hourly mean per tow -> seabed depth -> seabed check -> tags."""
    h = hourly_mean(df, "tow_id", ["latitude", "longitude", "temperature", "depth"])
    h = nearest_raster(h, dims.raster)
    h = seabed_check(h, "depth", threshold=dims.seabed_threshold)
    return _finish(tag(h, "eMOLT", 1), keep)


def std_emolt_lowell(df: DataFrame, dims: Dims, tie: str | None = None,
                     keep: list[str] | None = None) -> DataFrame:
    """DO > 0 -> 3-sigma per tow -> tows of >= 10 rows -> 5-point running
    median of DO -> hourly mean per tow -> DO > 0 -> tags (no seabed check)."""
    d = positive(df, "DO")
    d = drop_outliers(d, "tow_id", "DO")
    d = min_group_size(d, "tow_id", 10)
    order = ["time"] + ([tie] if tie else [])
    d = running_median(d, "tow_id", order, "DO", out="DO_filtered")
    h = hourly_mean(d, "tow_id", ["latitude", "longitude", "temperature", "DO_filtered"])
    h = positive(h.withColumnRenamed("DO_filtered", "dissolved_oxygen"), "dissolved_oxygen")
    return _finish(tag(h, "eMOLT", 1), keep)


def std_profiles(flag: int) -> Callable:
    def run(df: DataFrame, dims: Dims, tie: str | None = None,
            keep: list[str] | None = None) -> DataFrame:
        """Deepest bin per profile -> seabed depth -> seabed check on
        pressure -> renames -> tags (CFRF; shelf fleet 1, wind farm 0)."""
        d = deepest(df, "profile_id", "sea_pressure", tie)
        d = seabed_check(nearest_raster(d, dims.raster), "sea_pressure", threshold=dims.seabed_threshold)
        d = tag(d, "CFRF", flag, {"conservative_temperature": "temperature",
                                  "absolute_salinity": "salinity"})
        return _finish(d, keep)
    return run


def std_fixed_gear(df: DataFrame, dims: Dims, tie: str | None = None,
                   keep: list[str] | None = None) -> DataFrame:
    """C4: 3-sigma oxygen outliers per tow removed (NULL oxygen and rows
    without a tow kept) -> tags."""
    return _finish(tag(drop_outliers(df, "tow_id", "dissolved_oxygen"), "CFRF", 1), keep)


def std_receivers(df: DataFrame, dims: Dims, tie: str | None = None,
                  keep: list[str] | None = None) -> DataFrame:
    """Tags only."""
    return _finish(tag(df, "CFRF", 0), keep)


def std_oleander(df: DataFrame, dims: Dims, tie: str | None = None,
                 keep: list[str] | None = None) -> DataFrame:
    """Rename -> profile key (cruise, profile) -> deepest -> seabed depth
    -> seabed check -> tags."""
    d = profile_key(tag(df, renames={"temp": "temperature"}), "cruise_num", "profile_number")
    d = deepest(d, "profile_id", "depth", tie)
    d = seabed_check(nearest_raster(d, dims.raster), "depth", threshold=dims.seabed_threshold)
    return _finish(tag(d, "Oleander", 0), keep)


def std_ecomon(df: DataFrame, dims: Dims, tie: str | None = None,
               keep: list[str] | None = None) -> DataFrame:
    """Renames -> profile key (cruise, cast) -> oxygen missing or > 0 ->
    deepest by pressure -> seabed depth -> seabed check -> tags."""
    d = tag(df, renames={"sea_water_temperature": "temperature",
                         "sea_water_salinity": "salinity", "pressure_dbars": "sea_pressure"})
    d = missing_or_positive(profile_key(d, "cruise_id", "cast_number"), "dissolved_oxygen")
    d = deepest(d, "profile_id", "sea_pressure", tie)
    d = seabed_check(nearest_raster(d, dims.raster), "sea_pressure", threshold=dims.seabed_threshold)
    return _finish(tag(d, "ECOMON", 0), keep)


OOI_OXYGEN = "mole_concentration_of_dissolved_molecular_oxygen_in_sea_water"


def std_ooi(df: DataFrame, dims: Dims, tie: str | None = None,
            keep: list[str] | None = None, station: str = "dataset_id") -> DataFrame:
    """Molar oxygen -> mg/L -> renames -> hourly mean per station -> tags."""
    d = scale(df, OOI_OXYGEN, OXYGEN_MOLAR_TO_MGL, "dissolved_oxygen").drop(OOI_OXYGEN)
    d = tag(d, renames={"sea_water_temperature": "temperature",
                        "sea_water_practical_salinity": "salinity"})
    if station not in d.columns:
        d = d.withColumn(station, F.lit("ooi"))
    h = hourly_by_station(d, station, measures=["latitude", "longitude", "temperature",
                                                "salinity", "dissolved_oxygen"])
    return _finish(tag(h, "OOI", 0), (keep or []) + [station])


def std_gliders(df: DataFrame, dims: Dims, tie: str | None = None,
                keep: list[str] | None = None, mapping=None) -> DataFrame:
    """Institution -> provider code (default glider_other) -> oxygen
    missing or > 0 -> cell attributes by grid id -> flag 0."""
    d = map_default(df, "institution", mapping)
    d = missing_or_positive(d, "dissolved_oxygen").drop("institution")
    d = attach_cell(d, dims.grid, id_col="grid_id", grid_rows=dims.grid_rows)
    return _finish(tag(d, flag=0), keep)


STANDARDIZERS: dict[str, Callable] = {
    "eMOLT_RT": std_emolt_rt,
    "eMOLT_RT_LOWELL": std_emolt_lowell,
    "shelf_fleet_profiles_1m_binned": std_profiles(1),
    "wind_farm_profiles_1m_binned": std_profiles(0),
    "fixed_gear_oceanography": std_fixed_gear,
    "wind_farm_acoustic_receivers": std_receivers,
    "oleanderXbt": std_oleander,
    "ocdbs_v_erddap1": std_ecomon,
    "demersal_gliders_aggregated": std_gliders,
}


def known_feed(feed_id: str) -> bool:
    return feed_id.startswith("ooi-") or feed_id in STANDARDIZERS


def standardize(feed_id: str, df: DataFrame, dims: Dims, **kw) -> DataFrame:
    """Dispatch by feed id; ``ooi-*`` share one chain; an unknown feed gives
    the empty standard frame (C10)."""
    if feed_id.startswith("ooi-"):
        return std_ooi(df.withColumn("dataset_id", F.lit(feed_id)), dims, **kw)
    fn = STANDARDIZERS.get(feed_id)
    if fn is None:
        return empty_standard(df.sparkSession)
    return fn(df, dims, **kw)
