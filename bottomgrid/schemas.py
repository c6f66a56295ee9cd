"""Schemas, type maps and column descriptions of the engine's tables."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: the standard observation columns, in order ---------------
STANDARD_SCHEMA = T.StructType([
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("salinity", T.DoubleType()),
    T.StructField("dissolved_oxygen", T.DoubleType()),
    T.StructField("data_provider", T.StringType()),
    T.StructField("fishery_dependent", T.IntegerType()),
])

# Measures the daily product summarises, in product order.
MEASURES = ["temperature", "dissolved_oxygen", "salinity"]

# --- fixed values: hand-off columns (step 1 -> step 2) ----------------------
STAGED_REQUIRED = ["time", "latitude", "longitude", "temperature",
                   "data_provider", "fishery_dependent", "id", "stat_area"]
STAGED_OPTIONAL = ["dissolved_oxygen", "salinity", "depth"]
STAGED_TYPES = {
    "time": T.TimestampNTZType(),
    "latitude": T.DoubleType(),
    "longitude": T.DoubleType(),
    "temperature": T.DoubleType(),
    "data_provider": T.StringType(),
    "fishery_dependent": T.LongType(),
    "id": T.LongType(),
    "stat_area": T.LongType(),
    "dissolved_oxygen": T.DoubleType(),
    "salinity": T.DoubleType(),
    "depth": T.DoubleType(),
}

# --- fixed values: narrowed product types ------------------------------------
# float32 -> FloatType; uint32 -> LongType (Spark has no unsigned types, and a
# uint32 does not fit IntegerType); uint8 -> ShortType; the provider list stays
# a whole string instead of a 32-byte cut.
PRODUCT_TYPES = {
    "temperature": T.FloatType(),
    "temperature_std": T.FloatType(),
    "temperature_min": T.FloatType(),
    "temperature_max": T.FloatType(),
    "temperature_count": T.LongType(),
    "dissolved_oxygen": T.FloatType(),
    "dissolved_oxygen_std": T.FloatType(),
    "dissolved_oxygen_min": T.FloatType(),
    "dissolved_oxygen_max": T.FloatType(),
    "dissolved_oxygen_count": T.LongType(),
    "salinity": T.FloatType(),
    "salinity_std": T.FloatType(),
    "salinity_min": T.FloatType(),
    "salinity_max": T.FloatType(),
    "salinity_count": T.LongType(),
    "depth": T.LongType(),
    "latitude": T.FloatType(),
    "longitude": T.FloatType(),
    "time": T.LongType(),
    "stat_area": T.LongType(),
    "grid_id": T.LongType(),
    "data_provider": T.StringType(),
    "fishery_dependent": T.ShortType(),
}

# --- fixed values: product column units and names ----------------------------
_UNITS = {
    "temperature": "degrees_Celsius",
    "dissolved_oxygen": "miligrams_per_liter",
    "salinity": "g/kg",
}
_LONG = {"temperature": "temperature", "dissolved_oxygen": "dissolved_oxygen",
         "salinity": "salinity"}


def _measure_attrs() -> dict:
    out = {}
    for m, unit in _UNITS.items():
        bare = {"units": unit, "long_name": f"daily_mean_bottom_{_LONG[m]}",
                "comment": f"Daily mean of bottom {m.replace('_', ' ')} in the cell"}
        if m == "temperature":
            bare["standard_name"] = "sea_water_temperature"
        out[m] = bare
        out[f"{m}_std"] = {"units": unit, "long_name": f"{m}_standard_deviation",
                           "comment": f"Daily sample standard deviation of {m.replace('_', ' ')}"}
        out[f"{m}_min"] = {"units": unit, "long_name": f"{m}_minimum",
                           "comment": f"Daily minimum of {m.replace('_', ' ')}"}
        out[f"{m}_max"] = {"units": unit, "long_name": f"{m}_maximum",
                           "comment": f"Daily maximum of {m.replace('_', ' ')}"}
        out[f"{m}_count"] = {"units": "", "long_name": f"{m}_observation_count",
                             "comment": f"Number of standardized rows with a {m.replace('_', ' ')} value"}
    return out


COLUMN_ATTRS = {
    **_measure_attrs(),
    "latitude": {"units": "degrees_north", "standard_name": "latitude", "axis": "Y",
                 "comment": "Centroid of the grid cell"},
    "longitude": {"units": "degrees_east", "standard_name": "longitude", "axis": "X",
                  "comment": "Centroid of the grid cell"},
    "time": {"standard_name": "time", "axis": "T",
             "units": "days since 1970-01-01T00:00:00 UTC",
             "comment": "Days since the Unix epoch (UTC)"},
    "depth": {"units": "meters", "standard_name": "depth", "long_name": "inferred_depth",
              "comment": "Depth of the grid cell from bathymetry"},
    "stat_area": {"units": "", "long_name": "statistical_area",
                  "comment": "Statistical area of the grid cell"},
    "data_provider": {"units": "", "long_name": "data_provider",
                      "comment": "Providers contributing to the cell-day, sorted, comma separated"},
    "grid_id": {"units": "", "long_name": "grid_cell_identifier",
                "comment": "Identifier of the grid cell"},
    "fishery_dependent": {"units": "", "long_name": "Fishery (In)Dependent Flag",
                          "comment": "1 = fishery dependent, 0 = independent collection"},
}

# Dataset-level attributes of the product; a deployment sets its own.
DATASET_ATTRS = {
    "title": "Daily gridded bottom observations",
    "description": "Daily per-cell statistics of bottom temperature, dissolved oxygen and salinity.",
    "institution": "",
}

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("dataset_id", T.StringType()),
    T.StructField("observation_count", T.LongType()),
    T.StructField("post_filter_count", T.LongType()),
    T.StructField("runtime", T.TimestampNTZType()),
    T.StructField("version", T.StringType()),
    T.StructField("data_provider", T.StringType()),
    T.StructField("file_protocol", T.StringType()),
    T.StructField("reload_type", T.StringType()),
    T.StructField("fetch_erddap_success", T.IntegerType()),
    T.StructField("execution_time_seconds", T.DoubleType()),
    T.StructField("doi", T.StringType()),
])

ARCHIVE_SCHEMA = T.StructType([
    T.StructField("archive_s3_key", T.StringType()),
    T.StructField("archive_public_url", T.StringType()),
    T.StructField("archive_date", T.TimestampNTZType()),
    T.StructField("version", T.StringType()),
    T.StructField("doi", T.StringType()),
    T.StructField("citation_url", T.StringType()),
    T.StructField("reload_type", T.StringType()),
    T.StructField("file_size_mb", T.DoubleType()),
])

DIAG_SCHEMA = T.StructType([
    T.StructField("runtime", T.TimestampNTZType()),
    T.StructField("program", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("total_execution_seconds", T.DoubleType()),
    T.StructField("phase_durations", T.StringType()),
    T.StructField("nc_files_created", T.IntegerType()),
])
