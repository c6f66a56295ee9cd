"""Lookup through a small fixed map with a default."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sizing import broadcast_if_small

# --- fixed values: glider institution -> provider code, and the default ----
INSTITUTION_DEFAULT = "glider_other"
INSTITUTION_CODES = {
    "Graduate School of Oceanography, University of Rhode Island": "glider_URI",
    "Woods Hole Oceanographic Institution": "glider_WHOI",
    "University of Massachusetts Darmouth": "glider_UMass",
    "University of Massachusetts Dartmouth": "glider_UMass",
    "University of Massachussetts Dartmouth, Rutgers University": "glider_UMass",
    "Virginia Institute of Marine Science - William & Mary": "glider_VIMS",
    "Virginia Institute of Marine Science – William & Mary": "glider_VIMS",
    "Virginia Institute of Marine Science": "glider_VIMS",
    "University of Maryland": "glider_UMD",
    "University of Delaware College of Earth Ocean and Environment": "glider_UDel",
    "University of South Florida College of Marine Science Ocean Technology Group": "glider_USF",
    "University of Maine,Rutgers University": "glider_UMaine",
    "University of Maine": "glider_UMaine",
    "University of Massachusetts Dartmouth,Rutgers University": "glider_UMass",
    "Virginia Institute of Marine Science - The College of William & Mary": "glider_VIMS",
    "Helmholtz-Zentrum hereon": "glider_HZ",
    "Integrated Ocean Observing System,Naval Oceanographic Office,Rutgers University,"
    "National Oceanic and Atmospheric Administration,Mid-Atlantic Regional Association "
    "of Coastal Ocean Observing Systems,Rutgers University": "glider_IOOS",
    "Naval Oceanographic Office": "glider_Navy",
    "NAVOCEANO,Rutgers University": "glider_NAVOCEANO",
    "NAVOCEANO,University of Delaware": "glider_NAVOCEANO",
    "NAVOCEANO,William & Mary Virginia Institute of Marine Science": "glider_NAVOCEANO",
    "OOI Coastal & Global Scale Nodes (CGSN)": "glider_OOI",
    "Rutgers University": "glider_RU",
    "Rutgers University,Virginia Institute of Marine Science": "glider_RU",
    "Skidaway Institute of Oceanography": "glider_UGA",
    "Stony Brook University": "glider_SBU",
    "Stony Brook University School of Marine & Atmospheric Sciences": "glider_SBU",
    "Stony Brook University,Rutgers University": "glider_SBU",
    "Teledyne Webb Research Corporation": "glider_RU",
    "Teledyne Webb Research, Rutgers University, PLOCAN": "glider_RU",
    "UNC Marine Sciences": "glider_UNC",
    "University of Connecticut": "glider_UConn",
    "University of Delaware": "glider_UDel",
}


def mapping_frame(spark: SparkSession, mapping: dict[str, str]) -> DataFrame:
    return spark.createDataFrame(sorted(mapping.items()), "_key string, _code string")


def map_default(df: DataFrame, col: str, mapping: dict[str, str] | DataFrame | None = None,
                default: str = INSTITUTION_DEFAULT, out: str = "data_provider",
                broadcast_limit: int | None = None) -> DataFrame:
    """``out = mapping[col]``, or ``default`` when the key is absent or NULL.

    The map is a small fixed table (33 rows for gliders), broadcast in a left
    join after its row count is known, so the big side is never shuffled; a
    map too large to broadcast is joined by shuffle instead."""
    if mapping is None:
        mapping = INSTITUTION_CODES
    if isinstance(mapping, DataFrame):
        table = mapping.select(F.col(mapping.columns[0]).alias("_key"),
                               F.col(mapping.columns[1]).alias("_code"))
        rows = table.count()
    else:
        table, rows = mapping_frame(df.sparkSession, mapping), len(mapping)
    table, _ = broadcast_if_small(table, rows, 160, broadcast_limit)
    joined = df.join(table, df[col] == table["_key"], "left")
    return (joined.withColumn(out, F.coalesce(F.col("_code"), F.lit(default)))
                  .drop("_key", "_code"))
