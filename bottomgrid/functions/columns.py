"""Projection and column helpers (P1, P2, P8–P12) and scan hygiene."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import COLUMN_ATTRS, DATASET_ATTRS, PRODUCT_TYPES, STANDARD_SCHEMA


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN -> NULL in every floating column: Spark's avg/max_by treat NaN as a
    value, the reference's pandas/polars code skips it."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def to_standard(df: DataFrame, schema: T.StructType = STANDARD_SCHEMA,
                keep: list[str] | None = None) -> DataFrame:
    """Project to the standard columns; an absent one becomes a typed NULL.
    ``keep`` lists extra columns to carry (e.g. a tie-break id)."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    # text such as "NaN" becomes NaN only in the cast above
    return nan_to_null(df.select(*cols, *[c for c in (keep or []) if c in df.columns]))


def empty_standard(spark, schema: T.StructType = STANDARD_SCHEMA) -> DataFrame:
    """The empty frame with the standard schema (unknown or failed feed)."""
    return spark.createDataFrame([], schema)


def tag(df: DataFrame, provider: str | None = None, flag: int | None = None,
        renames: dict[str, str] | None = None) -> DataFrame:
    """Renames plus the constant provider / fishery-dependent tags."""
    if renames:
        df = df.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns})
    if provider is not None:
        df = df.withColumn("data_provider", F.lit(provider))
    if flag is not None:
        df = df.withColumn("fishery_dependent", F.lit(int(flag)))
    return df


def scale(df: DataFrame, col: str, factor: float, out: str | None = None) -> DataFrame:
    """P10: unit conversion by a constant factor."""
    return df.withColumn(out or col, F.col(col) * F.lit(factor))


# fixed value: molar oxygen to mg/L factor used for the OOI stations
OXYGEN_MOLAR_TO_MGL = 0.0328


def _as_text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("nan"))


def profile_key(df: DataFrame, a: str, b: str, out: str = "profile_id") -> DataFrame:
    """Composite key ``a_b``; a missing part reads 'nan' like the source."""
    return df.withColumn(out, F.concat_ws("_", _as_text(F.col(a)), _as_text(F.col(b))))


def epoch_day(df: DataFrame, time: str = "time", out: str = "time",
              parts: bool = False) -> DataFrame:
    """Days since 1970-01-01 (and optionally year/month/day parts for
    the output layout). Works on dates and timestamps."""
    d = F.to_date(F.col(time))
    if parts:
        df = df.withColumns({"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d)})
    return df.withColumn(out, F.unix_date(d))


def narrow(df: DataFrame, type_map: dict | None = None) -> DataFrame:
    """Narrow the product types. ``try_cast`` turns a value that does not
    fit into NULL instead of failing the job; columns not in the map stay."""
    type_map = type_map or PRODUCT_TYPES
    out = []
    for f in df.schema.fields:
        t = type_map.get(f.name)
        out.append(F.col(f.name).try_cast(t).alias(f.name) if t is not None else F.col(f.name))
    return df.select(*out)


def with_metadata(df: DataFrame, attrs: dict | None = None) -> DataFrame:
    """Attach units / names / comments as column metadata (kept in the
    Parquet schema)."""
    attrs = attrs or COLUMN_ATTRS
    return df.select(*[F.col(c).alias(c, metadata=attrs[c]) if c in attrs else F.col(c)
                       for c in df.columns])


def dataset_attributes(spark, version: str, attrs: dict | None = None) -> DataFrame:
    """P9 (dataset level): title, description, institution and version as a
    one-row side table written next to the product."""
    row = dict(DATASET_ATTRS if attrs is None else attrs, version=version)
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row))
