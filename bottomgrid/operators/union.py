"""Set operations: union of feeds (U1), union with side-loads (U2) and
distinct positions (U3)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_feeds(frames: list[DataFrame]) -> DataFrame:
    """Union by column name; columns missing in a feed become NULL."""
    if not frames:
        raise ValueError("union_feeds needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_with_sideloads(gmgi: DataFrame | None, fleet: DataFrame | None,
                         gridded: DataFrame, order_col: str = "source_ord") -> DataFrame:
    """Side-loads first (gmgi, then study fleet), then the gridded feeds.
    The order is kept as an explicit ``source_ord`` column because "first" in
    the daily statistics depends on it; no physical order is relied on."""
    parts = []
    for i, f in enumerate((gmgi, fleet, gridded)):
        if f is not None:
            parts.append(f.withColumn(order_col, F.lit(i)))
    return union_feeds(parts)


def distinct_positions(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """One row per distinct position (partial aggregation map-side)."""
    return df.select(lat, lon).dropDuplicates([lat, lon])
