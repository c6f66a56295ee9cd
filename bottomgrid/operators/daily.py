"""Daily per-cell statistics (A4, A5, A6) and merging of partial daily
statistics (A7).

Each is one hash aggregation keyed on (day, cell): Spark computes partial
aggregates map-side (sum, count, min, max, the running M2 of ``stddev_samp``
and the small provider set), so a hot cell-day costs one partial row per map
task and never a whole group in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import MEASURES

# fixed shifts for pooled sums: typical values, any constant is right
TYPICAL = {"temperature": 10.0, "dissolved_oxygen": 8.0, "salinity": 33.0}

META = ["latitude", "longitude", "stat_area", "depth"]


def _present(df: DataFrame, measures) -> list[str]:
    return [m for m in (measures or MEASURES) if m in df.columns]


def _order_struct(order: list[str]) -> Column:
    return F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])


def _first(col: str, order: list[str], ignore_nulls: bool) -> Column:
    key = _order_struct(order)
    if ignore_nulls:
        key = F.when(F.col(col).isNotNull(), key)
    return F.min_by(F.col(col), key)


def _providers(col: Column, sep: str) -> Column:
    s = F.array_sort(col)
    return F.when(F.size(s) > 0, F.array_join(s, sep))


def measure_stats(m: str) -> list[Column]:
    return [F.avg(m).alias(m), F.min(m).alias(f"{m}_min"), F.max(m).alias(f"{m}_max"),
            F.stddev_samp(m).alias(f"{m}_std"), F.count(m).alias(f"{m}_count")]


def daily_cell(df: DataFrame, measures: list[str] | None = None,
               order: list[str] | None = None, id_col: str = "id",
               provider_sep: str = ", ", first_ignore_nulls: bool = False,
               providers_first_seen: bool = False, by: list[str] | None = None,
               keep_first_key: bool = False) -> DataFrame:
    """A4 (and A5 with ``provider_sep=' '``, ``first_ignore_nulls=True``,
    ``providers_first_seen=True``): one row per (day, cell).

    mean / min / max / sample std / non-null count of each measure present;
    the distinct providers joined (sorted, or in first-seen order); position,
    area, depth and fishery flag of the earliest row by ``order``. ``by``
    adds grouping keys (e.g. the feed, to build mergeable partials for A7);
    ``keep_first_key`` keeps that earliest order key as ``_first`` so that
    partials merge their "first" columns exactly.
    """
    order = order or ["time"]
    by = list(by or [])
    ms = _present(df, measures)
    # rows without a cell or a time have no (day, cell) group
    base = (df.where(F.col(id_col).isNotNull() & F.col("time").isNotNull())
              .withColumn("_day", F.to_date("time")))
    aggs = []
    firsts = [c for c in ("latitude", "longitude", "fishery_dependent", "stat_area", "depth") if c in base.columns]
    if first_ignore_nulls:      # each column from its own earliest row
        aggs += [_first(c, order, True).alias(c) for c in firsts]
    elif firsts:                # all from one row: one ordering for all of them
        aggs.append(F.min_by(F.struct(*firsts), _order_struct(order)).alias("_row"))
    for m in ms:
        aggs.extend(measure_stats(m))
    if keep_first_key:
        aggs.append(F.min(_order_struct(order)).alias("_first"))
    if not providers_first_seen:
        aggs.append(_providers(F.collect_set("data_provider"), provider_sep).alias("data_provider"))
    out = base.groupBy("_day", F.col(id_col).alias("grid_id"), *by).agg(*aggs)
    if "_row" in out.columns:
        rest = [c for c in out.columns if c not in ("_day", "grid_id", *by, "_row")]
        out = out.select("_day", "grid_id", *by, *[F.col(f"_row.{c}").alias(c) for c in firsts], *rest)
    if providers_first_seen:
        # Pre-aggregate to one row per (day, cell, provider) first, so the
        # list built per cell-day holds at most one entry per provider.
        seen = (base.where(F.col("data_provider").isNotNull())
                  .groupBy("_day", F.col(id_col).alias("grid_id"), *by, "data_provider")
                  .agg(F.min(_order_struct(order)).alias("_o")))
        plist = (seen.groupBy("_day", "grid_id", *by)
                 .agg(F.array_sort(F.collect_list(F.struct("_o", "data_provider"))).alias("_p"))
                 .select("_day", "grid_id", *by,
                         F.array_join(F.transform("_p", lambda s: s["data_provider"]), provider_sep)
                         .alias("data_provider")))
        out = out.join(plist, ["_day", "grid_id", *by], "left")
    return out.withColumnRenamed("_day", "time")


def daily_cell_precounted(df: DataFrame, measures: list[str] | None = None,
                          order: list[str] | None = None, id_col: str = "id",
                          provider_sep: str = ", ") -> DataFrame:
    """Daily statistics of rows that are already counts of something
    (e.g. hourly means with ``<m>_count``): mean/min/max/std over the rows,
    unweighted, and the **sum** of each count column. No fishery flag."""
    order = order or ["time"]
    ms = _present(df, measures)
    base = (df.where(F.col(id_col).isNotNull() & F.col("time").isNotNull())
              .withColumn("_day", F.to_date("time")))
    aggs = [_first(c, order, True).alias(c) for c in META if c in base.columns]
    for m in ms:
        aggs += [F.avg(m).alias(m), F.min(m).alias(f"{m}_min"), F.max(m).alias(f"{m}_max"),
                 F.stddev_samp(m).alias(f"{m}_std")]
        if f"{m}_count" in base.columns:
            aggs.append(F.sum(f"{m}_count").cast("bigint").alias(f"{m}_count"))
    aggs.append(_providers(F.collect_set("data_provider"), provider_sep).alias("data_provider"))
    return (base.groupBy("_day", F.col(id_col).alias("grid_id")).agg(*aggs)
            .withColumnRenamed("_day", "time"))


def merge_daily(df: DataFrame, measures: list[str] | None = None,
                keys: tuple[str, str] = ("time", "grid_id"), sort: bool = False,
                provider_sep: str = ", ", first_key: str | None = None) -> DataFrame:
    """Merge partial daily statistics of the same (day, cell).

    count-weighted mean, min of mins, max of maxes, summed counts and the
    pooled sample standard deviation, in one aggregation. The pooled M2 is
    ``sum((n_i - 1) s_i^2) + sum(n_i d_i^2) - sum(n_i d_i)^2 / N`` with
    ``d_i = m_i - c``: it does not depend on the fixed shift ``c``, which only
    keeps the sums small (a typical value of the measure). The std is NULL
    when the merged count is at most 1; a zero total count gives a NULL mean.
    Metadata: first non-null by value; with ``first_key`` (the earliest order
    key each partial kept), position, area, depth and the fishery flag come
    from the partial whose first row is earliest, so merged partials equal the
    statistics of all rows. ``sort`` orders the result by the keys.
    """
    ms = _present(df, measures)
    base = df
    if first_key and first_key in df.columns:
        carried = [c for c in META + ["fishery_dependent"] if c in df.columns]
        aggs = [F.min_by(F.struct(*carried), F.col(first_key)).alias("_row"), F.min(first_key).alias(first_key)]
    else:
        aggs = [F.min(c).alias(c) for c in META if c in df.columns]
    for m in ms:
        n, mean, std = F.col(f"{m}_count"), F.col(m), F.col(f"{m}_std")
        d = mean - F.lit(TYPICAL.get(m, 0.0))
        aggs += [
            F.sum(d * n).alias(f"_ws_{m}"),
            F.sum(F.when(mean.isNotNull(), n)).alias(f"_wn_{m}"),
            F.sum(n).cast("bigint").alias(f"{m}_count"),
            F.min(f"{m}_min").alias(f"{m}_min"),
            F.max(f"{m}_max").alias(f"{m}_max"),
            F.coalesce(F.sum((n - 1) * std * std), F.lit(0.0)).alias(f"_v1_{m}"),
            F.coalesce(F.sum(n * d * d), F.lit(0.0)).alias(f"_v2_{m}"),
        ]
    parts = F.flatten(F.collect_set(F.split(F.col("data_provider"), F.lit(provider_sep))))
    aggs.append(_providers(F.array_distinct(parts), provider_sep).alias("data_provider"))
    out = base.groupBy(*keys).agg(*aggs)
    if "_row" in out.columns:
        out = out.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in carried],
                         *[c for c in out.columns if c not in (*keys, "_row")])
    for m in ms:
        n = F.col(f"{m}_count")
        shift = F.try_divide(F.col(f"_ws_{m}"), F.col(f"_wn_{m}"))
        between = F.col(f"_v2_{m}") - F.coalesce(F.col(f"_ws_{m}") * shift, F.lit(0.0))
        var = F.try_divide(F.col(f"_v1_{m}") + F.greatest(between, F.lit(0.0)), n - 1)
        out = (out.withColumn(m, F.lit(TYPICAL.get(m, 0.0)) + shift)
                  .withColumn(f"{m}_std", F.when(n > 1, F.sqrt(F.greatest(var, F.lit(0.0))))))
    out = out.drop(*[c for c in out.columns if c.startswith("_") and c != first_key])
    return out.orderBy(*keys) if sort else out
