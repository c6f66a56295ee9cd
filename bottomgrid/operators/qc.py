"""Quality control: row filters (P3–P6), per-group outlier and size rules
(W1, W2), the running median (W3) and the seabed retention curve (A9).

Per-group rules are written so that a group holding a large share of all
rows never has to sit in one task: group statistics are partial aggregates
joined back (AQE splits a hot key on the row side), and the running median
sends groups above a size bound through a globally range-sorted copy with
five-row neighbour groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .sizing import broadcast_if_small

# fixed value: default seabed threshold in metres
SEAFLOOR_THRESHOLD = 20.0


def seabed_check(df: DataFrame, depth_col: str, inferred: str = "inferred_depth",
                 threshold: float = SEAFLOOR_THRESHOLD) -> DataFrame:
    """Keep rows whose observed depth is known, whose seabed depth is
    known, and with ``observed - seabed < threshold`` (one-sided)."""
    d, s = F.col(depth_col), F.col(inferred)
    return df.where(d.isNotNull() & s.isNotNull() & ((d - s) < F.lit(threshold)))


def missing_or_positive(df: DataFrame, col: str) -> DataFrame:
    """Keep rows where the value is missing or > 0."""
    return df.where(F.col(col).isNull() | (F.col(col) > 0))


def positive(df: DataFrame, col: str) -> DataFrame:
    """P5: keep rows where the value is > 0 (missing fails)."""
    return df.where(F.col(col) > 0)


def gross_range(df: DataFrame, depth: str = "depth", temperature: str = "temperature",
                depth_range=(1, 900), temp_range=(0, 27)) -> DataFrame:
    """Strict gross-range test on the product; missing fails."""
    d, t = F.col(depth), F.col(temperature)
    return df.where((d > depth_range[0]) & (d < depth_range[1])
                    & (t > temp_range[0]) & (t < temp_range[1]))


def _group_stats(df: DataFrame, group: str, aggs: list[Column],
                 broadcast_limit: int | None = None) -> DataFrame:
    """Partial-aggregated statistics per group, joined back to every row.

    The statistics pass reads only the group and value columns. They are
    checkpointed and counted: few groups are broadcast back, so rows are not
    shuffled at all; with many groups the join shuffles both sides, and as no
    aggregate stands between the shuffle and the join, AQE can split a hot
    group on the row side. A window over the group would instead shuffle
    every row and hold a whole group in one task."""
    checkpoint_dir(df.sparkSession)
    stats = df.where(F.col(group).isNotNull()).groupBy(group).agg(*aggs).checkpoint()
    stats, _ = broadcast_if_small(stats, stats.count(), limit=broadcast_limit)
    return df.join(stats, group, "left")


def drop_outliers(df: DataFrame, group: str, col: str, k: float = 3.0,
                  broadcast_limit: int | None = None) -> DataFrame:
    """Drop rows with ``|x - mean| > k * std`` within their group (sample
    std). Missing values, one-row groups and rows without a group are kept."""
    joined = _group_stats(df, group, [F.avg(col).alias("_mu"), F.stddev_samp(col).alias("_sd")], broadcast_limit)
    flag = (F.col(group).isNotNull()
            & F.coalesce(F.abs(F.col(col) - F.col("_mu")) > F.lit(k) * F.col("_sd"), F.lit(False)))
    return joined.where(~flag).drop("_mu", "_sd")


def min_group_size(df: DataFrame, group: str, n: int = 10,
                   broadcast_limit: int | None = None) -> DataFrame:
    """Keep rows of groups with at least ``n`` rows; no group fails."""
    joined = _group_stats(df, group, [F.count(F.lit(1)).alias("_n")], broadcast_limit)
    return joined.where(F.col(group).isNotNull() & (F.col("_n") >= n)).drop("_n")


# Groups above this many rows take the range-sorted path of the running
# median; smaller ones use a per-group window (one task per group).
MAX_WINDOW_GROUP_ROWS = 1_000_000


def _pad_median(values: Column, width: int) -> Column:
    padded = F.concat(values, F.array_repeat(F.lit(0.0), F.lit(width) - F.size(values)))
    return F.sort_array(padded)[width // 2]


def _median_by_window(df: DataFrame, group: str, order: list[str], col: str, out: str,
                      width: int) -> DataFrame:
    """Per-group sliding window of ``width`` rows (for groups of bounded size)."""
    half = width // 2
    w = Window.partitionBy(group).orderBy(*order).rowsBetween(-half, half)
    med = _pad_median(F.col("_nbv"), width)
    return (df.withColumn("_nbv", F.collect_list(F.col(col)).over(w))
              .withColumn(out, med)
              .drop("_nbv"))


def _median_by_position(df: DataFrame, group: str, order: list[str], col: str, out: str,
                        width: int) -> DataFrame:
    """Range-sorted path for groups of any size: one global sort spreads a
    huge group over many tasks; the sorted copy is checkpointed so the row
    positions are stable; a count per partition gives every row a
    consecutive position; every row is copied to the ``width`` positions it
    is a neighbour of, and a group-by on the position collects at most
    ``width`` values."""
    half = width // 2
    spark = df.sparkSession
    checkpoint_dir(spark)
    sort_keys = [F.col(group).asc_nulls_first()] + [F.col(c).asc_nulls_first() for c in order]
    s = df.orderBy(*sort_keys).withColumn("_mid", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright(F.col("_mid"), 33)
    counts = s.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n")).orderBy("_p").collect()
    offsets, acc = [], 0
    for r in counts:
        offsets.append((int(r["_p"]), acc))
        acc += int(r["_n"])
    off_df = spark.createDataFrame(offsets or [(0, 0)], "_p long, _off long")
    off_df, _ = broadcast_if_small(off_df, len(offsets), 16)
    pos = (s.withColumn("_p", part).join(off_df, "_p")
            .withColumn("_g", F.col("_off") + F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("_p", "_off", "_mid"))
    row_cols = [c for c in pos.columns if c != "_g"]
    copies = (pos.withColumn("_k", F.explode(F.sequence(F.lit(-half), F.lit(half))))
                 .withColumn("_c", F.col("_g") - F.col("_k")))
    nb = copies.groupBy("_c").agg(
        F.collect_list(F.struct(F.col(group).alias("g"), F.col(col).alias("v"))).alias("_nb"),
        F.max(F.when(F.col("_k") == 0, F.struct(*[F.col(c) for c in row_cols]))).alias("_row"))
    nb = nb.where(F.col("_row").isNotNull())
    me = F.col("_row")[group]
    same = F.transform(F.filter("_nb", lambda e: e["g"] == me), lambda e: e["v"])
    return nb.select(*[F.col("_row")[c].alias(c) for c in row_cols if c != out],
                     _pad_median(same, width).alias(out))


def running_median(df: DataFrame, group: str, order: list[str], col: str,
                   out: str | None = None, width: int = 5,
                   max_group_rows: int | None = None) -> DataFrame:
    """``width``-point running median of ``col`` along ``order`` within
    each group, zero-padded at both ends of the group (a group shorter than
    the window is padded too). Missing values and rows without a group are no
    part of a series: they are taken out first and get NULL, whatever the
    size of the group.

    Hot groups are split off: one partial aggregate counts the rows of every
    group, and only groups above ``max_group_rows`` take the range-sorted
    path that spreads one group over many tasks (both paths give the same
    values). Which groups are hot stays a table and is joined. All other
    groups use a per-group sliding window, where a task holds at most
    ``max_group_rows`` rows of one group."""
    out = out or col
    limit = MAX_WINDOW_GROUP_ROWS if max_group_rows is None else max_group_rows
    member = F.col(group).isNotNull() & F.col(col).isNotNull()
    series = df.where(member)
    rest = df.where(~member).withColumn(out, F.lit(None).cast("double"))
    counts = series.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    if (counts.agg(F.max("_n")).first()[0] or 0) <= limit:      # nothing is hot: no table, no join
        return _median_by_window(series, group, order, col, out, width).unionByName(rest)
    checkpoint_dir(df.sparkSession)
    hot = counts.where(F.col("_n") > limit).select(group).checkpoint()
    n_hot = hot.count()
    hot, _ = broadcast_if_small(hot, n_hot)
    cold = _median_by_window(series.join(hot, group, "left_anti"), group, order, col, out, width)
    by_pos = _median_by_position(series.join(hot, group, "left_semi"), group, order, col, out, width)
    return cold.unionByName(by_pos).unionByName(rest)


# fixed values: the thresholds of the published retention table
RETENTION_THRESHOLDS = tuple(range(1, 501))


def retention_curve(df: DataFrame, diff_col: str,
                    thresholds: list[float] | tuple[float, ...] = RETENTION_THRESHOLDS) -> DataFrame:
    """For each threshold, the number and percent of rows with
    ``|diff| <= t``; the denominator counts every row, missing ones too.

    One pass: rows are counted per bucket (unit buckets up to the largest
    threshold, or one per threshold; partial-aggregated), then a running sum
    over buckets and thresholds in order gives every count."""
    spark = df.sparkSession
    ts = sorted(set(float(t) for t in thresholds))
    whole = all(t == int(t) for t in ts)
    d = F.abs(F.col(diff_col)).cast("double")
    if whole:       # |d| <= t iff ceil(|d|) <= t
        b = F.least(F.ceil(d), F.lit(int(ts[-1]) + 1)).cast("double")
    else:           # the smallest threshold that keeps the row
        b = F.coalesce(F.array_min(F.filter(F.array(*[F.lit(t) for t in ts]), lambda t: t >= d)), F.lit(ts[-1] + 1))
    b = F.when(d.isNotNull() & ~F.isnan(d), b)
    hist = df.groupBy(b.alias("t")).agg(F.count(F.lit(1)).alias("n")).withColumn("k", F.lit(0))
    # the buckets and the thresholds are bounded, so the windows over them are
    marks = spark.createDataFrame([(t, 0, 1) for t in ts], "t double, n long, k int")
    w = Window.orderBy("t", "k").rowsBetween(Window.unboundedPreceding, 0)
    cum = (hist.unionByName(marks)
           .withColumns({"count": F.sum(F.when(F.col("t").isNotNull(), F.col("n")).otherwise(0)).over(w).cast("bigint"),
                         "_total": F.sum("n").over(Window.partitionBy())}))
    return cum.where("k = 1").select(
        F.col("t").cast("int" if whole else "double").alias("threshold"), "count",
        (F.lit(100.0) * F.col("count") / F.nullif(F.col("_total"), F.lit(0))).alias("percent"))
