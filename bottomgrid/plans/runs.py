"""The two scheduled jobs: fetch-and-stage (C12) and aggregate-and-publish
(C13). Both are one lazy plan from scan to write; the staged table written by
C12 is the lineage cut between them."""

from __future__ import annotations

import datetime as dt
import time as _time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import refresh_window
from ..functions.columns import dataset_attributes, epoch_day, narrow, to_standard, with_metadata
from ..operators.daily import daily_cell
from ..operators.qc import SEAFLOOR_THRESHOLD, gross_range
from ..operators.runlog import counts_frame
from ..operators.spatial import CELL_ATTRS, PackedRaster, assign_grid, grid_tiles, pack_raster
from ..operators.union import union_feeds, union_with_sideloads
from ..registry import FEEDS, Feed
from ..schemas import STANDARD_SCHEMA
from ..session import delete_path, path_exists, scratch_path
from ..sinks.logs import append_diagnostics, append_quarantine, append_run_log, diagnostics_rows, read_log, run_log_rows
from ..sinks.publish import export_catalogue, log_archive, publish_days, stage
from ..sinks.snapshots import archive
from ..sources.feeds import error_status, landed_files, scan_feed, sideload_frame, unreadable_files
from ..sources.staged import read_staged
from .standardize import Dims, known_feed, standardize


def window_for(spark: SparkSession, run_date: dt.date, force_full: bool = False) -> tuple[str, dt.datetime]:
    """R1 evaluated for one run date (one-row frame, one value back)."""
    r = spark.range(1).select(refresh_window(F.lit(run_date), force_full).alias("w")).first()["w"]
    return r["reload_type"], r["start"]


@dataclass
class Step1Result:
    reload_type: str
    start: dt.datetime
    statuses: dict[str, str]
    staged_path: str
    phases: dict[str, float] = field(default_factory=dict)
    set_aside: list[tuple[str, str, str]] = field(default_factory=list)    # feed, file, error


PARALLEL_FEEDS = 4


@dataclass
class FeedResult:
    """One feed after fetching: its status, row counts, and where its
    standard rows are (None if there are none)."""
    feed_id: str
    status: str
    raw: int | None = None
    kept: int = 0
    path: str | None = None
    set_aside: dict[str, str] = field(default_factory=dict)


def fetch_feed(spark: SparkSession, f: Feed, root: str, lo: dt.datetime, hi: dt.datetime, dims: Dims, work: str) -> FeedResult:
    """S1-S4 and C1-C10 for one feed. Its scan is written to the shared folder
    (the only time its landed files are read) and standardized from there;
    both counts are counts of written files. Where the scan fails because of
    unreadable files, those are set aside and the others are read again."""
    scan = scan_feed(spark, f, root, lo, hi)
    if scan.status == "missing":
        return FeedResult(f.feed_id, scan.status)
    raw_path, path = f"{work}/raw-{f.feed_id}", f"{work}/{f.feed_id}"
    bad: dict[str, str] = {}
    try:
        try:
            if scan.frame is None:
                raise RuntimeError(scan.status)
            scan.frame.write.mode("overwrite").parquet(raw_path)
        except Exception:  # noqa: BLE001  (find out whether single files are the reason)
            files = landed_files(spark, f, root)
            bad = unreadable_files(spark, f, root, files)
            if not bad or len(bad) == len(files):
                raise
            scan = scan_feed(spark, f, root, lo, hi, files=[p for p in files if p not in bad])
            if scan.frame is None:
                raise RuntimeError(scan.status) from None
            scan.frame.write.mode("overwrite").parquet(raw_path)
        raw = spark.read.parquet(raw_path)
        n = raw.count()
        if not known_feed(f.feed_id):
            return FeedResult(f.feed_id, scan.status, n, set_aside=bad)      # C10: nothing is standardized
        standard_rows(f.feed_id, raw, dims).write.parquet(path)
        return FeedResult(f.feed_id, scan.status, n, spark.read.parquet(path).count(), path, bad)
    except Exception as e:  # noqa: BLE001  (one feed's failure, whatever it is, is logged as its status)
        status = scan.status if scan.status.startswith("error") else error_status(e)
        return FeedResult(f.feed_id, status, set_aside=bad)


def fetch_feeds(spark: SparkSession, root: str, lo: dt.datetime, hi: dt.datetime, dims: Dims, work: str,
                feeds: tuple[Feed, ...] = FEEDS, parallel: int = PARALLEL_FEEDS) -> list[FeedResult]:
    """All feeds, ``parallel`` of them at a time, each in a scheduler pool of
    its own (with ``spark.scheduler.mode=FAIR`` they share the executors
    evenly; otherwise later feeds fill the gaps that earlier ones leave)."""
    def one(f: Feed) -> FeedResult:
        try:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f.feed_id)
        except Exception:  # noqa: BLE001  (Spark Connect has no local properties)
            pass
        return fetch_feed(spark, f, root, lo, hi, dims, work)

    with ThreadPoolExecutor(max_workers=max(parallel, 1), thread_name_prefix="feed") as pool:
        return list(pool.map(one, feeds))


def run_step1(spark: SparkSession, root: str, grid: DataFrame, raster: DataFrame | PackedRaster,
              run_date: dt.date, staged_path: str, log_path: str, version: str = "1",
              sideloads: dict[str, DataFrame] | None = None, force_full: bool = False,
              doi: str = "", seabed_threshold: float = SEAFLOOR_THRESHOLD,
              run_id: str | None = None, parallel: int = PARALLEL_FEEDS) -> Step1Result:
    """R1 -> S1..S4 -> C1..C10 -> U1 -> C11 -> U2 (S5) -> K1, K2.

    The feeds are fetched and standardized side by side, each on its own and
    into the shared folder: a feed that lacks a column or cannot be read fails
    alone, is logged with its status, and the others go on; of a feed with
    some unreadable files the others count, and the unreadable ones are logged
    (``quarantine_path``). Side-load frames (``gmgi``, ``study_fleet``) carry a
    cell id and are processed even when no remote feed has rows. A job that is
    tried again with the ``run_id`` of its first try logs nothing twice."""
    t0 = _time.time()
    phases: dict[str, float] = {}
    kind, start = window_for(spark, run_date, force_full)
    hi = dt.datetime.combine(run_date, dt.time.max)
    work = scratch_path(spark, f"step1-{uuid.uuid4().hex}")
    packed = raster if isinstance(raster, PackedRaster) else pack_raster(raster, f"{work}/raster")
    dims = Dims(grid=grid, raster=packed, seabed_threshold=seabed_threshold)
    tiles = grid_tiles(grid, carry=CELL_ATTRS)   # one join locates and attaches (C11)
    results = fetch_feeds(spark, root, start, hi, dims, work, parallel=parallel)
    statuses = {r.feed_id: r.status for r in results}
    raw_n = {r.feed_id: r.raw for r in results if r.raw is not None}
    kept_n = {r.feed_id: r.kept for r in results if r.raw is not None}
    std = [spark.read.parquet(r.path) for r in results if r.path]
    set_aside = [(r.feed_id, name, why) for r in results for name, why in sorted(r.set_aside.items())]
    phases["standardize"] = _time.time() - t0
    empty = spark.createDataFrame([], STANDARD_SCHEMA).withColumns(
        {"dataset_id": F.lit(None).cast("string"), "tie": F.lit(None).cast("bigint")})
    gridded = assign_grid(union_feeds(std) if std else empty, grid, tiles=tiles)
    side = {}
    for k, v in (sideloads or {}).items():
        path = f"{work}/side-{k}"
        rows = sideload_frame(v, grid, start)
        rows.withColumn("tie", tie_of(rows)).write.parquet(path)
        side[k] = spark.read.parquet(path)
        raw_n[k] = kept_n[k] = side[k].count()     # side-loads are not filtered further
    allrows = union_with_sideloads(side.get("gmgi"), side.get("study_fleet"), gridded)
    stage(allrows, staged_path)
    if path_exists(spark, work):
        delete_path(spark, work)
    phases["stage"] = _time.time() - t0 - phases["standardize"]
    for f in FEEDS:
        raw_n.setdefault(f.feed_id, 0)
    counts = counts_frame(spark, raw_n, kept_n)
    providers = {f.feed_id: f.group for f in FEEDS}
    protocols = {f.feed_id: "erddap" for f in FEEDS}
    for k in side:
        statuses[k], providers[k], protocols[k] = "side-load", k, "local"
    now = dt.datetime.now(dt.timezone.utc)
    rows = run_log_rows(counts, now, version, kind, statuses, providers=providers,
                        protocols=protocols, doi=doi, elapsed=_time.time() - t0)
    append_run_log(rows, log_path, run_id)
    if set_aside:
        append_quarantine(spark, set_aside, now, quarantine_path(log_path), run_id)
    # step 1's own diagnostics travel with the hand-off; step 2 appends them
    # ahead of its own row (K6)
    diag = diagnostics_rows(spark, now, "step1", version, _time.time() - t0, phases)
    diag.write.mode("overwrite").parquet(upstream_diagnostics_path(staged_path))
    (spark.createDataFrame([(kind, doi)], "reload_type string, doi string")
     .write.mode("overwrite").parquet(handoff_path(staged_path)))
    return Step1Result(kind, start, statuses, staged_path, phases, set_aside)


def quarantine_path(log_path: str) -> str:
    """Files that runs could not read, beside the run log."""
    return log_path.rstrip("/") + "_quarantine"


def tie_of(df: DataFrame) -> Column:
    """A content hash that orders rows of the same time: it depends on what a
    row says, not on where it lies. Measured values take part rounded, as
    means may differ in their last digits from run to run."""
    text = [c for c in ("dataset_id", "data_provider", "fishery_dependent", "id") if c in df.columns]
    real = [c for c in ("latitude", "longitude", "depth", "temperature", "salinity", "dissolved_oxygen") if c in df.columns]
    return F.xxhash64(*[F.col(c) for c in text], *[F.round(F.col(c).cast("double"), 6) for c in real])


def standard_rows(fid: str, scan: DataFrame, dims: Dims) -> DataFrame:
    """One feed's standard rows with their feed and tie column. Rows of the
    scan that tie in time are ordered by the hash of all their columns."""
    raw = scan.withColumn("tie", F.xxhash64(*scan.columns))
    out = to_standard(standardize(fid, raw, dims, tie="tie")).withColumn("dataset_id", F.lit(fid))
    return out.withColumn("tie", tie_of(out))


def handoff_path(staged_path: str) -> str:
    """The run's reload type and doi, for step 2."""
    return staged_path.rstrip("/") + "_handoff"


def upstream_diagnostics_path(staged_path: str) -> str:
    return staged_path.rstrip("/") + "_diagnostics"


def attributes_path(product_path: str) -> str:
    """The one-row dataset attribute table (P9) inside the product folder; the
    leading underscore keeps it out of the product's partition discovery."""
    return product_path.rstrip("/") + "/_attributes"


def product_frame(staged: DataFrame, order: list[str] | None = None) -> DataFrame:
    """C13 without the write: A4 -> P12 -> P6 -> P8 -> P9."""
    order = order or [c for c in ("source_ord", "time", "tie") if c in staged.columns]
    daily = daily_cell(staged, order=order)
    return with_metadata(narrow(gross_range(epoch_day(daily))))


def run_step2(spark: SparkSession, staged_path: str, product_path: str, archive_root: str,
              catalogue_path: str, diag_path: str, version: str = "1",
              reload_type: str | None = None, doi: str | None = None,
              now: dt.datetime | None = None, catalogue_csv: str | None = None,
              run_id: str | None = None) -> list[int]:
    """C13 (flagship): S8 -> A4 -> P12 -> P6 -> P8 -> P9 -> K3, with the
    archive (K4, before any day is replaced), catalogue (K5, exported as CSV
    next to it or to ``catalogue_csv``) and diagnostics (K6). Reload type and
    doi come from step 1's hand-off unless they are given. A job that is tried
    again with the ``run_id`` of its first try logs nothing twice."""
    t0 = _time.time()
    if reload_type is None or doi is None:
        told = spark.read.parquet(handoff_path(staged_path)).first() \
            if path_exists(spark, handoff_path(staged_path)) else None
        reload_type = reload_type if reload_type is not None else told["reload_type"] if told else "daily"
        doi = doi if doi is not None else (told["doi"] or "") if told else ""
    now = now or dt.datetime.now(dt.timezone.utc)
    phases = {}
    if path_exists(spark, product_path):
        snap, size = archive(spark, product_path, archive_root, version, now, doi)
        log_archive(spark, catalogue_path, snap, snap, now, version, doi, reload_type, size, run_id)
        export_catalogue(read_log(spark, catalogue_path), catalogue_csv or catalogue_path.rstrip("/") + "_csv")
        phases["archive"] = _time.time() - t0
    days = publish_days(product_frame(read_staged(spark, staged_path)), product_path)
    dataset_attributes(spark, version).write.mode("overwrite").parquet(attributes_path(product_path))
    phases["publish"] = _time.time() - t0 - phases.get("archive", 0.0)
    up = upstream_diagnostics_path(staged_path)
    upstream = spark.read.parquet(up) if path_exists(spark, up) else None
    append_diagnostics(diagnostics_rows(spark, now, "step2", version, _time.time() - t0,
                                        phases, len(days)), diag_path, upstream, run_id)
    return days
