"""Spark session settings shared by the library, the tests and the benchmark.

The library never hard-codes a cluster: it reads what the session already has
and only fills in what is missing (the checkpoint folder in local tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes and
# splits skewed shuffle partitions; the session zone is pinned so nothing that
# formats or truncates a zoned timestamp changes with the host.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    # collect_set / min_by aggregates keep up to this many keys per task in a
    # hash map before switching to sort-based aggregation (default 128)
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    # checkpoint files of the running median are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "bottomgrid",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage-cutting tables.

    On a cluster this is ``spark.checkpoint.dir`` as the cluster names it; a
    private folder is made only for a local master (tests). Elsewhere an unset
    folder is an error: a machine-local one would not be seen by the others.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (Spark Connect: the server owns the context)
        sc = None
    if not path and sc is not None:
        path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="bottomgrid-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A sub-folder of the shared checkpoint folder (never machine-local)."""
    return os.path.join(checkpoint_dir(spark), *parts)


def _file_system(spark: SparkSession, path: str):
    """Hadoop's FileSystem and Path for ``path``, on whatever file system it
    names; None without a JVM gateway (Spark Connect)."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (no classic context to ask)
        return None
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists. False only if the file system says
    so; any other failure is raised, so that nobody takes it for absence."""
    found = _file_system(spark, path)
    if found:
        fs, p = found
        return bool(fs.exists(p))
    try:
        spark.read.format("binaryFile").load(path).limit(1).count()
        return True
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return False
        raise


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder recursively; False if there was none. A failure to
    remove what exists is raised."""
    found = _file_system(spark, path)
    if not found:
        raise RuntimeError("no file system access to remove " + path)
    fs, p = found
    if not fs.exists(p):
        return False
    if not fs.delete(p, True):
        raise OSError(f"could not remove {path}")
    return True


def content_bytes(spark: SparkSession, path: str) -> int | None:
    """Bytes of the data files under ``path``, from the file system's content
    summary of the folder less those of its bookkeeping entries (names that
    start with ``_`` or ``.``); None without a JVM gateway."""
    found = _file_system(spark, path)
    if not found:
        return None
    fs, p = found
    total = fs.getContentSummary(p).getLength()
    for entry in fs.listStatus(p):
        if entry.getPath().getName().startswith(("_", ".")):
            total -= fs.getContentSummary(entry.getPath()).getLength()
    return int(total)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, sorted; none if it does not exist."""
    found = _file_system(spark, path)
    if not found:
        raise RuntimeError("no file system access to list " + path)
    fs, p = found
    return sorted(e.getPath().getName() for e in fs.listStatus(p)) if fs.exists(p) else []


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty marker file (again is no error)."""
    found = _file_system(spark, path)
    if not found:
        raise RuntimeError("no file system access to write " + path)
    fs, p = found
    fs.create(p, True).close()
