"""Which stream a checkpoint belongs to.

A checkpoint means something only together with the tables it was made for: it
says which files of one staged table are done. So every stream records the
tables beside its checkpoint when it starts for the first time, and refuses a
checkpoint that was made for others.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..session import path_exists


def owner_path(checkpoint: str) -> str:
    return checkpoint.rstrip("/") + "_tables"


def own_checkpoint(spark: SparkSession, checkpoint: str, tables: dict[str, str]) -> None:
    """Bind ``checkpoint`` to ``tables`` (role -> path), or check that it is."""
    path = owner_path(checkpoint)
    want = {k: v.rstrip("/") for k, v in tables.items()}
    if path_exists(spark, f"{path}/_SUCCESS"):
        have = {r["role"]: r["path"] for r in spark.read.parquet(path).collect()}
        if have != want:
            raise ValueError(f"the checkpoint {checkpoint} belongs to a stream over {have}")
        return
    if path_exists(spark, f"{checkpoint}/metadata"):
        raise ValueError(f"the checkpoint {checkpoint} was made by another stream")
    # one row per role; a start that ended half way leaves no _SUCCESS and is written again
    spark.createDataFrame(sorted(want.items()), "role string, path string").coalesce(1).write.mode("overwrite").parquet(path)
