"""Helpers shared by the operators: column plumbing and bounded text slices."""

from __future__ import annotations

import contextlib
import contextvars
import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_path, scratch_path

SLICE_BYTES = 3 << 20


def fresh(name: str) -> str:
    """A column name that no input table has."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"


def text_column(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`").cast("string")


def with_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """``df`` plus ``new``; an input column of the same name is replaced."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in new]
    return df.select(*kept, *[c.alias(n) for n, c in new.items()])


def give_back() -> None:
    """Hand memory that is free by now back to the system. Python workers are
    used again by later tasks, and what one task freed would stay theirs."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):      # not the GNU C library
        ctypes.CDLL(None).malloc_trim(0)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[list[str]]:
    """The texts of an Arrow array (null: empty) in lists of about ``limit``
    bytes, so that what a task holds does not follow the batch size; one
    longer text makes a list of its own."""
    if len(texts) == 0:
        return
    out: list[str] = []
    size = 0
    for x in texts:
        s = x.as_py() or ""
        if out and size + len(s) > limit:
            yield out
            out, size = [], 0
        out.append(s)
        size += len(s)
    yield out


def struct_of_text(text: Column, schema: T.StructType,
                   fn: Callable[[list[str]], dict[str, pa.Array | np.ndarray | list]], limit: int = SLICE_BYTES) -> Column:
    """An Arrow-batched function of one text column that returns a struct.
    ``fn`` gets lists of texts of about ``limit`` bytes and returns one array
    per field; each list's result goes out before the next list is begun, so
    that neither the task nor its executor holds the results of a whole batch."""
    names = schema.names
    kinds = [_arrow_type(f.dataType) for f in schema]

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        give_back()
        for arr in arrays:
            for texts in slices(arr, limit):
                got = fn(texts)
                cols = [got[n] if isinstance(got[n], pa.Array) else pa.array(got[n], k) for n, k in zip(names, kinds)]
                yield pa.StructArray.from_arrays(cols, names=names)
        give_back()

    run.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, schema)(text)


def add_from_text(df: DataFrame, text_col: str, schema: T.StructType, fn: Callable, limit: int = SLICE_BYTES) -> DataFrame:
    """``df`` plus the fields of ``struct_of_text`` (same names are replaced)."""
    tmp = fresh("s")
    out = df.withColumn(tmp, struct_of_text(text_column(df, text_col), schema, fn, limit))
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c not in schema.names],
                      *[F.col(f"{tmp}.{n}").alias(n) for n in schema.names])


def _arrow_type(t: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(t)


def list_array(values: np.ndarray | pa.Array, lengths: np.ndarray) -> pa.Array:
    """Arrow lists from flat values and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values if isinstance(values, pa.Array) else pa.array(values))


def table_path(spark: SparkSession, name: str) -> str:
    """A new folder for an intermediate table under ``spark.checkpoint.dir``."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


_temporary: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("temporary", default=None)


def as_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    and a lost executor costs nothing that was already written."""
    spark = df.sparkSession
    path = table_path(spark, name)
    if _temporary.get() is not None:
        _temporary.get().append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def last_table(make: Callable[[], DataFrame], spark: SparkSession, name: str) -> DataFrame:
    """The result of ``make()`` as a table; the tables that it made on the way
    are removed, whether it ends well or not."""
    token = _temporary.set([])
    try:
        out = make()
        path = table_path(spark, name)
        out.write.parquet(path)
        schema = out.schema
    finally:
        made = _temporary.get()
        _temporary.reset(token)
        for old in made:
            delete_path(spark, old)
    if _temporary.get() is not None:
        _temporary.get().append(path)
    return spark.read.schema(schema).parquet(path)


BITS = 26  # of a filter; 8 MB, whatever the tables


def may_have(df: DataFrame, values: DataFrame, on: list[str]) -> DataFrame:
    """``df`` without most rows whose ``on`` columns no row of ``values`` has:
    a bitmap of 2**26 bits, broadcast as 2,048 rows, meets each row before any
    shuffle. False hits pass, so an exact join must follow."""
    p, m, bits = fresh("p"), fresh("m"), fresh("bits")
    bit = F.pmod(F.xxhash64(*on), F.lit(1 << BITS))
    maps = values.select(bit.alias(p)).groupBy(F.expr(f"{p} div 32768").alias(m)).agg(
        F.bitmap_construct_agg(F.expr(f"{p} % 32768")).alias(bits))
    out = df.withColumn(p, bit).withColumn(m, F.expr(f"{p} div 32768")).join(F.broadcast(maps), m)
    byte = F.conv(F.hex(F.expr(f"substring({bits}, CAST(({p} % 32768) div 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    out = out.where(byte.bitwiseAND(F.expr(f"shiftleft(1, CAST({p} % 8 AS INT))")) != 0)
    return out.drop(p, m, bits)


# --- words as 64-bit hashes ------------------------------------------------

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd: has an inverse modulo 2**64
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit (in place on a copy)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    if n:
        out[0] = 1
        if n > 1:
            out[1:] = base
            np.multiply.accumulate(out, out=out)
    return out


def word_hashes(texts: list[str], breaks: np.ndarray,
                prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """Hashes of the words of all texts, in order, and the number of words of
    each text. Words are runs of bytes whose lower-cased (A-Z only) value is
    not in ``breaks`` (256 booleans, among them the line break); no word
    crosses two texts. For each length in ``prefixes`` follow the hashes of
    the words' first bytes (of the whole word where it is shorter)."""
    blobs = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(blobs) + b"\n", np.uint8)  # a break between texts
    ends = np.cumsum([len(b) + 1 for b in blobs])
    data = LOWER[data]
    inside = ~breaks[data]
    edge = np.diff(np.concatenate(([False], inside)).view(np.int8))
    starts = np.flatnonzero(edge == 1)
    stops = np.flatnonzero(edge == -1)
    counts = np.diff(np.searchsorted(starts, ends), prepend=0)
    acc = _BYTE[data]
    acc *= powers(_BASE, len(data))
    np.cumsum(acc, out=acc)
    before = np.where(starts > 0, acc[np.maximum(starts, 1) - 1], np.uint64(0))
    back = powers(_INV, len(data))[starts]
    ends = [stops, *[np.minimum(stops, starts + k) for k in prefixes]]
    first, *more = [mix((acc[e - 1] - before) * back) for e in ends]
    return first, counts.astype(np.int64), *more


def breaks_at(*ranges: tuple[int, int]) -> np.ndarray:
    """256 booleans, true in the closed byte ranges."""
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a:b + 1] = True
    return out


WHITE = breaks_at((0x20, 0x20), (0x09, 0x0D))
