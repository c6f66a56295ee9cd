"""Merkle manifest of a dataset, with leaf places from bitmap ranks.

Every row is a leaf, the sha256 of its fields. Per group the leaves ascend by
id; every three consecutive nodes become their hash until one is left, the
group's root; the roots, ordered by group, are reduced likewise to the root of
the dataset. A row's proof are the siblings on its way up.

1. Places. Ids are gathered per (group, id / 65536) into compressed bitmaps:
   sorted 16-bit numbers, or 8 kB of bits where that is less. Each task sends
   one per batch, and they are merged. A directory holds how many rows precede
   each bitmap; inside it the rank of an id is a directory of popcounts plus
   the bits before it in its word. Leaves are never sorted.
2. Levels. Nodes go to blocks of 3**LEVELS consecutive places, an array of
   slots keyed by (group, block), and each block is reduced to one node in its
   task. A few rounds of blocks reach the roots; the roots are reduced the same
   way as one more group.
3. Proofs go back down from block to block: a block adds its own siblings to
   what it got from above, and the lowest blocks hash each leaf's proof and
   fold its way up again.

Groups may hold any share of the rows: bitmaps and blocks split a group by
number, and the directory and the order of the groups are prefix sums over a
range partitioning. The driver holds one number per partition of those.

Defined results. A null field is ``-``, any other its UTF-8 bytes' count, a
colon and the value. The null group comes first. Rows without an id come first
in their group, and rows that share one follow each other by their leaf;
equal rows are different leaves, in either order. Empty and long texts are
ordinary fields. An empty table has no rows. Other columns are ignored, and
the result has only its own. Ids are integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_table

WAYS = 3
LEVELS = 6  # reduced in one block, of 729 slots
CHUNK = 1 << 16  # ids of a bitmap
_BITMAP = CHUNK // 8


def digest(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def field(c: Column) -> Column:
    s = c.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf(df: DataFrame, fields: list[str], altered: dict[str, Column] | None = None) -> Column:
    own = [(altered or {}).get(c, F.col(f"`{c}`")) for c in fields]
    return F.unhex(F.sha2(F.concat(*[field(c) for c in own]).cast("binary"), 256))


# --- bitmaps ---------------------------------------------------------------

def pack(low: np.ndarray) -> bytes:
    """Sorted distinct 16-bit numbers as themselves, or as bits."""
    if 2 * len(low) < _BITMAP:
        return low.astype("<u2").tobytes()
    bits = np.zeros(CHUNK, bool)
    bits[low] = True
    return np.packbits(bits, bitorder="little").tobytes()


def unpack(data: bytes) -> np.ndarray:
    if len(data) < _BITMAP:
        return np.frombuffer(data, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little"))


class Ranks:
    """Rank queries on one packed bitmap."""

    def __init__(self, data: bytes):
        if len(data) < _BITMAP:
            self.low, self.words = np.frombuffer(data, "<u2").astype(np.int64), None
        else:
            self.words = np.frombuffer(data, "<u8")
            count = np.bitwise_count(self.words).astype(np.int64)
            self.before = np.cumsum(count) - count

    def __call__(self, low: np.ndarray) -> np.ndarray:
        """How many numbers of the bitmap are less, for each of ``low``."""
        if self.words is None:
            return np.searchsorted(self.low, low)
        word = low >> 6
        mask = (np.uint64(1) << (low & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask).astype(np.int64)


def _column(values, kind) -> pa.Array:
    return pa.array(values, kind)


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bitmap per (grp, hi) of a batch; ids that repeat in it follow with
    how often they do."""
    for b in batches:
        coded = b.column("grp").dictionary_encode()
        names, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        ids = b.column("id").to_numpy()
        order = np.lexsort((ids, code))
        code, ids = code[order], ids[order]
        new = np.ones(len(ids), bool)
        new[1:] = (code[1:] != code[:-1]) | (ids[1:] != ids[:-1])
        at = np.flatnonzero(new)
        count = np.diff(np.append(at, len(ids)))
        code, ids = code[at], ids[at]
        part = np.ones(len(ids), bool)
        part[1:] = (code[1:] != code[:-1]) | (ids[1:] >> 16 != ids[:-1] >> 16)
        starts = np.flatnonzero(part)
        rows = []
        for x, y in zip(starts.tolist(), np.append(starts[1:], len(ids)).tolist()):
            low, c = ids[x:y] & (CHUNK - 1), count[x:y]
            again = c > 1
            rows.append((names[code[x]], int(ids[x] >> 16), pack(low), low[again].astype("<u2").tobytes(),
                         c[again].astype("<i8").tobytes()))
        yield _bitmap_batch(rows)


_FORM = "grp string, hi long, bits binary, again binary, times binary"


def _bitmap_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    cols = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays([_column(list(c), k) for c, k in zip(cols, kinds)],
                                      names=["grp", "hi", "bits", "again", "times"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bitmap per (grp, hi) of sorted partial ones, and its rows. A
    partial one takes part as soon as it is read; what is held is the numbers
    of one bitmap, with counts."""
    key = low = times = None

    def done():
        again = times > 1
        return pa.RecordBatch.from_arrays(
            [_column([v], k) for v, k in zip(
                (*key, int(times.sum()), pack(low), low[again].astype("<u2").tobytes(), times[again].astype("<i8").tobytes()),
                (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
            names=["grp", "hi", "n", "bits", "again", "times"])

    for b in batches:
        for grp, hi, bits, again, count in zip(*[b.column(c).to_pylist() for c in ("grp", "hi", "bits", "again", "times")]):
            more = unpack(bits)
            c = np.ones(len(more), np.int64)
            c[np.searchsorted(more, np.frombuffer(again, "<u2"))] = np.frombuffer(count, "<i8")
            if key == (grp, hi):
                both, inverse = np.unique(np.concatenate([low, more]), return_inverse=True)
                total = np.zeros(len(both), np.int64)
                np.add.at(total, inverse, np.concatenate([times, c]))
                low, times = both, total
                continue
            if key is not None:
                yield done()
            key, low, times = (grp, hi), more, c
    if key is not None:
        yield done()


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of the rows of each bitmap; its own row (with ``bits``) comes
    before them. Ids that repeat have no place yet."""
    base, ranks = 0, None
    for b in batches:
        b = pa.RecordBatch.from_arrays(b.columns, names=b.schema.names)
        bits = b.column("bits")
        starts = np.flatnonzero(bits.is_valid().to_numpy(zero_copy_only=False))
        ids = b.column("id").to_numpy(zero_copy_only=False)
        idx = np.zeros(b.num_rows, np.int64)
        for x, y in zip([-1, *starts.tolist()], [*starts.tolist(), b.num_rows]):
            if x >= 0:
                base, ranks = b.column("base")[x].as_py(), Ranks(bits[x].as_py())
                low, times = (np.frombuffer(b.column(c)[x].as_py(), t) for c, t in (("again", "<u2"), ("times", "<i8")))
                extra = np.concatenate(([0], np.cumsum(times - 1)))
            if y > x + 1:
                own = ids[x + 1:y].astype(np.int64) & (CHUNK - 1)
                idx[x + 1:y] = base + ranks(own) + extra[np.searchsorted(low, own)]
        rows = np.delete(np.arange(b.num_rows), starts)
        if len(rows):
            part = b.select(["grp", "id", "leaf", "copy"]).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(idx[rows])], names=["grp", "id", "leaf", "copy", "idx"])


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(grp, id, first): where the rows of each repeated id begin."""
    for b in batches:
        grp, idc, first = [], [], []
        for g, hi, base, bits, again, times in zip(*[b.column(c).to_pylist() for c in ("grp", "hi", "base", "bits", "again", "times")]):
            low, t = np.frombuffer(again, "<u2").astype(np.int64), np.frombuffer(times, "<i8")
            grp += [g] * len(low)
            idc += ((hi << 16) + low).tolist()
            first += (base + Ranks(bits)(low) + np.cumsum(t - 1) - (t - 1)).tolist()
        yield pa.RecordBatch.from_arrays([_column(grp, pa.string()), _column(idc, pa.int64()), _column(first, pa.int64())],
                                         names=["grp", "id", "first"])


def with_preceding(df: DataFrame, by: list[str], weight: str, name: str) -> DataFrame:
    """``df`` as a table with ``before``: the summed weight of all rows that
    come earlier by ``by``. Sorted by range; each partition sums its own, and
    one number per partition is summed by the driver."""
    schema = T.StructType([*df.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("before", T.LongType())])

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for b in batches:
            w = b.column(weight).to_numpy().astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(len(w), part, np.int32)), pa.array(total + np.cumsum(w) - w)], names=schema.names)
            total += int(w.sum())

    out = as_table(df.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(running, schema), name)
    sums = {r["part"]: r["n"] for r in out.groupBy("part").agg(F.sum(weight).alias("n")).collect()}
    offset, at = [], 0
    for p in range(max(sums, default=-1) + 1):
        offset.append(at)
        at += sums.get(p, 0)
    if not offset:
        return out.drop("part")
    return out.withColumn("before", F.col("before") + F.element_at(F.lit(np.array(offset, np.int64)), F.col("part") + 1)).drop("part")


def places(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of rows (grp, id, leaf, copy): the rows with ``idx``, their place in
    the group, and the groups (grp, n). Groups are strings, none is null."""
    known = rows.where("id IS NOT NULL")
    maps = (known.select("grp", "id").mapInArrow(_bitmaps, _FORM).repartition("grp", "hi").sortWithinPartitions("grp", "hi")
            .mapInArrow(_merged, "grp string, hi long, n long, bits binary, again binary, times binary"))
    maps = as_table(maps, "bitmaps")
    lost = as_table(rows.where("id IS NULL").groupBy("grp").agg(F.count("*").alias("nulls")), "no-id")
    ahead = with_preceding(maps.select("grp", "hi", "n"), ["grp", "hi"], "n", "directory")
    groups = ahead.groupBy("grp").agg(F.min("before").alias("start"), F.sum("n").alias("m")).join(lost, "grp", "full")
    groups = as_table(groups.select("grp", "start", F.coalesce("nulls", F.lit(0)).alias("nulls"),
                                    (F.coalesce("m", F.lit(0)) + F.coalesce("nulls", F.lit(0))).alias("n")), "groups")
    ahead = ahead.join(groups, "grp").select("grp", "hi", (F.col("before") - F.col("start") + F.col("nulls")).alias("base"))
    maps = as_table(maps.join(ahead, ["grp", "hi"]), "ranked-bitmaps")

    odd = maps.where(F.octet_length("again") > 0)
    repeated = as_table(odd.mapInArrow(_repeated, "grp string, id long, first long"), "repeated")
    plain, more = known, None
    if not (repeated.isEmpty() and lost.isEmpty()):
        marked = known.join(repeated, ["grp", "id"], "left")
        plain = marked.where("first IS NULL").drop("first")
        more = marked.where("first IS NOT NULL").unionByName(rows.where("id IS NULL").withColumn("first", F.lit(0).cast("long")))
        more = as_table(more.withColumns({"uid": F.monotonically_increasing_id(), "one": F.lit(1)}), "ties")
        more = with_preceding(more, ["grp", "first", "leaf", "uid"], "one", "ties-in-order")
        start = more.groupBy("grp", "first").agg(F.min("before").alias("least"))
        more = more.join(start, ["grp", "first"]).select(
            "grp", "id", "leaf", "copy", (F.col("first") + F.col("before") - F.col("least")).alias("idx"))
    none = F.lit(None)
    keyed = plain.select("grp", F.shiftright("id", 16).alias("hi"), F.lit(1).alias("kind"), "id", "leaf", "copy",
                         none.cast("long").alias("base"), *[none.cast("binary").alias(c) for c in ("bits", "again", "times")])
    heads = maps.select("grp", "hi", F.lit(0).alias("kind"), none.cast("long").alias("id"),
                        *[none.cast("binary").alias(c) for c in ("leaf", "copy")], "base", "bits", "again", "times")
    out = (heads.unionByName(keyed).repartition("grp", "hi").sortWithinPartitions("grp", "hi", "kind")
           .mapInArrow(_places, "grp string, id long, leaf binary, copy binary, idx long"))
    return as_table(out if more is None else out.unionByName(more), "places"), groups


# --- levels ----------------------------------------------------------------

def climb(nodes: list[bytes], first: bool, size: int, levels: int) -> list[list[bytes]]:
    """The levels of a block, from its slots to its one node. A group's first
    block that is not full is its only one and stops at one node; any other
    is reduced ``levels`` times, as nodes beside it remain."""
    out = [nodes]
    alone = first and len(nodes) < size
    while len(out) <= levels and not (alone and len(out[-1]) == 1):
        below = out[-1]
        out.append([digest(*below[i:i + WAYS]) for i in range(0, len(below), WAYS)])
    return out


def ways(tower: list[list[bytes]], siblings: bytes, steps: bytes) -> list[tuple[bytes, bytes]]:
    """(siblings, steps) of every slot, given those of the block's node. A
    step is one byte: place among the run's nodes, times 4, plus its others."""
    above = [(siblings, steps)]
    for nodes in tower[-2::-1]:
        here = []
        for i, node in enumerate(nodes):
            p = i // WAYS
            run = nodes[p * WAYS:p * WAYS + WAYS]
            k = i - p * WAYS
            s, t = above[p]
            here.append((b"".join(run[:k] + run[k + 1:]) + s, bytes([k * 4 + len(run) - 1]) + t))
        above = here
    return above


def fold(node: bytes, siblings: bytes, steps: bytes) -> bytes:
    """The root that a leaf and its proof lead to."""
    at = 0
    for step in steps:
        k, others = step >> 2, step & 3
        run = [siblings[at + 64 * j:at + 64 * (j + 1)] for j in range(others)]
        at += 64 * others
        run.insert(k, node)
        node = digest(*run)
    return node


def _blocks(nodes: DataFrame, groups: DataFrame, payload: list[str], levels: int, name: str) -> list[DataFrame]:
    """Tables of blocks (grp, block, slots, top), one per round, of nodes
    (grp, idx, node, payload). ``groups`` has the nodes of each group."""
    size = WAYS ** levels
    most = groups.agg(F.max("n")).first()[0] or 0
    rounds, left = [], nodes

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            top = []
            for block, slots in zip(b.column("block").to_pylist(), b.column("slots")):
                hexed = [s.hex().encode() for s in slots.values.field("node").to_pylist()]
                top.append(bytes.fromhex(climb(hexed, block == 0, size, levels)[-1][0].decode()))
            yield pa.RecordBatch.from_arrays([*b.columns, _column(top, pa.binary())], names=[*b.schema.names, "top"])

    while most:
        slot = F.struct(F.expr(f"CAST(pmod(idx, {size}) AS INT)").alias("slot"), F.col("node"), *payload)
        kept = left.groupBy("grp", F.expr(f"idx div {size}").alias("block")).agg(F.sort_array(F.collect_list(slot)).alias("slots"))
        schema = T.StructType([*kept.schema.fields, T.StructField("top", T.BinaryType())])
        rounds.append(as_table(kept.mapInArrow(tops, schema), f"{name}-{len(rounds)}"))
        if size ** len(rounds) >= most:
            break
        going = groups.where(F.col("n") > size ** len(rounds)).select("grp")
        left = rounds[-1].select("grp", F.col("block").alias("idx"), F.col("top").alias("node")).join(going, "grp", "left_semi")
        payload = []
    return rounds


_WAY = "siblings binary, steps binary"


def _down(rounds: list[DataFrame], groups: DataFrame, levels: int, name: str) -> DataFrame:
    """The lowest blocks with ``siblings`` and ``steps`` from their node to
    the root. ``groups`` (grp, n, subroot, siblings, steps) has those of the
    groups' roots."""
    size = WAYS ** levels

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for grp, block, slots, sub, s, t in zip(*[b.column(c).to_pylist() for c in ("grp", "block", "slots", "subroot", "siblings", "steps")]):
                tower = climb([x["node"].hex().encode() for x in slots], block == 0, size, levels)
                out += [(grp, block * size + i, sub, *w) for i, w in enumerate(ways(tower, s, t))]
            kinds = [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([_column(list(c), k) for c, k in zip(list(zip(*out)) or [()] * 5, kinds)],
                                             names=["grp", "block", "subroot", "siblings", "steps"])

    came: DataFrame | None = None
    for r in range(len(rounds) - 1, -1, -1):
        low = size ** r if r else 0
        own = groups.where((F.col("n") > low) & (F.col("n") <= size ** (r + 1))).select(
            "grp", F.lit(0).cast("long").alias("block"), "subroot", "siblings", "steps")
        tails = own if came is None else came.unionByName(own)
        here = rounds[r].join(tails, ["grp", "block"])
        if r == 0:
            return here
        came = as_table(here.mapInArrow(deal, f"grp string, block long, subroot binary, {_WAY}"), f"{name}-down-{r}")
    raise ValueError("no rounds")


def merkle_manifest(df: DataFrame, id_col: str = "doc_id", group_col: str = "source",
                    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
                    altered: dict[str, Column] | None = None, proofs: bool = False, levels: int = LEVELS) -> DataFrame:
    """Per row of ``df``: id, leaf, subroot and root, the hash of its proof,
    the root that its copy folds to with that proof, and whether it is the
    root. A copy has the row's fields, but those in ``altered``. With
    ``proofs`` also the proof itself: the siblings' hex text, and one byte per
    level (place in the run, times 4, plus the number of siblings)."""
    grp = F.col(f"`{group_col}`").cast("string")
    rows = as_table(df.select(
        F.when(grp.isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), grp)).alias("grp"),  # orders as the groups do, null first
        F.col(f"`{id_col}`").cast("long").alias("id"),
        leaf(df, list(fields)).alias("leaf"), leaf(df, list(fields), altered).alias("copy")), "leaves")
    leaves, groups = places(rows)
    size = WAYS ** levels
    rounds = _blocks(leaves.withColumnRenamed("leaf", "node"), groups, ["id", "copy"], levels, "blocks")
    names = ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    schema = T.StructType([T.StructField(id_col, T.LongType()), *[T.StructField(c, T.StringType()) for c in names[:-1]],
                           T.StructField("verified", T.BooleanType())])
    if proofs:
        schema = T.StructType([*schema.fields, T.StructField("proof", T.StringType()), T.StructField("steps", T.BinaryType())])
    if not rounds:
        return df.sparkSession.createDataFrame([], schema)

    # one tree more, over the groups' roots
    roots = None
    for r, table in enumerate(rounds):
        done = groups.where((F.col("n") > (size ** r if r else 0)) & (F.col("n") <= size ** (r + 1))).select("grp", "n")
        part = table.where("block = 0").join(done, "grp").select("grp", "n", F.col("top").alias("subroot"))
        roots = part if roots is None else roots.unionByName(part)
    roots = with_preceding(as_table(roots.withColumn("one", F.lit(1)), "roots"), ["grp"], "one", "roots-in-order")
    one = roots.agg(F.count("*").alias("n")).select(F.lit("").alias("grp"), "n")
    upper = _blocks(roots.select(F.lit("").alias("grp"), F.col("before").alias("idx"), F.col("subroot").alias("node")),
                    one, [], levels, "roots")
    root = upper[-1].where("block = 0").first()["top"]
    start = one.withColumns({"subroot": F.lit(None).cast("binary"), "siblings": F.lit(b""), "steps": F.lit(b"")})
    lowest = _down(upper, start, levels, "roots")

    def to_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for block, slots, s, t in zip(*[b.column(c).to_pylist() for c in ("block", "slots", "siblings", "steps")]):
                tower = climb([x["node"].hex().encode() for x in slots], block == 0, size, levels)
                out += [(block * size + i, *w) for i, w in enumerate(ways(tower, s, t))]
            yield pa.RecordBatch.from_arrays([_column(list(c), k) for c, k in zip(list(zip(*out)) or [()] * 3, (pa.int64(), pa.binary(), pa.binary()))],
                                             names=["before", "siblings", "steps"])

    of_groups = as_table(roots.join(lowest.mapInArrow(to_groups, f"before long, {_WAY}"), "before").drop("before", "one"), "group-ways")
    text_root = root.hex()

    def to_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, slots, sub, s, t in zip(*[b.column(c).to_pylist() for c in ("block", "slots", "subroot", "siblings", "steps")]):
                tower = climb([x["node"].hex().encode() for x in slots], block == 0, size, levels)
                got = ways(tower, s, t)
                folded = [fold(x["copy"].hex().encode(), *w).decode() for x, w in zip(slots, got)]
                cols = [[x["id"] for x in slots], [n.decode() for n in tower[0]], [sub.hex()] * len(slots), [text_root] * len(slots),
                        [digest(w[0]).decode() for w in got], folded, [f == text_root for f in folded]]
                if proofs:
                    cols += [[w[0].decode() for w in got], [w[1] for w in got]]
                yield pa.RecordBatch.from_arrays([_column(c, k) for c, k in zip(
                    cols, [pa.int64(), *[pa.string()] * 5, pa.bool_(), pa.string(), pa.binary()])], names=schema.names)

    return _down(rounds, of_groups, levels, "blocks").mapInArrow(to_rows, schema)
