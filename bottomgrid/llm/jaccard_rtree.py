"""N-gram Jaccard join with R-trees over count vectors.

Texts are sets of distinct 5-word shingles (64-bit hashes). A set's count
vector says how many of its shingles fall into each of ``GROUPS`` hash groups;
the summed coordinate minima of two vectors bound the overlap of the sets from
above, and the same sum over two bounding boxes bounds every pair below them.
R-trees over these points are joined by that bound. What survives is bounded
once more by vectors whose groups grow with the set (four groups a shingle, up
to ``FINE`` of them), which see through nearly all pairs that fall just short;
the rest is verified on the sets themselves.

One R-tree over the corpus would have to compare almost all of its leaves, as
bounding boxes of 256 coordinates overlap. So the trees grow per key, and the
keys lose no pair: with Jaccard >= 0.8 two sets share at least ceil(0.8 n)
shingles, so in any common order (here: by hash) the first
n - ceil(0.8 n) + l shingles of both hold at least l common ones.

1. One node per distinct set; exact copies are one node however many they are.
2. Prefix shingles with l = n / 10 go by key; keys of one node are dropped,
   and nodes that keep too few keys for any partner are dropped, which leaves
   little more than the nodes that have near copies.
3. Most links: each remaining node goes to the block of its least and of its
   greatest shared key. A block is joined by its R-tree and verified, pairs
   already connected are skipped. A key with many nodes is cut into blocks at
   random, differently for the two keys, so that blocks grow together.
4. The rest, exactly: a key whose nodes are in one component by now is done,
   and so is a node with too few open keys. In the open keys every node outside
   the key's largest component is joined with all nodes of the key, in bounded
   blocks, by R-trees and the finer vectors; pairs of different components with
   enough common keys are verified. Of a node's open keys only the rarer ones
   are needed.

So every pair of linked texts ends in the same component, and no step emits
the pairs of a group of copies, or those of a family of near misses. A key that
very many nodes share is found by a global count and its rows are salted; the
count looks at one distinct text in ``COUNTED`` (by hash) and only decides where
rows are dealt. Shingles are 64-bit hashes. Nodes are too, and every node keeps a
second hash of its set: should two sets meet in one node, all nodes are hashed
anew. Nothing is sampled or capped. All tables made on the way are removed.

Nulls, empty texts and texts of white space have no shingles and are linked
with nothing; texts of fewer than five words are one shingle. Repeated rows
are copies of each other. An empty table stays empty. The result has only its
own columns, whatever the input's are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WHITE, add_from_text, as_table, fresh, give_back, last_table, mix, slices, text_column, word_hashes
from .components import components

SHINGLE = 5
GROUPS = 256
CEILING = 65_535  # of a coordinate
FINE = 4096  # groups of the finer vectors, at most
COUNTED = 64  # of so many distinct texts one takes part in the count of keys
HOT = 64  # counted nodes of one key, from which the key is salted
SALTS = 64
HOT_KEYS = 1_000_000  # hot keys that are broadcast, at most; more are joined
BLOCK = 1000
TEXT_BYTES = 1 << 20  # of the texts that are hashed together, about
BITS = 26  # of the filter that keeps sets of dropped nodes out of the shuffle
MAIN, LEFT, OTHER = 0, 1, 2  # sides of a block: a key's main component, the others, the others again
_STEP = [np.uint64(int(pow(0xD1342543DE82EF95, k + 1, 2**64))) for k in range(SHINGLE)]


# --- sets ------------------------------------------------------------------

_NODE, _CHECK = 0xA0761D6478BD642F, 0xE7037ED1A0B428DB
_ODD = 0x9E3779B97F4A7C15


def shingle_sets(texts: list[str], salt: int = _NODE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct shingles of all texts in order, the size of each set,
    and the node (a hash of the set)."""
    words, counts = word_hashes(texts, WHITE)
    start = np.cumsum(counts) - counts
    windows = np.where(counts >= SHINGLE, counts - SHINGLE + 1, (counts > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(texts)), windows)
    first = start[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(windows) - windows, windows)
    h = np.zeros(len(doc), np.uint64)
    length = np.minimum(counts, SHINGLE)[doc]
    for k in range(SHINGLE):
        inside = length > k
        if inside.all():
            h += words[first + k] * _STEP[k]
        else:
            h[inside] += words[first[inside] + k] * _STEP[k]
    h = mix(h + length.astype(np.uint64))
    ends = np.cumsum(windows)
    for a, b in zip(ends - windows, ends):
        if b - a > 1:
            h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, size = h[new], np.bincount(doc[new], minlength=len(texts))
    return h, size, set_hashes(h, size, salt)


def set_hashes(h: np.ndarray, size: np.ndarray, salt: int) -> np.ndarray:
    """A hash of each set, whatever the order of its shingles."""
    node = np.zeros(len(size), np.uint64)
    some = size > 0
    if some.any():
        node[some] = np.add.reduceat(mix(h ^ np.uint64(salt)), (np.cumsum(size) - size)[some])
    return mix(node + size.astype(np.uint64)).view(np.int64)


def needed(n: np.ndarray) -> np.ndarray:
    """Least overlap of a set of n shingles with any partner."""
    return (4 * n + 4) // 5


def prefix_length(n: np.ndarray) -> np.ndarray:
    return n - needed(n) + np.minimum((n + 9) // 10, needed(n))


def least_shared(n):
    """Prefix keys that a node shares with any partner, at least (columns too)."""
    need = F.floor((n * 4 + 4) / 5)
    return F.floor((need + 9) / 10)


def _texts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    give_back()
    for b in batches:
        at = 0
        for texts in slices(b.column(column), TEXT_BYTES):
            yield b.slice(at, len(texts)), texts
            at += len(texts)
    give_back()


def _members(batches: Iterator[pa.RecordBatch], salt: int) -> Iterator[pa.RecordBatch]:
    for b, texts in _texts(batches, "text"):
        h, size, node = shingle_sets(texts, salt)
        yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(node), pa.array(size.astype(np.int64)),
                                          pa.array(set_hashes(h, size, _CHECK))], names=["id", "node", "n", "again"])


def _new_nodes(node: np.ndarray, size: np.ndarray, seen: set[int]) -> np.ndarray:
    """Which texts bring a node that this task has not had yet."""
    keep = np.zeros(len(node), bool)
    for k, (x, n) in enumerate(zip(node.tolist(), size.tolist())):
        if n and x not in seen:
            seen.add(x)
            keep[k] = True
    return keep


def _keys(batches: Iterator[pa.RecordBatch], salt: int) -> Iterator[pa.RecordBatch]:
    """(key, node) of every prefix shingle, once per task and node."""
    seen: set[int] = set()
    for _, texts in _texts(batches, "text"):
        h, size, node = shingle_sets(texts, salt)
        keep = _new_nodes(node, size, seen)
        doc = np.repeat(np.arange(len(size)), size)
        rank = np.arange(len(h)) - np.repeat(np.cumsum(size) - size, size)
        own = keep[doc] & (rank < prefix_length(size)[doc])
        yield pa.RecordBatch.from_arrays([pa.array(h[own].view(np.int64)), pa.array(node[doc[own]])], names=["key", "node"])


def _groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that are sorted by ``by``."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        change = np.zeros(b.num_rows, bool)
        for c in by:
            v = b.column(c).to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
            if held:
                change[0] |= held[-1].column(c)[-1].as_py() != v[0]
        at = np.flatnonzero(change)
        if len(at):
            if held or at[-1]:
                yield pa.Table.from_batches([*held, b.slice(0, int(at[-1]))])
            held = [b.slice(int(at[-1]))]
        else:
            held.append(b)
    if held:
        yield pa.Table.from_batches(held)
    del held
    give_back()


def _starts(t: pa.Table, by: list[str]) -> np.ndarray:
    change = np.zeros(t.num_rows, bool)
    change[:1] = True
    for c in by:
        v = t.column(c).to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(change)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node) without repeats, of keys that more than one node has; the
    rows of a salted key are known to. The rows come sorted by key alone (one
    long, which sorts fastest); most keys have one row and go at once, the
    others are sorted here."""
    for t in _groups(batches, ["key"]):
        key, salt, node = (t.column(c).to_numpy() for c in ("key", "salt", "node"))
        at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        count = np.diff(np.append(at, len(key)))
        some = np.flatnonzero((np.repeat(count, count) > 1) | (salt > 0))
        some = some[np.lexsort((node[some], salt[some], key[some]))]
        key, salt, node = key[some], salt[some], node[some]
        first = np.ones(len(key), bool)
        first[1:] = (key[1:] != key[:-1]) | (salt[1:] != salt[:-1]) | (node[1:] != node[:-1])
        key, salt, node = key[first], salt[first], node[first]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])
        at = np.flatnonzero(new)
        count = np.diff(np.append(at, len(key)))
        keep = (np.repeat(count, count) > 1) | (salt > 0)
        yield pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(node[keep])], names=["key", "node"])


def _sets(batches: Iterator[pa.RecordBatch], salt: int) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()
    for _, texts in _texts(batches, "text"):
        h, size, node = shingle_sets(texts, salt)
        keep = _new_nodes(node, size, seen)
        data, at = h.tobytes(), np.cumsum(size) - size
        rows = np.flatnonzero(keep)
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[rows]), pa.array(size[rows].astype(np.int64)),
             pa.array([data[8 * at[r]:8 * (at[r] + size[r])] for r in rows], pa.binary())],
            names=["node", "n", "hashes"])


# --- R-trees ---------------------------------------------------------------

def count_vector(hashes: np.ndarray) -> np.ndarray:
    """How many hashes fall into each group."""
    counts = np.bincount((hashes >> np.uint64(40)).astype(np.int64) % GROUPS, minlength=GROUPS)
    return np.minimum(counts, CEILING).astype(np.uint16)


def groups_of(n: np.ndarray) -> np.ndarray:
    """Groups of the finer vector of sets of n shingles: four for each, as a
    power of two; sets that would need more than ``FINE`` have none (0)."""
    n = np.asarray(n)
    g = np.maximum(GROUPS, 1 << np.ceil(np.log2(np.maximum(4 * n, 1))).astype(np.int64))
    return np.where(g > FINE, 0, g)


def packed_vector(hashes: np.ndarray) -> bytes:
    """The finer count vector with two bits a group (3 says 3 or more), or
    the plain one of a set that is too large for it."""
    g = int(groups_of(len(hashes)))
    if not g:
        return count_vector(hashes).tobytes()
    counts = np.bincount((hashes >> np.uint64(40)).astype(np.int64) % g, minlength=g)
    four = np.minimum(counts, 3).astype(np.uint8).reshape(-1, 4)
    return (four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).tobytes()


class Vectors:
    """Count vectors of some sets, decoded. ``points`` has them in ``GROUPS``
    groups (a finer one folds into fewer groups by summing); ``slack`` is how
    many shingles of a set the two bits of its groups leave out."""

    def __init__(self, packed: list[bytes], n: np.ndarray):
        self.groups = groups_of(n)
        self.points = np.zeros((len(packed), GROUPS), np.uint16)
        self.slack = np.zeros(len(packed), np.int64)
        self.fine: dict[int, np.ndarray] = {}
        self.row = np.zeros(len(packed), np.int64)
        for g in np.unique(self.groups).tolist():
            rows = np.flatnonzero(self.groups == g)
            data = np.frombuffer(b"".join(packed[k] for k in rows), np.uint8 if g else np.uint16).reshape(len(rows), -1)
            if not g:
                self.points[rows] = data
                continue
            counts = ((data[:, :, None] >> np.array([0, 2, 4, 6], np.uint8)) & 3).reshape(len(rows), g)
            self.fine[g], self.row[rows] = counts, np.arange(len(rows))
            self.points[rows] = counts.reshape(len(rows), -1, GROUPS).sum(1)
            self.slack[rows] = n[rows] - counts.sum(1, dtype=np.int64)

    def overlap(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bounds of the overlaps of pairs, by the finer vectors where both
        sets have one (in the fewer groups of the two)."""
        out = np.minimum(self.points[a], self.points[b]).sum(1, dtype=np.int64)
        for ga in self.fine:
            for gb in self.fine:
                here = np.flatnonzero((self.groups[a] == ga) & (self.groups[b] == gb))
                g = min(ga, gb)
                for k in range(0, len(here), 2048):
                    at = here[k:k + 2048]
                    x, y = (self.fine[h][self.row[i[at]]].reshape(len(at), -1, g).sum(1, dtype=np.uint8) for h, i in ((ga, a), (gb, b)))
                    out[at] = np.minimum(x, y).sum(1, dtype=np.int64)
        return out + self.slack[a] + self.slack[b]


def may_link(bound: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard >= 0.8 for sizes a, b and an overlap of at most ``bound``; sets
    that may hold more in one group than a coordinate can say always may."""
    return (9 * bound >= 4 * (a + b)) | (np.maximum(a, b) > CEILING)


class CountRTree:
    """Points packed by sort-tile-recursive order: by size, then by the
    coordinate that varies most. A box keeps the coordinate maxima and the
    range of sizes of what is below it, which is all that the bound needs."""

    LEAF, FAN = 16, 8

    def __init__(self, points: np.ndarray, sizes: np.ndarray, slack: int = 0):
        m = len(points)
        self.slack = slack  # what any point's coordinates may leave out
        order = np.argsort(sizes, kind="stable")
        slab = self.LEAF * max(1, int(np.ceil(np.sqrt(m / self.LEAF))))
        for a in range(0, m, slab):
            part = order[a:a + slab]
            axis = int(np.argmax(points[part].var(0))) if len(part) > 1 else 0
            order[a:a + slab] = part[np.argsort(points[part, axis], kind="stable")]
        self.order = order
        high, low, top = points[order], sizes[order].astype(np.int64), sizes[order].astype(np.int64)
        self.levels = [(high, low, top)]  # level 0: the points
        for fan in (self.LEAF, *[self.FAN] * 40):
            if len(self.levels) > 1 and len(high) == 1:
                break
            cut = np.arange(0, len(high), fan)
            high, low, top = (np.maximum.reduceat(high, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(top, cut))
            self.levels.append((high, low, top))

    def fan(self, level: int) -> int:
        return self.LEAF if level == 1 else self.FAN

    def join(self, other: CountRTree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of points (of self, of other) whose bound allows a link, and
        the bound's surplus."""
        la, lb = len(self.levels) - 1, len(other.levels) - 1
        out: list[tuple[np.ndarray, ...]] = []
        stack = [(la, lb, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            la, lb, a, b = stack.pop()
            if len(a) > 2048:
                for k in range(0, len(a), 2048):
                    stack.append((la, lb, a[k:k + 2048], b[k:k + 2048]))
                continue
            (ha, na, ta), (hb, nb, tb) = self.levels[la], other.levels[lb]
            ok = (5 * ta[a] >= 4 * nb[b]) & (5 * tb[b] >= 4 * na[a])
            a, b = a[ok], b[ok]
            bound = np.minimum(ha[a], hb[b]).sum(1, dtype=np.int64) + self.slack + other.slack
            ok = may_link(bound, na[a], nb[b])
            a, b, bound = a[ok], b[ok], bound[ok]
            if not len(a):
                continue
            if la == 0 and lb == 0:
                out.append((self.order[a], other.order[b], 9 * bound - 4 * (na[a] + nb[b])))
            elif la >= lb:
                f = self.fan(la)
                down = (a[:, None] * f + np.arange(f)).ravel()
                b = np.repeat(b, f)
                ok = down < len(self.levels[la - 1][0])
                stack.append((la - 1, lb, down[ok], b[ok]))
            else:
                f = other.fan(lb)
                down = (b[:, None] * f + np.arange(f)).ravel()
                a = np.repeat(a, f)
                ok = down < len(other.levels[lb - 1][0])
                stack.append((la, lb - 1, a[ok], down[ok]))
        if not out:
            none = np.empty(0, np.int64)
            return none, none, none
        return tuple(np.concatenate(x) for x in zip(*out))


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets have 100 * intersection >= 80 * union."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 80 * (len(a) + len(b) - both)


def join_block(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect what the sets' links connect (a spanning forest)."""
    if len(sets) < 2:
        return []
    tree = CountRTree(np.stack([count_vector(s) for s in sets]), np.array([len(s) for s in sets]))
    i, j, surplus = tree.join(tree)
    own = i < j
    i, j = i[own], j[own]
    order = np.argsort(-surplus[own], kind="stable")
    root = list(range(len(sets)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links, parts = [], len(sets)
    for a, b in zip(i[order].tolist(), j[order].tolist()):
        ra, rb = find(a), find(b)
        if ra != rb and linked(sets[a], sets[b]):
            root[max(ra, rb)] = min(ra, rb)
            links.append((a, b))
            parts -= 1
            if parts == 1:
                break
    return links


def _links_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside blocks (home, salt) of (node, hashes)."""
    for t in _groups(batches, ["home", "salt"]):
        t = t.combine_chunks()
        node = t.column("node").to_numpy()
        hashes = t.column("hashes")
        starts = _starts(t, ["home", "salt"])
        a_out, b_out = [], []
        for a, b in zip(starts, np.append(starts[1:], t.num_rows)):
            if b - a > 1:
                sets = [np.frombuffer(hashes[k].as_py(), np.uint64) for k in range(a, b)]
                for i, j in join_block(sets):
                    a_out.append(node[a + i])
                    b_out.append(node[a + j])
        yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"])


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        vec = [packed_vector(np.frombuffer(x.as_py(), np.uint64)) for x in b.column("hashes")]
        yield pa.RecordBatch.from_arrays([b.column("node"), b.column("n"), pa.array(vec, pa.binary())],
                                         names=["node", "n", "vec"])


def _leaf_pairs(starts: np.ndarray, ends: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every (left, right) pair of row numbers inside each small group, whose
    two sides are single leaves."""
    count = ends - starts
    rows = np.repeat(starts, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    group = np.repeat(np.arange(len(starts)), count)
    lefts, rights = rows[side[rows] == LEFT], rows[side[rows] != LEFT]
    per = np.bincount(group[side[rows] != LEFT], minlength=len(starts))  # right rows of each group
    first = np.cumsum(per) - per
    of = group[side[rows] == LEFT]
    x = np.repeat(lefts, per[of])
    at = np.repeat(first[of], per[of]) + np.arange(len(x)) - np.repeat(np.cumsum(per[of]) - per[of], per[of])
    return x, rights[at]


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of nodes of different components that the R-trees of a block's
    two sides and then the finer vectors let through, and how many of the keys
    seen here have them. Of two nodes outside the key's main component only
    one order counts."""
    by = ["key", "i", "j"]
    for t in _groups(batches, by):
        t = t.combine_chunks()
        node, comp, n, side = (t.column(c).to_numpy() for c in ("node", "component", "n", "side"))
        vectors = Vectors(t.column("vec").to_pylist(), n)
        vec, slack = vectors.points, vectors.slack
        starts = _starts(t, by)
        ends = np.append(starts[1:], t.num_rows)
        small = ends - starts <= 2 * CountRTree.LEAF
        xs, ys = [], []

        def keep(x, y):
            ok = (comp[x] != comp[y]) & ((side[y] == MAIN) | (node[x] < node[y]))
            ok &= (5 * n[x] >= 4 * n[y]) & (5 * n[y] >= 4 * n[x])
            return x[ok], y[ok]

        x, y = keep(*_leaf_pairs(starts[small], ends[small], side))
        for k in range(0, len(x), 1 << 14):
            a, b = x[k:k + (1 << 14)], y[k:k + (1 << 14)]
            ok = may_link(np.minimum(vec[a], vec[b]).sum(1, dtype=np.int64) + slack[a] + slack[b], n[a], n[b])
            xs.append(a[ok])
            ys.append(b[ok])
        for a, b in zip(starts[~small], ends[~small]):
            li, ri = a + np.flatnonzero(side[a:b] == LEFT), a + np.flatnonzero(side[a:b] != LEFT)
            if len(li) and len(ri):
                x, y, _ = CountRTree(vec[li], n[li], int(slack[li].max())).join(CountRTree(vec[ri], n[ri], int(slack[ri].max())))
                x, y = keep(li[x], ri[y])
                xs.append(x)
                ys.append(y)
        x, y = np.concatenate(xs or [np.empty(0, np.int64)]), np.concatenate(ys or [np.empty(0, np.int64)])
        fine = may_link(vectors.overlap(x, y), n[x], n[y])
        x, y = x[fine], y[fine]
        pairs, times = np.unique(np.column_stack([np.minimum(node[x], node[y]), np.maximum(node[x], node[y])]),
                                 axis=0, return_counts=True) if len(x) else (np.empty((0, 2), np.int64), np.empty(0, np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(times.astype(np.int64))],
                                         names=["a", "b", "c"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keep = [linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64))
                for x, y in zip(b.column("ha"), b.column("hb"))]
        yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


# --- the join --------------------------------------------------------------

def _only_these(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """``sets`` of (almost) only ``nodes``: a bitmap of 2**26 bits, 8 MB as a
    table whatever the corpus, meets each set before the shuffle. False hits
    pass; the join with the distinct ``nodes`` after it is exact. (It is an
    inner join, as the optimizer would move a semi-join before the filter.)"""
    def bit(c):
        return F.expr(f"pmod(xxhash64({c}), {1 << BITS})")

    maps = nodes.select(bit("node").alias("p")).groupBy(F.expr("p div 32768").alias("m")).agg(
        F.bitmap_construct_agg(F.expr("p % 32768")).alias("bits"))
    out = sets.withColumn("p", bit("node")).withColumn("m", F.expr("p div 32768")).join(F.broadcast(maps), "m")
    byte = F.conv(F.hex(F.expr("substring(bits, CAST((p % 32768) div 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    out = out.where(byte.bitwiseAND(F.expr("shiftleft(1, CAST(p % 8 AS INT))")) != 0).drop("p", "m", "bits")
    return out.join(nodes.select("node").distinct(), "node").dropDuplicates(["node"])


def _shared_keys(docs: DataFrame, salt: int) -> DataFrame:
    """(key, node) of keys that more than one node has. The rows of hot keys
    are salted: keys are counted over one distinct text in ``COUNTED``."""
    def keys(texts: DataFrame) -> DataFrame:
        return texts.select("text").mapInArrow(lambda it: _keys(it, salt), "key long, node long")

    counted = keys(docs.where(F.expr(f"pmod(xxhash64(text), {COUNTED})") == 0)).distinct()
    hot = as_table(counted.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") >= HOT).select("key"), "hot-keys")
    n = hot.count()
    rows = keys(docs)
    if n:
        hot = hot.withColumn("hot", F.lit(True))
        rows = rows.join(F.broadcast(hot) if n <= HOT_KEYS else hot, "key", "left")
        rows = rows.select("key", F.when(F.col("hot"), F.expr(f"CAST(1 + pmod(xxhash64(node), {SALTS}) AS INT)")).otherwise(0).alias("salt"), "node")
    else:
        rows = rows.select("key", F.lit(0).alias("salt"), "node")
    return (rows.repartition("key", "salt").sortWithinPartitions("key")
            .mapInArrow(_shared, "key long, node long"))


def _first_links(rows: DataFrame, sets: DataFrame, block: int) -> DataFrame:
    homes = rows.groupBy("node").agg(F.min("key").alias("k0"), F.max("key").alias("k1"))
    homes = homes.select("node", F.posexplode(F.array("k0", "k1")).alias("which", "home"))
    blocks = as_table(homes.groupBy("home").count().select("home", F.ceil(F.col("count") / block).alias("parts")), "homes")
    placed = (homes.join(blocks, "home")
              .withColumn("salt", F.expr("pmod(xxhash64(node, which), parts)")).select("home", "salt", "node").distinct())
    return (placed.join(sets.select("node", "hashes"), "node")
            .repartition("home", "salt").sortWithinPartitions("home", "salt")
            .mapInArrow(_links_of_blocks, "a long, b long"))


def _still_open(rows: DataFrame, rounds: int = 2) -> DataFrame:
    """Rows (key, node, n, component) that a link between components can
    still need: of keys with more than one component, and of nodes with as
    many such keys as they share with any partner. Dropping some closes
    others, so it is done more than once; each round is a written table. The
    keys are one too: a join of two tables can be split at a key that very
    many nodes have, a join with an aggregate cannot."""
    for _ in range(rounds):
        keys = rows.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
        keys = as_table(keys.where("x <> y").select("key"), "keys")
        rows = as_table(rows.join(keys, "key", "left_semi"), "rows")
        good = rows.groupBy("node").agg(F.count("*").alias("c"), F.max("n").alias("n"))
        rows = rows.join(good.where(F.col("c") >= least_shared(F.col("n"))).select("node"), "node", "left_semi")
    return as_table(rows, "rows")


def _rare_keys(rows: DataFrame) -> DataFrame:
    """The prefix filter once more, on the open keys of each node, now with
    the rarest first: of c open keys, m of which any partner shares, the first
    c - m + s still hold s common ones; s is half of m, so frequent keys
    (passages that many texts have) go and common keys can still be counted.
    Adds ``least``, the s of the node."""
    df = as_table(rows.groupBy("key").agg(F.count("*").alias("df")), "df")
    m = least_shared(F.col("n"))
    s = F.floor((m + 1) / 2)
    own = Window.partitionBy("node")
    ranked = rows.join(df, "key").withColumns({
        "rank": F.row_number().over(own.orderBy("df", "key")), "c": F.count("*").over(own), "least": s})
    return ranked.where(F.col("rank") <= F.col("c") - m + F.col("least")).drop("rank", "c", "df")


def _open_pairs(rows: DataFrame, sets: DataFrame, block: int) -> DataFrame:
    """Candidate pairs (a, b) across components."""
    rows = as_table(_rare_keys(rows), "rare")
    sizes = rows.groupBy("key", "component").count()
    keys = sizes.groupBy("key").agg(F.count("*").alias("parts"), F.sum("count").alias("all"),
                                    F.max(F.struct("count", "component")).alias("main"))
    keys = as_table(keys.where("parts > 1").select(
        "key", F.col("main.component").alias("main"),
        F.ceil((F.col("all") - F.col("main.count")) / block).alias("si"), F.ceil(F.col("all") / block).alias("sj")), "keys")
    rows = as_table(rows.join(keys, "key"), "open")
    vecs = sets.join(rows.select("node").distinct(), "node", "left_semi").mapInArrow(_vectors, "node long, n long, vec binary")
    own = [F.col(c) for c in ("key", "node", "component")]
    left = rows.where("component <> main").select(
        *own, F.expr("pmod(xxhash64(node, 1), si)").alias("i"), F.explode(F.expr("sequence(0L, sj - 1)")).alias("j"),
        F.lit(LEFT).alias("side"))
    right = rows.select(
        *own, F.explode(F.expr("sequence(0L, si - 1)")).alias("i"), F.expr("pmod(xxhash64(node, 2), sj)").alias("j"),
        F.when(F.expr("component = main"), MAIN).otherwise(OTHER).alias("side"))
    pairs = (left.unionByName(right).join(vecs, "node").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
             .mapInArrow(_candidates, "a long, b long, c long").groupBy("a", "b").agg(F.sum("c").alias("c")))
    # as many common keys as the smaller need of the two
    need = rows.groupBy("node").agg(F.max("least").alias("l"))
    return (pairs.join(need.withColumnsRenamed({"node": "a", "l": "la"}), "a")
            .join(need.withColumnsRenamed({"node": "b", "l": "lb"}), "b")
            .where(F.col("c") >= F.least("la", "lb")).select("a", "b"))


def jaccard_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """Per row: id, n_shingles, component_id (the least id that links reach
    from it, itself included), node (its set) and component (of nodes; null
    without shingles)."""
    docs = df.select(F.col(f"`{id_col}`").alias("id"), text_column(df, text_col).alias("text"))
    return last_table(lambda: _groups_of(docs, id_col, block), df.sparkSession, "jaccard-groups")


def _nodes(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Members (id, node, n), classes (node, id, n), and the salt of the node
    hash under which no two different sets met in one node."""
    kind = dict(docs.dtypes)["id"]
    salt = _NODE
    while True:
        own = salt
        members = as_table(docs.mapInArrow(lambda it: _members(it, own), f"id {kind}, node long, n long, again long"), "members")
        classes = members.where("n > 0").groupBy("node").agg(
            F.min("id").alias("id"), F.max("n").alias("n"), F.min("again").alias("x"), F.max("again").alias("y"))
        classes = as_table(classes.select("node", "id", "n", (F.col("x") != F.col("y")).alias("met")), "classes")
        if classes.where("met").isEmpty():
            return members.drop("again"), classes.drop("met"), salt
        salt = (salt + _ODD) % 2**64


def _groups_of(docs: DataFrame, id_col: str, block: int) -> DataFrame:
    members, classes, salt = _nodes(docs)
    shared = as_table(_shared_keys(docs, salt), "shared")
    rows = _still_open(shared.join(classes.select("node", "n"), "node").withColumn("component", F.col("node")))
    sets = docs.select("text").mapInArrow(lambda it: _sets(it, salt), "node long, n long, hashes binary")
    sets = as_table(_only_these(sets, rows.select("node").distinct()), "sets")

    links = as_table(_first_links(rows, sets, block), "links")
    comps = as_table(components(links), "comps")
    left = rows.drop("component").join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    pairs = as_table(_open_pairs(_still_open(as_table(left, "rows")), sets, block), "pairs")
    own = sets.select("node", "hashes")
    more = (pairs.join(own.withColumnsRenamed({"node": "a", "hashes": "ha"}), "a")
            .join(own.withColumnsRenamed({"node": "b", "hashes": "hb"}), "b").mapInArrow(_verify, "a long, b long"))
    of = comps.select(F.col("node").alias("x"), "component")
    more = more.join(of.withColumnsRenamed({"x": "a", "component": "ca"}), "a", "left").join(
        of.withColumnsRenamed({"x": "b", "component": "cb"}), "b", "left")
    more = as_table(more.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).distinct(), "links")
    top = components(more).select(F.col("node").alias("component"), F.col("component").alias("top"))

    of_class = (classes.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
                .join(top, "component", "left").withColumn("component", F.coalesce("top", "component")))
    of_class = as_table(of_class.select("node", "id", "component"), "classes")
    least = of_class.groupBy("component").agg(F.min("id").alias("component_id"))
    of_node = of_class.join(least, "component").select("node", "component", "component_id")
    out = members.join(of_node, "node", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
                      "node", "component")


def keep_one_of_each_group(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with one row of every group of linked texts: the one whose id is
    least (one of them where rows repeat an id). Rows without shingles stay."""
    groups = jaccard_groups(df, id_col, text_col)
    i, node, rows = fresh("id"), fresh("node"), fresh("rows")
    mine = F.col(id_col).eqNullSafe(F.col("component_id"))
    ids = groups.groupBy(F.col(id_col).alias(i)).agg(F.count("*").alias(rows), F.max(mine).alias("stay"))
    ids = as_table(ids.where("stay").select(i, rows), "stay")
    same_id = F.col(f"`{id_col}`").eqNullSafe(F.col(i))
    once = df.join(ids.where(F.col(rows) == 1), same_id).select(*[F.col(f"`{c}`") for c in df.columns])
    again = ids.where(F.col(rows) > 1)
    if again.isEmpty():
        return once
    # rows that share their id: told apart by their sets
    schema = T.StructType([T.StructField(node, T.LongType())])
    part = add_from_text(df.join(again, same_id), text_col, schema, lambda texts: {node: shingle_sets(texts)[2]})
    own = groups.where(mine).select(F.col(id_col).alias("g_id"), F.col("node").alias("g_node"),
                                    F.col("component").alias("g_component")).distinct()
    part = part.join(own, F.col(i).eqNullSafe(F.col("g_id")) & (F.col(node) == F.col("g_node")))
    none = part.where(F.col("g_component").isNull())
    part = part.where(F.col("g_component").isNotNull()).dropDuplicates(["g_component"])
    return once.unionByName(part.unionByName(none).select(*[F.col(f"`{c}`") for c in df.columns]))
