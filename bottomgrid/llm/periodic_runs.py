"""Periodic runs of words, found by multi-scale minimizers.

A run is a stretch of words with smallest period q (words q apart are
identical), at least ``MIN_LENGTH`` words and four periods long, that no
neighbouring word extends. The texts of a slice are one sequence of word
numbers with a separator of its own after each text, so nothing crosses texts.

* Periods below ``SHORT`` come from direct lag scans: stretches where the
  sequence equals itself p words on.
* Periods in [B, 2B), for B = 8, 16, 32, ..., come from minimizers. Every
  stretch of B words has a hash; a position is a minimum if its hash is the
  least of the w = B/2 positions from it on, and a head if no minimum of the
  same hash lies in the w positions before. Two heads of equal hash at a
  distance d in [B, 2B) are a seed: the stretch with lag d around them is
  followed to both ends on the words themselves.

No run is missed. Inside a run of period p the hashes repeat after p words, so
the least of them is a minimum at the same place of every period. Not all its
places can follow each other within w: the B words there would have a period
of at most w <= B/2, the same all along, which would be a period of the run
less than p. So each period has a head; those of the second and the third lie
p apart, and all that decides about them lies within four periods. Heads of one
hash are more than w apart, so a head has three partners at most: seeds are
linear in the words, even where a text is one long repetition.

A stretch with several periods is found for more than one of them; the least
counts. Words are equal as bytes, with upper and lower case told apart.

Null, empty and white texts have no words and no run, and collapse to the
empty string. Rows are independent: repeated rows agree, an empty table stays
empty, and input columns with the names of the results are replaced. Texts are
never cut; one text is the unit of work, in time linear in its words per scale.
"""

from __future__ import annotations

from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import add_from_text, list_array, mix

MIN_LENGTH = 6
REPEATS = 4  # periods of a run, at least; the argument above needs four
SHORT = 8
_STEP = np.uint64(0x9E3779B97F4A7C15)

RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the stretches of true values."""
    edge = np.diff(np.concatenate(([False], same, [False])).view(np.int8))
    start = np.flatnonzero(edge == 1)
    return start, np.flatnonzero(edge == -1) - start


def _joined(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of stretches of 2k words from those of k words. Stretches that
    pass the end of the sequence get hashes that nothing else has."""
    after = np.empty_like(h)
    after[:len(h) - k] = h[k:]
    after[len(h) - k:] = mix(np.arange(k, dtype=np.uint64) + np.uint64(len(h)))[:len(h)]
    return mix(h * _STEP + after)


def _seeds(h: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of pairs of heads, distances in [b, 2b)."""
    w = b // 2
    least, k = h, 1
    while k < w:
        least = np.minimum(least[:-k], least[k:])
        k *= 2
    at = np.flatnonzero(h[:len(least)] == least)
    order = np.argsort(h[at], kind="stable")
    at, key = at[order], h[at][order]
    head = np.ones(len(at), bool)
    head[1:] = (key[1:] != key[:-1]) | (at[1:] - at[:-1] > w)
    at, key = at[head], key[head]
    xs, ds = [], []
    for k in range(1, 4):
        d = at[k:] - at[:-k]
        ok = (key[k:] == key[:-k]) & (d >= b) & (d < 2 * b)
        xs.append(at[:-k][ok])
        ds.append(d[ok])
    return np.concatenate(xs), np.concatenate(ds)


def _reach(seq: np.ndarray, x: int, d: int, step: int) -> int:
    """How many positions from x on (step 1) or before x (step -1) equal the
    ones d later."""
    n, size = 0, 64
    while True:
        if step > 0:
            a, b = x + n, min(x + n + size, len(seq) - d)
        else:
            a, b = max(x - n - size, 0), x - n
        if a >= b:
            return n
        other = seq[a:b] != seq[a + d:b + d]
        if step < 0:
            other = other[::-1]
        k = int(other.argmax())
        if other[k]:
            return n + k
        n += b - a
        size = min(2 * size, 1 << 16)


def find_runs(seq: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and periods of all runs of a sequence, by start and
    period. ``room`` has the words of the text of each position; every text
    ends with a number that occurs once."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for p in range(1, min(SHORT, len(seq))):
        start, m = _stretches(seq[:-p] == seq[p:])
        ok = m >= max((REPEATS - 1) * p, MIN_LENGTH - p)
        found.append((start[ok], m[ok] + p, np.full(ok.sum(), p)))
    at = np.arange(len(seq))
    h, k, b = mix(seq), 1, SHORT
    part = seq
    while True:
        keep = room >= REPEATS * b  # only texts that can hold such a run
        if not keep.any():
            break
        if not keep.all():
            part, at, h, room = part[keep], at[keep], h[keep], room[keep]
        while k < b:
            h = _joined(h, k)
            k *= 2
        x, d = _seeds(h, b)
        order = np.lexsort((x, d))
        lag, end, out = 0, 0, []
        for x, d in zip(x[order].tolist(), d[order].tolist()):
            if d == lag and x < end:
                continue  # in the stretch that was followed last
            right = _reach(part, x, d, 1)
            left = _reach(part, x, d, -1) if right else 0
            lag, end = d, x + max(right, 1)
            if left + right >= (REPEATS - 1) * d:
                out.append((at[x - left], left + right + d, d))
        if out:
            found.append(tuple(np.array(out, np.int64).T))
        b *= 2
    if not found:
        return (np.empty(0, np.int64),) * 3
    start, length, period = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[first], length[first], period[first]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def runs_and_rest(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Words of each text; number of runs of each text; starts, lengths and
    periods of the runs; and the kept words of each text, joined by a space."""
    words = [x.encode("utf-8", "surrogatepass").split() for x in texts]  # at ASCII white space
    n = np.array([len(w) for w in words], np.int64)
    seen: dict[bytes, int] = {}
    put = seen.setdefault
    ids = np.fromiter((put(w, len(seen)) for w in chain.from_iterable(words)), np.int64, int(n.sum()))
    first = np.cumsum(n + 1) - (n + 1)
    seq = np.empty(len(ids) + len(texts), np.int64)
    seq[first + n] = -1 - np.arange(len(texts))
    inside = np.ones(len(seq), bool)
    inside[first + n] = False
    seq[inside] = ids
    start, length, period = find_runs(seq, np.repeat(n, n + 1))
    text = np.searchsorted(first, start, "right") - 1
    number = np.bincount(text, minlength=len(texts))
    change = np.zeros(len(seq) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    keep = np.cumsum(change) == 0
    rest = [b" ".join(compress(w, keep[a:a + len(w)].tolist()) if r else w)
            for w, a, r in zip(words, first.tolist(), number.tolist())]
    return n, number, start - first[text], length, period, rest


def periodic_runs(df: DataFrame, text_col: str = "text", runs_col: str = "runs", words_col: str = "n_words",
                  collapsed_col: str = "collapsed") -> DataFrame:
    """``df`` plus the words of each text, its runs (start and length in words
    and period; by start, then period), and the text with of every run only
    the first period left (words joined by one space)."""
    schema = T.StructType([T.StructField(words_col, T.LongType()), T.StructField(runs_col, T.ArrayType(RUN, False)),
                           T.StructField(collapsed_col, T.StringType())])

    def run(texts: list[str]) -> dict:
        n, number, start, length, period, rest = runs_and_rest(texts)
        triples = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (start, length, period)], names=RUN.names)
        return {words_col: n, runs_col: list_array(triples, number),
                collapsed_col: pa.array(rest, pa.binary()).cast(pa.string())}

    return add_from_text(df, text_col, schema, run)
