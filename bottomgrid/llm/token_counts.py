"""Token counts of a byte-level BPE vocabulary by rank-synchronous merging.

The distinct pre-tokens of a batch are held as one ragged numpy array. In each
round every pre-token finds its own lowest-ranked adjacent pair and all of
them merge theirs at once; pre-tokens without a mergeable pair are done, and
the symbols that survive are the tokens. Only counts come back, weighted by
how often each text holds each pre-token. A pre-token falls apart between two
symbols that no token of the vocabulary holds side by side, and its parts merge
side by side as well: a line without spaces takes the rounds of its longest
part, not of its length.

Special strings of the vocabulary inside a text count as one token each, as
the library does by default. Null and empty texts have 0 bytes and 0 tokens.
Rows are independent: repeated rows agree, an empty table stays empty, and
input columns with the names of the results are replaced.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_from_text

# The pre-tokeniser of the byte-level vocabulary, and the
# printable stand-ins for bytes in its file.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

_BITS = 22
_MAX = np.int64(1) << 40


class MergeTables:
    """Merge ranks as sorted arrays; the size is fixed by the vocabulary."""

    def __init__(self, tokenizer_file: str):
        with open(tokenizer_file, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or spec.get("normalizer") or pre.get("add_prefix_space"):
            raise ValueError("a byte-level BPE tokenizer file without prefix space or normalizer is needed")
        vocab = model["vocab"]
        others = [b for b in range(256) if b not in set(PRINTABLE)]
        char = {b: chr(b) for b in PRINTABLE} | {b: chr(256 + k) for k, b in enumerate(others)}
        self.byte = np.array([vocab[char[b]] for b in range(256)], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        rank = {vocab[a] << 24 | vocab[b]: k for k, (a, b) in enumerate(merges)}
        # pairs inside some token, which may come to lie in one even where they
        # do not merge themselves
        inside = {w[i:j] for w in vocab for i in range(len(w)) for j in range(i + 2, len(w) + 1)}
        near = {vocab[w[:k]] << 24 | vocab[w[k:]] for w in inside for k in range(1, len(w)) if w[:k] in vocab and w[k:] in vocab}
        keys = np.array(sorted(near | rank.keys()), np.int64)
        self.key, self.rank = keys, np.array([rank.get(k, _MAX) for k in keys.tolist()], np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[_slot(self.key)] = True
        self.special = [t["content"] for t in spec.get("added_tokens", [])]

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair; ``_MAX`` of one that does not merge, more where
        no token holds the two symbols."""
        key = a << 24 | b
        out = np.full(len(key), _MAX + 1)
        rows = np.flatnonzero(self.maybe[_slot(key)])
        at = np.minimum(np.searchsorted(self.key, key[rows]), len(self.key) - 1)
        hit = self.key[at] == key[rows]
        out[rows[hit]] = self.rank[at[hit]]
        return out


def _slot(key: np.ndarray) -> np.ndarray:
    return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BITS)).astype(np.int64)


@functools.lru_cache(maxsize=4)
def tables(tokenizer_file: str) -> MergeTables:
    return MergeTables(tokenizer_file)


def merge_counts(t: MergeTables, tokens: list[bytes]) -> np.ndarray:
    """Number of symbols of each pre-token after all merges."""
    size = np.array([len(x) for x in tokens], np.int64)
    counts = np.zeros(len(tokens), np.int64)
    sym = t.byte[np.frombuffer(b"".join(tokens), np.uint8)]
    row = np.repeat(np.arange(len(tokens)), size)
    end = np.ones(len(sym), bool)  # the last symbol of a part
    end[:-1] = row[:-1] != row[1:]
    rank = np.empty(len(sym), np.int64)
    _rank_at(t, sym, end, rank, np.arange(len(sym)))
    while len(sym):
        starts = np.flatnonzero(np.concatenate(([True], end[:-1])))
        here = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(sym))))
        live = here < _MAX
        if not live.all():  # finished parts leave
            counts += np.bincount(row[~live], minlength=len(counts))
            sym, row, end, rank, here = sym[live], row[live], end[live], rank[live], here[live]
            if not len(sym):
                break
        at = np.flatnonzero(rank == here)
        # of overlapping occurrences (a a a) every second one merges
        run = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))) % 2 == 0]
        sym[at] = t.made[rank[at]]
        end[at] = end[at + 1]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        # pairs that hold a merged symbol get a new rank
        stale = np.zeros(len(sym), bool)
        stale[at] = True
        stale[at[at > 0] - 1] = True
        two = at[at > 1] - 2
        stale[two[~keep[two + 1]]] = True
        sym, row, end, rank, stale = sym[keep], row[keep], end[keep], rank[keep], np.flatnonzero(stale[keep])
        _rank_at(t, sym, end, rank, stale)
    return counts


def _rank_at(t: MergeTables, sym: np.ndarray, end: np.ndarray, rank: np.ndarray, at: np.ndarray) -> None:
    """Sets the rank of the pair that starts at each position. Where no token
    can come to hold both symbols, the part ends."""
    rank[at] = _MAX
    at = at[~end[at]]
    got = t.ranks(sym[at], sym[at + 1])
    rank[at] = np.minimum(got, _MAX)
    end[at[got > _MAX]] = True


class Counter:
    """Counts tokens of text lists; splitter patterns compile once a task."""

    def __init__(self, t: MergeTables):
        self.t = t
        self.pre = regex.compile(PRE_TOKEN)
        special = sorted((s for s in t.special if s), key=len, reverse=True)
        self.split = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.special = special

    def __call__(self, texts: list[str]) -> tuple[list[int], np.ndarray]:
        seen: dict[str, int] = {}
        index: list[int] = []
        number = np.zeros(len(texts), np.int64)
        fixed = np.zeros(len(texts), np.int64)
        put = seen.setdefault
        for k, x in enumerate(texts):
            parts = [x]
            if any(s in x for s in self.special):
                parts = self.split.split(x)
                fixed[k] = len(parts) - 1
            for p in parts:
                got = self.pre.findall(p)
                index += [put(w, len(seen)) for w in got]
                number[k] += len(got)
        n_bytes = [len(x.encode("utf-8", "surrogatepass")) for x in texts]
        if not seen:
            return n_bytes, fixed
        counts = merge_counts(self.t, [w.encode("utf-8", "surrogatepass") for w in seen])
        total = np.concatenate(([0], np.cumsum(counts[np.array(index)])))
        stop = np.cumsum(number)
        return n_bytes, total[stop] - total[stop - number] + fixed


def token_counts(df: DataFrame, tokenizer_file: str, text_col: str = "text",
                 bytes_col: str = "n_bytes", tokens_col: str = "n_tokens") -> DataFrame:
    """``df`` plus the UTF-8 bytes and the tokens of each text."""
    tab = df.sparkSession.sparkContext.broadcast(tables(tokenizer_file))
    schema = T.StructType([T.StructField(bytes_col, T.LongType()), T.StructField(tokens_col, T.LongType())])
    state: dict[str, Counter] = {}

    def run(texts: list[str]) -> dict:
        if "counter" not in state:
            state["counter"] = Counter(tab.value)
        n_bytes, n_tokens = state["counter"](texts)
        return {bytes_col: n_bytes, tokens_col: n_tokens}

    return add_from_text(df, text_col, schema, run)


def over_limit(df: DataFrame, limit: int, tokens_col: str = "n_tokens", out_col: str = "over_limit") -> DataFrame:
    """``df`` plus whether a text has more than ``limit`` tokens."""
    return df.withColumn(out_col, F.col(tokens_col) > F.lit(limit))
