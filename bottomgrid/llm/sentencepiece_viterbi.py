"""SentencePiece encoding and decoding by a batched numpy Viterbi pass.

All words of equal length advance together through their lattices. At each
character the substrings that end there are hashed, probed against the sorted
hashes of the pieces, and the best admissible piece is kept as a backpointer
(a vectorised maximum). A piece is admissible after the best predecessor only
if byte-pair merging would keep the boundary between the two: the model file
is a BPE model, whose result is not the path of highest summed score. With
that condition every prefix has exactly one admissible last piece, and the
path is what the library returns.

A long word without spaces (a line of Japanese, base64, a URL) is cut into
chunks that advance together, and every seam is checked; the ids stay those of
the whole word.

Nulls and empty texts have no tokens and decode to the empty string. Text is
treated row by row, so repeated rows get the same result, an empty table
gives an empty table, and input columns of the same names are replaced.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_from_text, list_array, powers

SPACE = "▁"
# no piece crosses a word start or holds a line break (checked on loading)
_UNIT = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n|[^{SPACE}\n]+")
_P = np.uint64(0xD6E8FEB86659FD93)
_BITS = 20
_NONE = np.int64(1) << 40
TEXT_BYTES = 1 << 20  # of the texts that are encoded together, about


class PieceTables:
    """Sorted lookup tables of a byte-fallback BPE model; their size is fixed
    by the model file (a few MB), whatever the corpus."""

    def __init__(self, model_file: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = sp.get_piece_size()
        piece = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
        self.byte_id = np.full(256, sp.unk_id(), np.int32)
        surface: list[bytes] = []
        for i, s in enumerate(piece):
            if sp.is_byte(i):
                self.byte_id[int(s[3:5], 16)] = i
                surface.append(bytes([int(s[3:5], 16)]))
            else:
                surface.append(b"" if special[i] else s.replace(SPACE, " ").encode())
        self.surface_len = np.array([len(b) for b in surface], np.int64)
        self.chars = np.array([len(s) for s in piece], np.int64)
        self.surface_at = np.cumsum(self.surface_len) - self.surface_len
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        # runs of the space symbol merge after everything else, from the left
        self.runs = {len(s): i for i, s in enumerate(piece) if not special[i] and set(s) == {SPACE}}
        self.run_max = max(self.runs, default=0)
        normal = [i for i in range(n) if not special[i] and (set(piece[i]) != {SPACE} or len(piece[i]) == 1)]
        if any(SPACE in piece[i][1:] or "\n" in piece[i] for i in normal):
            raise ValueError("a piece crosses a word or a line; such models are not supported")
        score = {piece[i]: sp.get_score(i) for i in normal if len(piece[i]) > 1}
        if len(set(score.values())) != len(score):
            raise ValueError("two pieces have the same score; such models are not supported")
        rank = {s: r for r, s in enumerate(sorted(score, key=score.get, reverse=True))}
        self.rank = np.full(n + 1, -1, np.int64)
        self.left = np.arange(n + 1)
        self.right = np.arange(n + 1)
        pid = {piece[i]: i for i in normal}
        pairs, good = {}, []
        for s, i in pid.items():
            if len(s) == 1:
                good.append(i)
                continue
            self.rank[i] = rank[s]
            for k in range(1, len(s)):
                if s[:k] in pid and s[k:] in pid:
                    pairs[pid[s[:k]] << 20 | pid[s[k:]]] = rank[s]
            halves = _last_merge(s, rank)
            if halves and halves[0] in pid and halves[1] in pid:
                self.left[i], self.right[i] = pid[halves[0]], pid[halves[1]]
                good.append(i)
        self.pair_key = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[k] for k in self.pair_key], np.int64)
        self.unknown = n  # a character that is no piece; written as bytes later
        self.max_len = max(len(piece[i]) for i in good)
        codes = [np.array([ord(c) for c in piece[i]], np.uint64) for i in good]
        h = np.array([_hash(c) for c in codes], np.uint64)
        order = np.argsort(h)
        self.hash, self.hash_id = h[order], np.array(good, np.int64)[order]
        self.maybe = np.zeros((self.max_len + 1, 1 << _BITS), bool)
        for c, x in zip(codes, h):
            self.maybe[len(c), int(x) & ((1 << _BITS) - 1)] = True

    def ends_with(self, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose hash is that of a piece of ``length``, and the piece."""
        rows = np.flatnonzero(self.maybe[length][(hashes & np.uint64((1 << _BITS) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hash, hashes[rows]), len(self.hash) - 1)
        hit = self.hash[at] == hashes[rows]
        return rows[hit], self.hash_id[at[hit]]

    def adjacent(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging keeps pieces ``a`` and ``b`` apart: undo their
        merges from the latest to the earliest and see that no pair across
        the boundary would have merged before."""
        codes, inverse = np.unique(a << 20 | b, return_inverse=True)
        a, b = codes >> 20, codes & ((1 << 20) - 1)
        ok = np.zeros(len(codes), bool)
        limit = np.full(len(codes), _NONE)
        live = np.arange(len(codes))
        while len(live):
            key = a[live] << 20 | b[live]
            at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
            across = np.where(self.pair_key[at] == key, self.pair_rank[at], _NONE)
            live = live[across >= limit[live]] if len(self.pair_key) else live
            ra, rb = self.rank[a[live]], self.rank[b[live]]
            done = (ra < 0) & (rb < 0)
            # both are single characters: apart unless they merge at all
            ok[live[done]] = True
            first = (ra > rb) & ~done
            second = ~first & ~done
            i, j = live[first], live[second]
            limit[i] = ra[first]
            a[i] = self.right[a[i]]
            limit[j] = rb[second] + 1
            b[j] = self.left[b[j]]
            live = live[~done]
        return ok[inverse]


def _hash(codes: np.ndarray) -> np.uint64:
    with np.errstate(over="ignore"):
        h = np.uint64(0)
        for c in codes:
            h = h * _P + (c + np.uint64(1)) * np.uint64(0x9FB21C651E98DF25)
        return h


def _last_merge(s: str, rank: dict[str, int]) -> tuple[str, str] | None:
    """The two parts whose merge makes ``s`` whole, None if it never is."""
    parts = list(s)
    while len(parts) > 2:
        best = min(range(len(parts) - 1), key=lambda k: rank.get(parts[k] + parts[k + 1], 1 << 40))
        if parts[best] + parts[best + 1] not in rank:
            return None
        parts[best:best + 2] = [parts[best] + parts[best + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


@functools.lru_cache(maxsize=4)
def tables(model_file: str) -> PieceTables:
    return PieceTables(model_file)


def _states(t: PieceTables, words: np.ndarray, known: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The last piece of every prefix of equally long words (rows of code
    points) and its length; a row per character and one before. ``known`` has
    the first rows of both, where they are known already."""
    n, length = words.shape
    codes = np.ascontiguousarray(words.T).astype(np.uint64)  # one row per character
    codes += np.uint64(1)
    codes *= np.uint64(0x9FB21C651E98DF25)
    acc = np.zeros((length + 1, n), np.uint64)
    power = powers(_P, t.max_len + 1)
    last = np.full((length + 1, n), -1, np.int32)
    back = np.zeros((length + 1, n), np.int16)
    first = 1
    if known:
        first = len(known[0])
        last[:first], back[:first] = known
    for j in range(1, length + 1):
        np.add(acc[j - 1] * _P, codes[j - 1], out=acc[j])
        if j < first:
            continue
        for k in range(1, min(j, t.max_len) + 1):
            i = j - k
            rows, ids = t.ends_with(acc[j] - acc[i] * power[k], k)
            if k == 1 and len(rows) < n:  # a character outside the vocabulary
                full = np.full(n, t.unknown)
                full[rows] = ids
                rows, ids = np.arange(n), full
            if i and len(rows):
                ok = t.adjacent(last[i][rows].astype(np.int64), ids)
                rows, ids = rows[ok], ids[ok]
            better = k > back[j][rows]  # the maximum; the longest of equals
            back[j][rows[better]] = k
            last[j][rows[better]] = ids[better]
    return last, back


def _trace(last: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of all words, word by word, and how many each word has."""
    length, n = last.shape[0] - 1, last.shape[1]
    out = np.full((n, length), -1, np.int64)
    pos = np.full(n, length)
    live = np.arange(n)
    while len(live):
        out[live, pos[live] - 1] = last[pos[live], live]
        pos[live] -= back[pos[live], live]
        live = live[pos[live] > 0]
    flat = out.ravel()
    keep = flat >= 0
    return flat[keep], keep.reshape(n, length).sum(1)


def _viterbi(t: PieceTables, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of equally long words (rows of code points): the tokens, word by
    word, and the number of tokens of each word."""
    if words.shape[1] < 2 * CHUNK:
        return _trace(*_states(t, words))
    parts = [_long_word(t, w) for w in words]
    return np.concatenate(parts), np.array([len(x) for x in parts])


# A word without a space may be as long as its text. Its chunks advance
# together like words: each begins RUN_UP characters inside the one before, as
# if a word began there. Once both have the same last pieces for as many
# characters in a row as a piece can have, they have the same ones for good, as
# no step looks further back; then the chunk stands, else it is done again from
# what the one before knows. CHUNK is a multiple of most piece lengths, so that
# repeats of one character fall into step as well.
CHUNK, RUN_UP = 2520, 256


def _long_word(t: PieceTables, word: np.ndarray) -> np.ndarray:
    whole = (len(word) - RUN_UP) // CHUNK  # chunks of full length
    rows = np.stack([word[c * CHUNK:c * CHUNK + CHUNK + RUN_UP] for c in range(whole)])
    done: list[tuple[np.ndarray, np.ndarray]] = []
    for k in range(0, whole, 512):
        last, back = _states(t, rows[k:k + 512])
        done += [(last[:, c], back[:, c]) for c in range(last.shape[1])]
    tail = word[whole * CHUNK:]
    if len(tail) > RUN_UP:
        last, back = _states(t, tail[None, :])
        done.append((last[:, 0], back[:, 0]))
    same = slice(RUN_UP - t.max_len + 1, RUN_UP + 1)
    for c in range(1, len(done)):
        before = [x[CHUNK:CHUNK + RUN_UP + 1] for x in done[c - 1]]
        if not all((x[same] == y[same]).all() for x, y in zip(before, done[c])):
            text = word[c * CHUNK:c * CHUNK + len(done[c][0]) - 1]
            last, back = _states(t, text[None, :], tuple(x[:, None] for x in before))
            done[c] = last[:, 0], back[:, 0]
    out, pos = [], len(word)
    while pos:
        c = min(max((pos - RUN_UP - 1) // CHUNK, 0), len(done) - 1)
        at = pos - c * CHUNK
        out.append(done[c][0][at])
        pos -= int(done[c][1][at])
    return np.array(out[::-1], np.int64)


def _encode_units(t: PieceTables, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of distinct units (runs of spaces with what follows them)."""
    cores = [u[max(len(u) - len(u.lstrip(SPACE)) - 1, 0):] for u in units]
    lengths = np.array([len(c) for c in cores])
    extra = lengths < np.array([len(u) for u in units])
    tokens, order, counts = [], [], []
    step = 1 << 15
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        per = max(1, min(step, (1 << 19) // int(length)))
        for k in range(0, len(rows), per):
            part = rows[k:k + per]
            codes = np.frombuffer("".join(cores[i] for i in part).encode("utf-32-le", "surrogatepass"), np.uint32)
            flat, cnt = _viterbi(t, codes.reshape(len(part), int(length)))
            odd = extra[part]
            odd[np.repeat(np.arange(len(part)), cnt)[flat == t.unknown]] = True
            of_odd = np.repeat(odd, cnt)
            tokens.append(flat[~of_odd])
            order.append(part[~odd])
            counts.append(cnt[~odd])
            if odd.any():
                some = part[odd]
                flat, cnt = _finish(t, flat[of_odd], cnt[odd], [units[i] for i in some], [cores[i] for i in some])
                tokens.append(flat)
                order.append(some)
                counts.append(cnt)
    flat, order, counts = np.concatenate(tokens), np.concatenate(order), np.concatenate(counts)
    size = np.empty(len(units), np.int64)
    size[order] = counts
    start = np.empty(len(units), np.int64)
    start[order] = np.cumsum(counts) - counts
    return flat[_ragged(start, size)], size


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions start[i] .. start[i] + size[i] - 1 of all i, in order."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


def _finish(t: PieceTables, flat: np.ndarray, counts: np.ndarray, units: list[str],
            cores: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes for unknown characters, and longer runs of spaces."""
    out, size, at = [], [], 0
    for unit, core, k in zip(units, cores, counts):
        ids, pos = [], 0
        for i in flat[at:at + k]:
            if i == t.unknown:
                ids += t.byte_id[list(core[pos].encode("utf-8", "surrogatepass"))].tolist()
                pos += 1
            else:
                ids.append(int(i))
                pos += int(t.chars[i])
        at += k
        spaces = len(unit) - len(core)
        if spaces:
            if ids and ids[0] == t.runs[1]:
                ids, spaces = ids[1:], spaces + 1
            whole, rest = divmod(spaces, t.run_max)
            ids = [t.runs[n] for n in [t.run_max] * whole + _spaces(t, rest)] + ids
        out += ids
        size.append(len(ids))
    return np.array(out, np.int64), np.array(size, np.int64)


def _spaces(t: PieceTables, n: int) -> list[int]:
    """Lengths of the pieces of ``n`` spaces, fewer than the longest run:
    equal scores, so the leftmost pair that makes a piece merges first."""
    parts = [1] * n
    while True:
        k = next((k for k in range(len(parts) - 1) if parts[k] + parts[k + 1] in t.runs), None)
        if k is None:
            return parts
        parts[k:k + 2] = [parts[k] + parts[k + 1]]


class Encoder:
    """Encodes lists of texts. Units that a list holds twice or more are kept
    with their tokens for the next lists, up to ``keep`` of them."""

    def __init__(self, t: PieceTables, keep: int = 150_000):
        self.t, self.keep = t, keep
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.size = np.empty(0, np.int32), np.empty(0, np.int64)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts, in order, and the number of each text's."""
        seen: dict[str, int] = {}
        index: list[int] = []
        units_of = np.zeros(len(texts), np.int64)
        for k, x in enumerate(texts):
            if x:
                got = _UNIT.findall(SPACE + x.replace(" ", SPACE))
                index += [seen.setdefault(u, len(seen)) for u in got]
                units_of[k] = len(got)
        if not seen:
            return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
        units, idx = list(seen), np.array(index)
        del seen, index
        place = np.array([self.known.get(u, -1) for u in units])
        new = np.flatnonzero(place < 0)
        flat, size = self.flat, self.size
        if len(new):
            more, sizes = _encode_units(self.t, [units[i] for i in new])
            more = more.astype(np.int32)
            place[new] = len(size) + np.arange(len(new))
            flat, size = np.concatenate([flat, more]), np.concatenate([size, sizes])
            again = np.bincount(idx, minlength=len(units))[new] > 1
            if len(self.known) + again.sum() > self.keep:
                self._clear()
            for n, i in enumerate(new[again], len(self.known)):
                self.known[units[i]] = n
            self.flat = np.concatenate([self.flat, more[np.repeat(again, sizes)]])
            self.size = np.concatenate([self.size, sizes[again]])
        idx = place[idx]
        start = np.cumsum(size) - size
        ids = flat[_ragged(start[idx], size[idx])]
        ends = np.concatenate(([0], np.cumsum(size[idx])))
        stop = np.cumsum(units_of)
        return ids, ends[stop] - ends[stop - units_of]


def decode_ids(t: PieceTables, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """Text of each token list; the space that encoding puts first goes."""
    data = t.surface[_ragged(t.surface_at[ids], t.surface_len[ids])].tobytes()
    ends = np.concatenate(([0], np.cumsum(t.surface_len[ids])))
    stop = np.cumsum(counts)
    out = []
    for a, b in zip(ends[stop - counts], ends[stop]):
        s = data[a:b].decode("utf-8", "replace")
        out.append(s[1:] if s.startswith(" ") else s)
    return out


def sentencepiece_encode(df: DataFrame, model_file: str, text_col: str = "text",
                         tokens_col: str = "tokens", decoded_col: str | None = None) -> DataFrame:
    """``df`` plus the token ids (array<int>) of each text and, if wanted,
    what they decode to. ``model_file`` is read on the driver; tasks get its
    tables as a broadcast of a few MB."""
    tab = df.sparkSession.sparkContext.broadcast(tables(model_file))
    schema = T.StructType([T.StructField(tokens_col, T.ArrayType(T.IntegerType())),
                           *([T.StructField(decoded_col, T.StringType())] if decoded_col else [])])
    state: dict[str, Encoder] = {}

    def run(texts: list[str]) -> dict:
        if "encoder" not in state:
            state["encoder"] = Encoder(tab.value)
        ids, counts = state["encoder"](texts)
        out = {tokens_col: list_array(ids, counts)}
        if decoded_col:
            out[decoded_col] = decode_ids(tab.value, ids, counts)
        return out

    return add_from_text(df, text_col, schema, run, TEXT_BYTES)


def sentencepiece_decode(df: DataFrame, model_file: str, tokens_col: str = "tokens",
                         text_col: str = "text") -> DataFrame:
    """``df`` plus the text of each token list (null: empty)."""
    tab = df.sparkSession.sparkContext.broadcast(tables(model_file))

    def run(lists: pa.Array) -> pa.Array:
        counts = np.array([len(x) if x is not None else 0 for x in lists.to_pylist()], np.int64) \
            if lists.null_count else np.diff(np.asarray(lists.offsets)).astype(np.int64)
        ids = np.asarray(lists.flatten()).astype(np.int64)
        return pa.array(decode_ids(tab.value, ids, counts), pa.string())

    run.__annotations__ = {"lists": pa.Array, "return": pa.Array}
    decode = F.arrow_udf(run, T.StringType())
    return df.withColumn(text_col, decode(F.col(f"`{tokens_col}`")))
