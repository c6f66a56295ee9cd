"""Byte-level BPE encoding and decoding with recursive DuckDB queries.

Spark deals the texts; inside each task an in-memory DuckDB connection holds
the merge table. The distinct pre-tokens that the task has not met before
become token-position rows (one per byte). A recursive query joins neighbours
with the merge table and contracts, in every word at once, the leftmost pair
of least rank, until no pair of the word is in the table. Ids become bytes
again by a join with the vocabulary and an aggregation ordered by position.

The merge table has a row for every pair of tokens whose concatenation lies
inside some token of the vocabulary; ``made`` is that token where it is one.
Two facts, both read off the vocabulary, keep long words cheap and exact:

* Neighbours without a row can never come to lie in one token, as any token
  across them would hold both. A long word falls apart there, and the parts
  (``g``, the position of their first token) contract side by side.
* A token is ``calm`` if every token that it may merge into has a greater
  rank. Making a calm token can't bring a pair of lesser rank, so all its
  occurrences in a part would follow one another anyway: they are made in one
  round (of overlapping ones every second, from the left). For other tokens
  only the leftmost occurrence is.

A pre-token that is in the vocabulary as a whole is one token, as in the
tiktoken library. No special token is ever made.

Null and empty texts have no tokens and decode to nothing. Rows are
independent: repeated rows agree, an empty table stays empty, and input
columns with the names of the results are replaced. Texts are never cut; a
very long word without spaces takes a round per distinct merge of its longest
part. An id that is not in the vocabulary fails the decoder.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_from_text, list_array, with_columns
from .token_counts import PRE_TOKEN

# Letters and numbers of Unicode 17 and later, which the regex
# module knows and the library, at Unicode 16, takes for other characters.
NEWER_LETTERS = (
    r"\u0558\u058b\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c\uab6d"
    r"\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a"
    r"\U00011db0-\U00011ddb\U00011df1\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2\U00016ff3"
    r"\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191"
    r"\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81"
    r"\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4\U0001e6e5"
    r"\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e"
    r"\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f")
NEWER_NUMBERS = r"\U00011de0-\U00011de9\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ff4-\U00016ff6"
NEWER = f"[{NEWER_LETTERS}{NEWER_NUMBERS}]"
STRICT = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?(?:(?!{NEWER})\p{{L}})+| ?(?:(?!{NEWER})\p{{N}})+"
          rf"| ?(?:{NEWER}|[^\s\p{{L}}\p{{N}}])+|\s+(?!\S)|\s+")

WORD_BYTES = 1 << 20  # of the words of one recursive query, unless one word is longer
CACHED_WORDS = 300_000  # of a Python worker, in each of two generations

TEXT_BYTES = 6 << 20  # of the texts that are encoded together, about
SHORT_WORD = 64  # bytes; longer words are worth cutting into parts

# One pair per word and round.
CONTRACT = """
WITH RECURSIVE t(g, pos, tok, done) AS (
  SELECT g, pos, tok, false FROM start
  UNION ALL (
  WITH near AS (
    SELECT g, pos, tok, lead(tok) OVER w AS b, lead(pos) OVER w AS after
    FROM t WHERE NOT done WINDOW w AS (PARTITION BY g ORDER BY pos)),
  ranked AS (
    SELECT n.*, m.made::BIGINT << 32 | n.pos::BIGINT AS key
    FROM near n LEFT JOIN merges m ON m.ab = n.tok::BIGINT << 32 | n.b::BIGINT),
  best AS (SELECT g, min(key) AS key, arg_min(after, key) AS gone FROM ranked GROUP BY g)
  SELECT r.g, r.pos, CASE WHEN r.key = b.key THEN (b.key >> 32)::INT ELSE r.tok END, b.key IS NULL
  FROM ranked r JOIN best b USING (g) WHERE b.gone IS NULL OR r.pos <> b.gone))
SELECT pos, tok FROM t WHERE done ORDER BY pos
"""

# The same result; words fall into parts, and calm tokens are made at once.
CONTRACT_PARTS = """
WITH RECURSIVE t(g, pos, tok, done) AS (
  SELECT g, pos, tok, false FROM start
  UNION ALL (
  WITH near AS (
    SELECT g, pos, tok, lead(tok) OVER w AS b, lead(pos) OVER w AS after
    FROM t WHERE NOT done WINDOW w AS (PARTITION BY g ORDER BY pos)),
  ranked AS (
    SELECT n.g, n.pos, n.tok, p.made, p.calm,
      max(CASE WHEN p.a IS NULL THEN n.after END) OVER (
        PARTITION BY n.g ORDER BY n.pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cut
    FROM near n LEFT JOIN pairs p ON p.a = n.tok AND p.b = n.b),
  best AS (
    SELECT coalesce(cut, g) AS g, pos, tok, made, calm,
      min(made) OVER (PARTITION BY coalesce(cut, g)) AS least FROM ranked),
  run AS (
    SELECT *, row_number() OVER w AS k,
      count(*) FILTER (WHERE made = least) OVER w AS nth,
      coalesce(made = least, false) AS hit FROM best WINDOW w AS (PARTITION BY g ORDER BY pos)),
  taken AS (
    SELECT *, hit AND CASE WHEN calm
      THEN (k - coalesce(max(CASE WHEN NOT hit THEN k END) OVER (PARTITION BY g ORDER BY pos), 0)) % 2 = 1
      ELSE nth = 1 END AS merges FROM run),
  merged AS (
    SELECT *, coalesce(lag(merges) OVER (PARTITION BY g ORDER BY pos), false) AS gone FROM taken)
  SELECT g, pos, CASE WHEN merges THEN made ELSE tok END, least IS NULL FROM merged WHERE NOT gone))
SELECT pos, tok FROM t WHERE done ORDER BY pos
"""

EXPAND = """
SELECT s.doc, array_to_string(list(v.piece ORDER BY s.pos), '') AS piece
FROM ids s JOIN vocabulary v ON v.id = s.id GROUP BY s.doc
"""


class Vocabulary:
    """Tokens by id, and the merge table; both bounded by the file."""

    def __init__(self, rank_file: str):
        ranks: dict[bytes, int] = {}
        with open(rank_file, "rb") as f:
            data = f.read()
        self.key = hashlib.sha256(data).hexdigest()
        for line in data.splitlines():
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        self.ids = ranks
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        inside = {t[i:j] for t in ranks for i in range(len(t)) for j in range(i + 2, len(t) + 1)}
        rows = [(ranks[s[:k]], ranks[s[k:]], ranks.get(s, -1)) for s in inside for k in range(1, len(s))
                if s[:k] in ranks and s[k:] in ranks]
        a, b, made = np.array(rows, np.int32).reshape(-1, 3).T
        merge = made >= 0
        next_rank = np.full(max(ranks.values()) + 1, np.iinfo(np.int32).max)
        np.minimum.at(next_rank, a[merge], made[merge])
        np.minimum.at(next_rank, b[merge], made[merge])
        calm = merge & (next_rank[np.maximum(made, 0)] > made)
        self.pairs = pa.table({"a": a, "b": b, "made": pa.array(made, mask=~merge), "calm": calm})
        self.known = np.zeros(max(ranks.values()) + 1, bool)
        self.known[list(ranks.values())] = True
        self.tokens = pa.table({"id": pa.array(ranks.values(), pa.int32()),
                                "piece": [t.decode("latin-1") for t in ranks]})  # a character for each byte


@functools.lru_cache(maxsize=4)
def load(rank_file: str) -> Vocabulary:
    return Vocabulary(rank_file)


class Tokenizer:
    """A connection with the merge table, and words encoded before. A full
    generation of words becomes the old one; old words that come again move
    into the new one."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.plain, self.strict = regex.compile(PRE_TOKEN).findall, regex.compile(STRICT).findall
        self.newer = re.compile(NEWER).search
        self.words: dict[str, bytes] = {}  # ids as little-endian 32-bit integers
        self.old: dict[str, bytes] = {}
        self.db = duckdb.connect(config={"threads": 1, "temp_directory": ""})
        for name, table in (("pairs", vocabulary.pairs), ("vocabulary", vocabulary.tokens)):
            self.db.register("loaded", table)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM loaded")
            self.db.unregister("loaded")
        self.db.execute("CREATE TABLE merges AS SELECT a::BIGINT << 32 | b::BIGINT AS ab, made FROM pairs WHERE made IS NOT NULL")

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [(self.plain if self._is_old(x) else self.strict)(x) for x in texts]
        if len(self.words) > CACHED_WORDS:
            self.old, self.words = self.words, {}
        new = set(chain.from_iterable(split)).difference(self.words)
        again = new.intersection(self.old)
        self.words.update((w, self.old[w]) for w in again)
        new -= again
        short: list[tuple[str, bytes]] = []
        long: list[tuple[str, bytes]] = []
        for w in new:
            b = w.encode("utf-8", "surrogatepass")
            whole = self.v.ids.get(b)
            if whole is not None:
                self.words[w] = whole.to_bytes(4, "little")
            else:
                (short if len(b) <= SHORT_WORD else long).append((w, b))
        self._contract(short, CONTRACT)
        self._contract(long, CONTRACT_PARTS)
        get = self.words.__getitem__
        return [b"".join(map(get, ws)) for ws in split]

    def _is_old(self, x: str) -> bool:
        """Whether a text has none of the newer letters and numbers."""
        try:
            x.encode("latin-1")  # at memory speed; most texts
            return True
        except UnicodeEncodeError:
            return self.newer(x) is None

    def _contract(self, words: list[tuple[str, bytes]], query: str) -> None:
        ends = np.cumsum([len(b) for _, b in words])
        first = 0
        while first < len(words):
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + WORD_BYTES, "right")))
            part, first = words[first:last], last
            size = np.array([len(b) for _, b in part], np.int64)
            at = np.cumsum(size) - size
            data = np.frombuffer(b"".join(b for _, b in part), np.uint8)
            kind = np.int32 if len(data) < 1 << 31 else np.int64
            self.db.register("start", pa.table({
                "g": np.repeat(at, size).astype(kind), "pos": np.arange(len(data), dtype=kind), "tok": self.v.byte[data]}))
            out = self.db.sql(query).to_arrow_table()
            self.db.unregister("start")
            ids = out.column("tok").to_numpy().astype("<u4").tobytes()
            cut = np.searchsorted(out.column("pos").to_numpy(), np.append(at, len(data))) * 4
            for (w, _), a, b in zip(part, cut[:-1].tolist(), cut[1:].tolist()):
                self.words[w] = ids[a:b]

    def decode(self, packed: list[bytes]) -> list[bytes]:
        count = np.array([len(p) // 4 for p in packed], np.int64)
        ids = np.frombuffer(b"".join(packed), "<u4").astype(np.int32)
        out = [b""] * len(packed)
        if len(ids):
            if ids.min() < 0 or ids.max() >= len(self.v.known) or not self.v.known[ids].all():
                unknown = np.setdiff1d(ids, np.flatnonzero(self.v.known))
                raise ValueError(f"not in the vocabulary: {unknown[:5].tolist()}")
            self.db.register("ids", pa.table({"doc": np.repeat(np.arange(len(packed)), count),
                                              "pos": np.arange(len(ids)), "id": ids}))
            got = self.db.execute(EXPAND).fetchall()
            self.db.unregister("ids")
            for doc, piece in got:
                out[doc] = piece.encode("latin-1")
        return out


# One per vocabulary and Python worker, so that the tasks of a worker share
# the words that they have encoded.
_WORKER: dict[str, Tokenizer] = {}


def _tokenizer(shared) -> Tokenizer:
    v: Vocabulary = shared.value
    if v.key not in _WORKER:
        _WORKER[v.key] = Tokenizer(v)
    return _WORKER[v.key]


def bpe_encode(df: DataFrame, rank_file: str, text_col: str = "text", tokens_col: str | None = "tokens",
               packed_col: str | None = None, decoded_col: str | None = None) -> DataFrame:
    """``df`` plus the ids of each text as an array (``tokens_col``) and as
    little-endian unsigned 32-bit integers (``packed_col``), and the bytes
    that the ids decode to (``decoded_col``); None leaves a column out."""
    shared = df.sparkSession.sparkContext.broadcast(load(rank_file))
    kinds = {tokens_col: T.ArrayType(T.IntegerType(), False), packed_col: T.BinaryType(), decoded_col: T.BinaryType()}
    schema = T.StructType([T.StructField(c, k) for c, k in kinds.items() if c])

    def run(texts: list[str]) -> dict:
        tokenizer = _tokenizer(shared)
        packed = tokenizer.encode(texts)
        out: dict = {}
        if tokens_col:
            out[tokens_col] = list_array(np.frombuffer(b"".join(packed), "<u4").astype(np.int32),
                                         np.array([len(p) // 4 for p in packed]))
        if packed_col:
            out[packed_col] = pa.array(packed, pa.binary())
        if decoded_col:
            out[decoded_col] = pa.array(tokenizer.decode(packed), pa.binary())
        return out

    return add_from_text(df, text_col, schema, run, TEXT_BYTES)


def bpe_decode(df: DataFrame, rank_file: str, tokens_col: str = "tokens", decoded_col: str = "decoded") -> DataFrame:
    """``df`` plus the bytes that an array of ids stands for (null: none)."""
    shared = df.sparkSession.sparkContext.broadcast(load(rank_file))

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in arrays:
            packed = [np.array(x.as_py() or [], "<u4").tobytes() for x in arr]
            yield pa.array(_tokenizer(shared).decode(packed), pa.binary())

    run.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    ids: Column = F.col(f"`{tokens_col}`").cast("array<int>")
    return with_columns(df, {decoded_col: F.arrow_udf(run, T.BinaryType())(ids)})
