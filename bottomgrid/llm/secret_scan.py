"""Secret scanning over a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over trigrams
that every match must contain. A batch of texts is indexed by trigram
(postings for the trigrams that any query names), the postings are combined by
the queries, and only the candidate texts are verified with the expression
itself. A rule without mandatory trigrams (long hex strings) scans every text.
The index only narrows where an expression runs, never what it finds.

Null and empty texts have no spans. Rows are independent: repeated rows agree
and an empty table stays empty; input columns with the names of the results
are replaced. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass
from re import _constants as K
from re import _parser as P

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import LOWER, add_from_text


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its expression, the group whose length counts, and
    the least length. ``base`` rules are the ones that are counted."""
    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    base: bool = False


# The base rules, in the order in which ties are listed.
BASE_RULES = (
    Rule("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
                   r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         8, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 16, 0, True),
    Rule("hex", r"[0-9a-f]+", 32, 0, True),
)
# Further public token formats.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("code_host_pat", r"github_pat_[A-Za-z0-9_]{40,}"),
    Rule("git_server", r"glpat-[A-Za-z0-9_-]{20,}"),
    Rule("maps_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("oauth_access", r"ya29\.[A-Za-z0-9_-]{20,}"),
    Rule("oauth_client", r"GOCSPX-[A-Za-z0-9_-]{28}"),
    Rule("payment", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("payment_hook", r"whsec_[A-Za-z0-9]{32,}"),
    Rule("chat_hook", r"hooks\.slack\.com/services/T[A-Z0-9]{8,}/B[A-Z0-9]{8,}/[A-Za-z0-9]{20,}"),
    Rule("forum_hook", r"discord(?:app)?\.com/api/webhooks/[0-9]{17,20}/[A-Za-z0-9_-]{60,}"),
    Rule("bot", r"[0-9]{8,10}:AA[A-Za-z0-9_-]{33}"),
    Rule("mail_api", r"SG\.[A-Za-z0-9_-]{22}\.[A-Za-z0-9_-]{43}"),
    Rule("mail_key", r"key-[0-9a-f]{32}"),
    Rule("mail_list", r"[0-9a-f]{32}-us[0-9]{1,2}"),
    Rule("js_packages", r"npm_[A-Za-z0-9]{36}"),
    Rule("py_packages", r"pypi-AgEIcHlwaS5vcmc[A-Za-z0-9_-]{50,}"),
    Rule("images", r"dckr_pat_[A-Za-z0-9_-]{27,}"),
    Rule("model_hub", r"hf_[A-Za-z0-9]{34,}"),
    Rule("model_api", r"sk-(?:proj-)?[A-Za-z0-9_-]{40,}"),
    Rule("shop", r"shp(?:at|ca|pa|ss)_[0-9a-fA-F]{32}"),
    Rule("till", r"sq0(?:atp|csp|idp)-[A-Za-z0-9_-]{22,}"),
    Rule("cloud_token", r"do[op]_v1_[0-9a-f]{64}"),
    Rule("tracker", r"lin_api_[A-Za-z0-9]{40}"),
    Rule("api_client", r"PMAK-[0-9a-f]{24}-[0-9a-f]{34}"),
    Rule("lakehouse", r"dapi[0-9a-f]{32}"),
    Rule("age_key", r"AGE-SECRET-KEY-1[0-9A-Z]{58}"),
    Rule("storage_key", r"AccountKey=[A-Za-z0-9+/]{86}=="),
    Rule("vault", r"hvs\.[A-Za-z0-9_-]{24,}"),
    Rule("dashboard", r"glsa_[A-Za-z0-9]{32}_[0-9a-f]{8}"),
    Rule("monitor", r"NRAK-[A-Z0-9]{27}"),
    Rule("secrets_store", r"dp\.pt\.[A-Za-z0-9]{40,}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{0,20}://[^\s:/@]{1,64}:[^\s:/@]{3,64}@[A-Za-z0-9.-]+"),
)
RULES = BASE_RULES + MORE_RULES

MAX_STRINGS = 64  # literal variants followed through one expression

# A query is True (no mandatory trigram), a trigram (bytes), or a tuple
# ("and" | "or", parts).
Query = bool | bytes | tuple


def trigram_query(pattern: str) -> Query:
    """The Boolean trigram query that every match of ``pattern`` satisfies,
    in ASCII lower case."""
    return _simplify(_of_sequence(P.parse(pattern))[1])


def _both(a: Query, b: Query) -> Query:
    return b if a is True else a if b is True else ("and", (a, b))


def _any(parts: list[Query]) -> Query:
    return True if not parts or any(p is True for p in parts) else ("or", tuple(dict.fromkeys(parts)))


def _of_strings(strings: set[str]) -> Query:
    """One of ``strings`` occurs: any of them, each by all its trigrams."""
    parts: list[Query] = []
    for s in strings:
        b = s.encode("utf-8").translate(bytes(LOWER))
        q: Query = True
        for k in range(len(b) - 2):
            q = _both(q, b[k:k + 3])
        parts.append(q)
    return _any(parts)


def _simplify(q: Query) -> Query:
    if not isinstance(q, tuple):
        return q
    op, parts = q
    flat: list[Query] = []
    for p in map(_simplify, parts):
        flat += p[1] if isinstance(p, tuple) and p[0] == op else [p]
    flat = list(dict.fromkeys(flat))
    return flat[0] if len(flat) == 1 else (op, tuple(flat))


def _of_sequence(items) -> tuple[set[str] | None, Query]:
    """Of a sequence: the few strings it can match exactly (else None), and
    the query that its matches satisfy."""
    strings: set[str] = {""}
    exact, query = True, True

    for op, arg in items:
        got = _of_item(op, arg)
        if got[0] is not None and len(strings) * len(got[0]) <= MAX_STRINGS:
            strings = {a + b for a in strings for b in got[0]}
            continue
        query = _both(_both(query, _of_strings(strings)), got[1])
        exact = False
        strings = got[0] if got[0] is not None and len(got[0]) <= MAX_STRINGS else {""}
    query = _both(query, _of_strings(strings))
    return (strings if exact else None), query


def _of_item(op, arg) -> tuple[set[str] | None, Query]:
    if op is K.LITERAL:
        return {_fold(chr(arg))}, True
    if op is K.IN:
        chars: set[str] = set()
        for kind, v in arg:
            if kind is K.LITERAL:
                chars.add(_fold(chr(v)))
            elif kind is K.RANGE and v[1] - v[0] < MAX_STRINGS:
                chars |= {_fold(chr(c)) for c in range(v[0], v[1] + 1)}
            else:
                return None, True
        return (chars, True) if len(chars) <= 8 else (None, True)
    if op is K.SUBPATTERN:
        return _of_sequence(arg[3])
    if op is K.BRANCH:
        got = [_of_sequence(b) for b in arg[1]]
        if all(g[0] is not None for g in got):
            return set().union(*(g[0] for g in got)), _any([g[1] for g in got])
        return None, _any([g[1] for g in got])
    if op in (K.MAX_REPEAT, K.MIN_REPEAT):
        low, high, body = arg
        strings, query = _of_sequence(body)
        if low == 0:
            return ({""} | strings, True) if high == 1 and strings is not None else (None, True)
        return (strings, query) if low == high == 1 else (None, query)
    if op is K.AT:
        return {""}, True
    return None, True


def _fold(c: str) -> str:
    return c.lower() if c.isascii() else c


def _trigrams(q: Query) -> set[bytes]:
    return {q} if isinstance(q, bytes) else set().union(*map(_trigrams, q[1])) if isinstance(q, tuple) else set()


class Scanner:
    """Compiled rules with their trigram queries."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.regex = [re.compile(r.pattern) for r in rules]
        self.queries = [trigram_query(r.pattern) for r in rules]
        self.grams = sorted(set().union(*map(_trigrams, self.queries)))
        if len(self.grams) > 65_000:
            raise ValueError("too many trigrams")
        self.slot = np.zeros(1 << 24, np.uint16)  # 0: not needed by any rule
        for k, g in enumerate(self.grams):
            self.slot[g[0] << 16 | g[1] << 8 | g[2]] = k + 1

    def postings(self, texts: list[str]) -> dict[bytes, np.ndarray]:
        """The texts (as a bitmap) that hold each needed trigram."""
        blobs = [x.encode("utf-8", "surrogatepass") for x in texts]
        data = LOWER[np.frombuffer(b"\0".join(blobs) + b"\0", np.uint8)]
        ends = np.cumsum([len(b) + 1 for b in blobs])
        code = data[:-2].astype(np.int32) << 16
        code |= data[1:-1].astype(np.int32) << 8
        code |= data[2:]
        found = self.slot[code]
        at = np.flatnonzero(found)
        doc = np.searchsorted(ends, at, side="right")
        maps = np.zeros((len(self.grams) + 1, len(texts)), bool)
        maps[found[at], doc] = True
        return {g: maps[k + 1] for k, g in enumerate(self.grams)}

    def candidates(self, q: Query, index: dict[bytes, np.ndarray], n: int) -> np.ndarray:
        if q is True:
            return np.ones(n, bool)
        if isinstance(q, bytes):
            return index[q]
        maps = [self.candidates(p, index, n) for p in q[1]]
        return (np.logical_and if q[0] == "and" else np.logical_or).reduce(maps)

    def __call__(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """Per text: (start, rule, end) of every match, sorted."""
        index = self.postings(texts)
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for k, (rule, rx, q) in enumerate(zip(self.rules, self.regex, self.queries)):
            for d in np.flatnonzero(self.candidates(q, index, len(texts))):
                for m in rx.finditer(texts[d]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        out[d].append((m.start(), k, m.end()))
        for spans in out:
            spans.sort()
        return out


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("end", T.LongType())])


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def span_result(rules_kinds: list[str], base: set[str], spans: list[tuple[str, int, int]]) -> tuple:
    """Counts per base kind, digest of the base spans, all spans joined."""
    own = [s for s in spans if s[0] in base]
    return [sum(s[0] == k for s in own) for k in rules_kinds if k in base], sha256(joined(own)), joined(spans)


def find_secrets(df: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES,
                 scanner: Callable[[tuple[Rule, ...]], Scanner] = Scanner) -> DataFrame:
    """``df`` plus ``secrets`` (array of kind, start, end), ``n_<kind>`` of
    each base rule, ``base_sha256`` and ``spans`` (all of them, joined)."""
    base = [r.kind for r in rules if r.base]
    schema = T.StructType([*[T.StructField(f"n_{k}", T.LongType()) for k in base],
                           T.StructField("base_sha256", T.StringType()),
                           T.StructField("spans", T.StringType()),
                           T.StructField("secrets", T.ArrayType(SPAN))])
    state: dict[str, Scanner] = {}

    def run(texts: list[str]) -> dict:
        if "scanner" not in state:
            state["scanner"] = scanner(rules)
        out: dict[str, list] = {f.name: [] for f in schema}
        for found in state["scanner"](texts):
            spans = [(rules[k].kind, a, b) for a, k, b in found]
            counts, digest, text = span_result([r.kind for r in rules], set(base), spans)
            for k, n in zip(base, counts):
                out[f"n_{k}"].append(n)
            out["base_sha256"].append(digest)
            out["spans"].append(text)
            out["secrets"].append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
        return out

    return add_from_text(df, text_col, schema, run)
