"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, "://", plus signs
before digits, digits, and cue words that announce an identifier. From each
anchor a small deterministic parser expands to the left and right and
validates the boundaries (address labels, octets, Luhn digits, digit counts).
For the base kinds the result is that of leftmost non-overlapping matching of
these expressions, failing matches dropped without a retry:

    email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+
    ip     [0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)         parts at most 255
    card   [0-9]([\\x20-]?[0-9])+                          16-19 digits, Luhn
    phone  \\+[0-9][\\x20().0-9-]+[0-9]                     8-15 digits

Added kinds: url (scheme "://" rest) and account: a cue word, up to three
filler words (number, no, nr, id, code, is and the like, in four languages, also
in brackets), then an identifier. That is an IBAN
whose check digits are right, in one piece or in groups with single spaces or
hyphens between; or else groups of digits of 6 to 34 digits in all; or else one
token of 6 to 40 letters, digits and hyphens with at least 4 digits.

Null and empty texts have no spans. Rows are independent: repeated rows agree
and an empty table stays empty; input columns with the names of the results
are replaced. Positions are code points, ends exclusive. Overlapping spans of
different kinds are all reported; masking replaces their union once, with the
kind that starts first.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import add_from_text
from .secret_scan import SPAN, span_result

# Fixed values.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")
# words that announce an identifier; of words that prose has before any number
# (French compte, Spanish cuenta) only the longer names
CUES = ("account", "acct", "iban", "passport", "ssn", "social security", "tax id", "driver's license", "national insurance",
        "kontonummer", "kontonr", "konto", "reisepass", "reisepassnummer", "personalausweis", "ausweisnummer", "steuernummer",
        "steuer-id", "sozialversicherungsnummer", "versicherungsnummer", "bankverbindung",
        "numéro de compte", "n° de compte", "compte bancaire", "passeport", "numéro de sécurité sociale", "sécurité sociale",
        "carte d'identité", "numéro fiscal",
        "número de cuenta", "cuenta bancaria", "cuenta corriente", "pasaporte", "seguridad social", "documento de identidad", "dni", "nif")
DIGITS = "0123456789"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_RUN = re.compile(r"[0-9]+")
_QUAD = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])*")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_URL = re.compile(r"[^\x00-\x20\x7F\"'<>|`{}\\^]+")
_FILL = r"[\x20\t:#=.()\[\]°º-]"
_AFTER_CUE = re.compile(rf"(?:{_FILL}{{0,4}}(?<![A-Za-z0-9])(?:numbers?|num|no|nr|id|code|is|nummer|lautet|ist|numéro|número|numero|es|est)"
                        rf"(?![A-Za-z0-9])){{0,3}}{_FILL}{{1,4}}", re.I | re.A)
_IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?:[\x20-]?[A-Za-z0-9]){11,30}")
_GROUPS = re.compile(r"[0-9]+(?:[\x20-][0-9]+)+(?![A-Za-z0-9-])")
_TOKEN = re.compile(r"[A-Za-z0-9-]{6,40}(?![A-Za-z0-9-])")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def iban_end(text: str, at: int) -> int:
    """End of the longest IBAN of whole groups from ``at`` on, 0 without one."""
    m = _IBAN.match(text, at)
    end = m.end() if m else at
    while end > at:
        compact = re.sub("[\\x20-]", "", text[at:end]).upper()
        if len(compact) < 15:
            break
        if not text[end:end + 1].isalnum() and int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1:
            return end
        end -= 1
        while end > at and text[end - 1] in " -":
            end -= 1
    return 0


def _octet(x: str) -> bool:
    x = x.lstrip("0")
    return len(x) < 4 and int(x or "0") <= 255


class Finder:
    def __init__(self):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        for a in ("@", "://", *[f"+{d}" for d in DIGITS], *DIGITS):
            self.automaton.add_word(a, (a[0], len(a)))
        for c in CUES:
            for word in {c, c.upper(), c.capitalize()}:
                self.automaton.add_word(word, ("cue", len(word)))
        self.automaton.make_automaton()

    def __call__(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) by kind as listed, then start."""
        found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
        free = dict.fromkeys(KINDS, 0)  # where the next match of a kind may start
        quad_from = run_end = 0
        for last, (kind, size) in self.automaton.iter(text):
            at = last - size + 1
            if kind == "@":
                self._email(text, at, found["email"], free)
            elif kind == "+":
                if at >= free["phone"] and (m := _PHONE.match(text, at)):
                    free["phone"] = m.end()
                    if 8 <= sum(c in DIGITS for c in m[0]) <= 15:
                        found["phone"].append(m.span())
            elif kind == ":":
                self._url(text, at, found["url"], free)
            elif kind == "cue":
                self._account(text, at, last + 1, found["account"], free)
            else:
                if at >= run_end:  # the first digit of a run
                    run_end = _RUN.match(text, at).end()
                    if at >= quad_from and (m := _QUAD.match(text, at)):
                        quad_from = m.end()
                        if all(map(_octet, m[0].split("."))):
                            found["ip"].append(m.span())
                if at >= free["card"]:
                    m = _CHAIN.match(text, at)
                    free["card"] = m.end()
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        found["card"].append(m.span())
        return [(k, a, b) for k in KINDS for a, b in found[k]]

    @staticmethod
    def _email(text: str, at: int, out: list, free: dict) -> None:
        start = at
        while start > free["email"] and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            free["email"] = m.end()
            out.append((start, m.end()))

    @staticmethod
    def _url(text: str, at: int, out: list, free: dict) -> None:
        start = at
        while start > free["url"] and text[start - 1] in _SCHEME:
            start -= 1
        m = _URL.match(text, at + 3)
        if start < at and text[start].isalpha() and m:
            end = m.end()
            while end > at + 3 and text[end - 1] in ".,;:!?)]":
                end -= 1
            if end > at + 3:
                free["url"] = end
                out.append((start, end))

    @staticmethod
    def _account(text: str, at: int, end: int, out: list, free: dict) -> None:
        if at < free["account"] or at and (text[at - 1].isalnum() or text[at - 1] == "_"):
            return
        cue = _AFTER_CUE.match(text, end)
        if not cue:
            return
        start = cue.end()
        stop = iban_end(text, start)
        if not stop and (m := _GROUPS.match(text, start)) and 6 <= sum(c in DIGITS for c in m[0]) <= 34:
            stop = m.end()
        if not stop and (m := _TOKEN.match(text, start)) and sum(c in DIGITS for c in m[0]) >= 4:
            stop = m.end()
        if stop:
            free["account"] = stop
            out.append((start, stop))


def mask_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with the union of the spans replaced by ``<KIND>``."""
    out, at = [], 0
    for start, end, kind in sorted((a, b, k) for k, a, b in spans):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find_pii(df: DataFrame, text_col: str = "text", masked_col: str | None = None) -> DataFrame:
    """``df`` plus ``pii`` (array of kind, start, end), ``n_<kind>`` of each
    base kind, ``base_sha256`` and ``spans`` (all of them, joined). With
    ``masked_col`` also the text with every span replaced (null stays null)."""
    schema = T.StructType([*[T.StructField(f"n_{k}", T.LongType()) for k in BASE_KINDS],
                           T.StructField("base_sha256", T.StringType()),
                           T.StructField("spans", T.StringType()),
                           T.StructField("pii", T.ArrayType(SPAN)),
                           *([T.StructField("masked", T.StringType())] if masked_col else [])])
    state: dict[str, Finder] = {}

    def run(texts: list[str]) -> dict:
        if "finder" not in state:
            state["finder"] = Finder()
        out: dict[str, list] = {f.name: [] for f in schema}
        for x in texts:
            spans = state["finder"](x)
            counts, digest, text = span_result(list(KINDS), set(BASE_KINDS), spans)
            for k, n in zip(BASE_KINDS, counts):
                out[f"n_{k}"].append(n)
            out["base_sha256"].append(digest)
            out["spans"].append(text)
            out["pii"].append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
            if masked_col:
                out["masked"].append(mask_text(x, spans) if spans else x)
        return out

    if not masked_col:
        return add_from_text(df, text_col, schema, run)
    from pyspark.sql import functions as F

    from .common import fresh, text_column, with_columns
    was = fresh("text")
    out = add_from_text(df.withColumn(was, text_column(df, text_col)), was, schema, run)
    masked = F.when(F.col(was).isNotNull(), F.col("masked"))
    return with_columns(out, {masked_col: masked}).drop(was, *({"masked"} - {masked_col}))
