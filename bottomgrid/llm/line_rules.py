"""Line-first quality rules with DataFrame functions only.

Each line of a text is judged on its own: punctuation (short and without an
end mark, or shouting), navigation (menus and tables: several separators) and
boilerplate (symbol clutter, notices of web pages). Failing lines are removed;
a document that loses too much of its text that way is rejected, as is one
that fails the base rule (under 50 words, or more than half of its words in
3-word windows that occur twice or more).

Everything is computed inside the row from its own text: no shuffle, and one
pass over the table. A null or empty text has no words and fails the base
rule. Rows are independent: repeated rows agree, an empty table stays empty,
and input columns with the names of the results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, text_column, with_columns

# Fixed values of the base rule.
SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Line rules.
MAX_LOST_PERCENT = 40
END_MARK = r"[.!?:;,\"')\]…。！？»”]\s*$"
SHOUT = r"\p{Lu}{2}[^\p{Ll}]*!!"
SEPARATORS = r"(?:\|.*){3}|(?:[»›•·].*){3}"
# Notices of web pages in English, German, French and Spanish. A line is one if
# it reserves all rights, or if it has cues of two kinds; one word that prose
# may have as well (cookies, to log in) says nothing. Accented letters are dots,
# as capitals fold in ASCII only.
_EDGE, _END = r"(?:^|[^a-zà-ÿ])", r"(?:[^a-zà-ÿ]|$)"


def _cue(*words: str) -> str:
    return f"(?i){_EDGE}(?:{'|'.join(words)}){_END}"


RIGHTS = _cue("all rights reserved", "alle rechte vorbehalten", "tous droits r.serv.s", "todos los derechos reservados")
CUES = (
    _cue("copyright", r"\(c\) [0-9]{4}", "© ?[0-9]{4}"),
    _cue("cookies?"),
    _cue("accept(?: all)?", "akzeptieren", "zustimmen", "accepter", "aceptar", "consent", "by (?:using|continuing)"),
    _cue("privacy policy", "datenschutz(?:erkl.rung)?", "politique de confidentialit.", "pol.tica de privacidad",
         "terms of (?:use|service)", "nutzungsbedingungen", "conditions d.utilisation", "t.rminos de uso"),
    _cue("log ?in", "sign in", "anmelden", "einloggen", "se connecter", "iniciar sesi.n"),
    _cue("sign up", "register", "registrieren", "s.inscrire", "registrarse", "forgot (?:your )?password", "passwort vergessen"),
    _cue("click here", "hier klicken", "cliquez ici", "haga clic"),
    _cue("subscribe", "newsletter", "abonnieren", "s.abonner", "suscr.bete", "suscribirse"),
    _cue("javascript", "browser", "navigateur", "navegador"),
    _cue("website", "web site", "webseite", "site web", "sitio web"),
)
ANY_CUE = "(?i)" + "|".join(c.removeprefix("(?i)") for c in (RIGHTS, *CUES))
MIN_LINE_WORDS = 4
MAX_SYMBOLS_PER_WORD = 0.3


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _repeat_words(w: str) -> Column:
    """Words inside 3-word windows that the text has twice or more: sort the
    windows, keep those that equal a neighbour, and add up what they cover."""
    return F.expr(f"""CASE WHEN size({w}) < 4 THEN 0 ELSE
      aggregate(array(transform(sequence(1, size({w}) - 2),
                                i -> xxhash64(get({w}, i - 1), get({w}, i), get({w}, i + 1)))), 0, (z, h) ->
        CASE WHEN size(array_distinct(h)) = size(h) THEN 0 ELSE
        aggregate(array(sort_array(transform(h, (x, i) -> struct(x AS x, i AS i)))), 0, (y, s) ->
          aggregate(array(sort_array(transform(filter(s, (e, k) -> (k > 0 AND e.x = get(s, k - 1).x)
                                                 OR (k + 1 < size(s) AND e.x = get(s, k + 1).x)), e -> e.i))), 0, (u, p) ->
            aggregate(transform(p, (a, k) -> least(3, coalesce(get(p, k + 1), a + 3) - a)), 0, (t, c) -> t + c)))
        END) END""").cast("long")


def is_notice(line: Column) -> Column:
    """All rights reserved, or cues of two kinds."""
    cues = sum((F.rlike(line, F.lit(c)).cast("int") for c in CUES[1:]), F.rlike(line, F.lit(CUES[0])).cast("int"))
    return F.rlike(line, F.lit(RIGHTS)) | (cues > 1)


def line_verdict(line: Column) -> Column:
    """Why a line fails: navigation, boilerplate, punctuation; null if it
    passes (as lines without a word do, which hold nothing to lose)."""
    words = F.size(F.array_remove(F.split(line, SPACES), ""))
    return (F.when(words == 0, F.lit(None))
            .when(F.rlike(line, F.lit(SEPARATORS)), F.lit("navigation"))
            .when(_count(line, SYMBOLS) > words * MAX_SYMBOLS_PER_WORD, F.lit("boilerplate"))
            .when((words < 25) & F.rlike(line, F.lit(ANY_CUE)) & is_notice(line), F.lit("boilerplate"))
            .when(F.rlike(line, F.lit(SHOUT)), F.lit("punctuation"))
            .when((words < MIN_LINE_WORDS) & ~F.rlike(line, F.lit(END_MARK)), F.lit("punctuation")))


def quality_rules(df: DataFrame, text_col: str = "text", max_lost_percent: int = MAX_LOST_PERCENT,
                  cleaned_col: str | None = "cleaned") -> DataFrame:
    """``df`` plus n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, lost_chars (word characters of the removed
    lines), kept, and the text without the removed lines."""
    w, lines, good, t = (fresh(c) for c in ("words", "lines", "good", "text"))
    text = F.coalesce(text_column(df, text_col), F.lit(""))
    out = df.withColumn(t, text)
    out = out.withColumns({w: F.array_remove(F.split(t, SPACES), ""), lines: F.split(t, "\n")})
    out = out.withColumn(good, F.filter(lines, lambda x: line_verdict(x).isNull()))
    worded = F.filter(lines, lambda x: F.rlike(x, F.lit(NOT_SPACE)))
    kept_chars = F.length(F.regexp_replace(F.array_join(good, ""), SPACES, ""))
    new = {
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_symbols": _count(F.col(t), SYMBOLS).cast("long"),
        "n_dup_lines": (F.aggregate(F.array(worded), F.lit(0), lambda z, x: F.size(x) - F.size(F.array_distinct(x)))).cast("long"),
        "n_repeat_words": _repeat_words(f"`{w}`"),
    }
    out = with_columns(out, {**new, "lost_chars": F.length(F.array_join(w, "")).cast("long") - kept_chars})
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    ok = F.col("lost_chars") * 100 <= F.col("word_chars") * max_lost_percent
    out = with_columns(out, {"base_failed": failed, **({cleaned_col: F.array_join(good, "\n")} if cleaned_col else {}),
                             "kept": ~failed & ok})
    return out.drop(w, lines, good, t)
