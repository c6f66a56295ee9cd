"""Benchmark decontamination with DataFrame functions only.

Texts are lower-cased (A-Z) and cut into words; a benchmark window is 13
consecutive words of an item (an item of fewer words, but not none, is one
window). The normalised windows are a hash set that every task holds; a scan
over each text's token windows looks them up. A cheap hash of a window's first
two words comes first, the whole window's text decides, so a hit is verified
and never rests on a hash alone. Text never leaves its row: no shuffle.

The set is shipped as literals of the plan while it stays under
``MAX_WINDOWS`` windows and ``MAX_CHARS`` characters, both counted before. A
larger benchmark takes an equi-join of the texts' exploded windows with the
table of windows, behind a bitmap filter of bounded size that keeps nearly all
other windows out of the shuffle; both ways give the same rows (tested).

Null and empty texts have no words, no hits, and are not contaminated; items
without words have no window; an empty benchmark hits nothing and an empty
table stays empty. Rows are independent, so repeated rows agree. Input columns
with the names of the results are replaced.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, may_have, text_column, with_columns

# The words of the contamination rule.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# the same words before they are lower-cased
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RAW_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 13

MAX_WINDOWS = 200_000
MAX_CHARS = 32_000_000


def words_of(text: Column) -> Column:
    """The words of a text; none for null."""
    got = F.array_remove(F.split(F.translate(text, UPPER, LOWER), BREAK), "")
    return F.coalesce(got, F.array().cast("array<string>"))


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                      window: int = WINDOW) -> DataFrame:
    """One row per item and distinct window: item_id (string), n, words (the
    window's words joined by a space; words hold no space)."""
    items = benchmark.select(F.col(f"`{id_col}`").cast("string").alias("item_id"),
                             words_of(text_column(benchmark, text_col)).alias("w"))
    items = items.where(F.size("w") > 0).withColumn("n", F.least(F.size("w"), F.lit(window)))
    return items.select("item_id", "n", F.explode(F.expr(
        "transform(sequence(1, size(w) - n + 1), i -> array_join(slice(w, i, n), ' '))")).alias("words")).distinct()


def _literals(values: list[str]) -> str:
    return ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)


def _scan(windows: list, w: str) -> str:
    """SQL for the hits of a row: an array of (at, n), ``at`` from 0."""
    parts = []
    for n in sorted({r["n"] for r in windows}):
        some = sorted({r["words"] for r in windows if r["n"] == n})
        last = f"size({w}) - {n} + 1"
        first = ""
        if n > 1:
            pairs = sorted({r["pair"] for r in windows if r["n"] == n})
            first = f"xxhash64(get({w}, i - 1), get({w}, i)) IN ({', '.join(f'{p}L' if p >= 0 else f'({p}L)' for p in pairs)}) AND "
        parts.append(f"transform(CASE WHEN {last} > 0 THEN filter(sequence(1, {last}), i -> {first}"
                     f"array_join(slice({w}, i, {n}), ' ') IN ({_literals(some)})) ELSE array() END, "
                     f"i -> struct(CAST(i - 1 AS INT) AS at, {n} AS n))")
    empty = "CAST(array() AS array<struct<at: int, n: int>>)"
    return f"concat({', '.join(parts)})" if parts else empty


def _by_literals(df: DataFrame, w: str, hits: str, windows: list) -> DataFrame:
    return df.withColumn(hits, F.expr(_scan(windows, f"`{w}`")))


def _by_join(df: DataFrame, w: str, hits: str, windows: DataFrame) -> DataFrame:
    """The same hits for a benchmark of any size: windows of the distinct
    texts, exploded, meet the table of windows on their text. Of the windows
    that the benchmark does not have only those pass to the shuffle that a
    bitmap of its windows takes for some."""
    key = fresh("key")
    keyed = df.withColumn(key, F.sha2(F.array_join(w, " "), 256))
    sizes = [r["n"] for r in windows.select("n").distinct().collect()]  # at most WINDOW of them
    each = [F.expr(f"transform(CASE WHEN size(`{w}`) >= {n} THEN sequence(1, size(`{w}`) - {n} + 1) ELSE array() END, "
                   f"i -> struct(CAST(i - 1 AS INT) AS at, {n} AS n, array_join(slice(`{w}`, i, {n}), ' ') AS words))")
            for n in sizes]
    if not each:
        return keyed.withColumn(hits, F.expr("CAST(array() AS array<struct<at: int, n: int>>)")).drop(key)
    known = windows.select("n", "words").distinct()
    own = keyed.dropDuplicates([key]).select(F.col(key).alias("k"), F.explode(F.concat(*each)).alias("x")).select("k", "x.*")
    at = may_have(own, known, ["n", "words"]).join(known, ["n", "words"], "left_semi")
    found = at.groupBy("k").agg(F.collect_list(F.struct("at", "n")).alias(hits))
    out = keyed.join(found, keyed[key] == found["k"], "left").drop("k", key)
    return out.withColumn(hits, F.coalesce(hits, F.expr("CAST(array() AS array<struct<at: int, n: int>>)")))


def mark_contamination(df: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW,
                       share: int = 20, max_windows: int = MAX_WINDOWS, max_chars: int = MAX_CHARS,
                       hits_col: str = "hits", words_col: str | None = None) -> DataFrame:
    """``df`` plus ``n_words``, ``n_hit`` (words inside any occurrence of a
    benchmark window), ``contaminated`` (n_hit > 0 and share * n_hit >=
    n_words) and ``hits`` (array of (at, n), the word index from 0 and the
    length of each occurring window, sorted)."""
    windows = benchmark_windows(benchmark, text_col="text", window=window)
    size = windows.agg(F.count("*").alias("n"), F.sum(F.length("words")).alias("c")).first()
    w, hits, once = fresh("words"), fresh("hits"), fresh("once")
    out = df.withColumn(w, words_of(text_column(df, text_col)))
    if size["n"] <= max_windows and (size["c"] or 0) <= max_chars:
        rows = windows.select("n", "words", F.expr(
            "xxhash64(split(words, ' ')[0], get(split(words, ' '), 1))").alias("pair")).distinct().collect()
        out = _by_literals(out, w, hits, rows)
    else:
        out = _by_join(out, w, hits, windows)
    # a column that differs from row to row keeps the optimizer from copying
    # the hits, with the whole window set in them, into every later use
    out = out.withColumns({hits: F.array_sort(hits), once: F.monotonically_increasing_id()})
    covered = F.aggregate(
        hits, F.struct(F.lit(0).alias("to"), F.lit(0).alias("sum")),
        lambda a, x: F.struct(F.greatest(a["to"], x["at"] + x["n"]).alias("to"),
                              (a["sum"] + F.greatest(F.lit(0), x["at"] + x["n"] - F.greatest(a["to"], x["at"]))).alias("sum")),
        lambda a: a["sum"])
    out = with_columns(out, {"n_words": F.size(w).cast("long"),
                             "n_hit": F.when((F.size(hits) > 0) & (F.col(once) >= 0), covered).otherwise(0).cast("long"),
                             hits_col: F.col(hits), **({words_col: F.col(w)} if words_col else {})})
    return with_columns(out.drop(w, hits, once), {
        "contaminated": (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))})


def contaminated_items(marked: DataFrame, benchmark: DataFrame, id_col: str, hits_col: str = "hits",
                       words_col: str = "words", window: int = WINDOW) -> DataFrame:
    """``marked`` (with its words) plus ``n_items`` and ``items`` (sorted ids
    of the items whose windows occur). Only rows with hits take part in the
    join; what is joined back is keyed by the id and the windows found.
    ``marked`` is read twice, so give it as a written table (``as_table``)."""
    windows = benchmark_windows(benchmark, window=window)
    found, key = fresh("found"), fresh("key")
    out = marked.withColumn(found, F.array_sort(F.array_distinct(F.transform(
        hits_col, lambda h: F.array_join(F.slice(words_col, h["at"] + 1, h["n"]), " ")))))
    out = out.withColumn(key, F.when(F.size(found) > 0, F.sha2(F.array_join(found, "\n"), 256)))
    hit = (out.where(F.size(found) > 0).select(F.col(f"`{id_col}`").alias("i"), F.col(key).alias("k"),
                                               F.explode(found).alias("words")).distinct())
    items = (hit.join(windows.select("item_id", "words"), "words")
             .groupBy("i", "k").agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    out = out.join(items, (out[key] == items["k"]) & out[id_col].eqNullSafe(items["i"]), "left").drop("i", "k", key, found)
    none = F.array().cast("array<string>")
    return with_columns(out, {"items": F.coalesce("items", none), "n_items": F.size(F.coalesce("items", none)).cast("long")})


def decontaminate(df: DataFrame, benchmark: DataFrame, text_col: str = "text", remove: str = "documents",
                  **rule) -> DataFrame:
    """``df`` without its contamination and with its own columns: without the
    contaminated documents, or (``remove="spans"``) with the hit words, and the
    separators after them, cut out of every text that has any."""
    w = fresh("words")
    hits = fresh("hits")
    names = {c: fresh(c) for c in ("n_words", "n_hit", "contaminated") if c in df.columns}
    kept = functools.reduce(lambda d, c: d.withColumnRenamed(c, names[c]), names, df)
    out = mark_contamination(kept, benchmark, text_col, hits_col=hits, **rule)
    if remove == "documents":
        out = out.where(~F.col("contaminated"))
    elif remove == "spans":
        t = f"`{text_col}`"
        # the parts of a text are cut once, then bound to a name
        cut = F.expr(f"""aggregate(array(struct(split({t}, '{_sql(RAW_WORD)}') AS s,
            array_remove(split({t}, '{_sql(RAW_BREAK)}'), '') AS w, {hits} AS h)), '', (z, d) ->
          array_join(concat(array(d.s[0]), filter(transform(d.w, (x, i) -> CASE
            WHEN exists(d.h, h -> i >= h.at AND i < h.at + h.n) THEN NULL
            ELSE concat(x, d.s[i + 1]) END), x -> x IS NOT NULL)), ''))""")
        out = out.withColumn(text_col, F.when(F.col("n_hit") > 0, cut).otherwise(F.col(t)))
    else:
        raise ValueError("remove is 'documents' or 'spans'")
    out = out.drop("n_words", "n_hit", "contaminated", hits, w)
    out = functools.reduce(lambda d, c: d.withColumnRenamed(names[c], c), names, out)
    return out.select(*[F.col(f"`{c}`") for c in df.columns])


def _sql(pattern: str) -> str:
    return pattern.replace("\\", "\\\\")
