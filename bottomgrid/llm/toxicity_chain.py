"""Toxicity by a classifier chain.

The categories are predicted one after the other by linear (logistic) models
over the words of a text, and each model also gets the probabilities of the
categories before it. While training, these are out-of-fold: a row's earlier
probabilities come from models that did not see its fold, so later models
learn to trust them as far as they deserve. The last category is the verdict.

Features are the distinct words of the whole text and the first 4 to 7 bytes
of each (stems), as 64-bit hashes; of those whose association with the last
category is clear (``CLEAR`` standard deviations, after a continuity correction
that tells chance from habit where rows are few), the ``features`` clearest.

A text is judged by passages of ``PASSAGE`` words, each overlapping the next
by half, the same at every length of text: the weights of all features present
add up, so weak ones would pile up in a long text. A category's probability is
that of the text's highest passage.

Learning uses a bounded sample of labelled rows: at most ``sample``
(documented parameter; 10,000 in the query), outside the held-out fold; rows
are the only bound, their texts are read whole. A first model, of all words of
each row, finds each row's highest passage, and the chain learns from those, as
they decide when texts are scored. The model has a fixed size. Scoring reads
every whole text.

Null and empty texts have no words and get the probabilities of the empty
feature set. Without labelled rows of both kinds, or without any feature that
tells them apart, there is no model: training warns, ``model.missing`` says why,
and every probability is the share of toxic rows (0 without any). Rows are independent: repeated rows
agree, an empty table stays empty, and input columns with the names of the
results are replaced.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_from_text, as_table, breaks_at, list_array, struct_of_text, text_column
from .training import FOLDS, fold, sample_ids, sigmoid

BREAKS = breaks_at((0, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
STEMS = (4, 5, 6, 7)
PASSAGE = 256  # words
CLEAR = 3.0  # standard deviations
TEXT_BYTES = 1 << 20  # of the texts that are judged together, about

# The chain over the columns of the labels: abuse inside otherwise good text,
# abuse inside junk, abuse of any kind.
CATEGORIES: dict[str, Column | str] = {
    "toxic_prose": "toxic = 1 AND quality = 1",
    "toxic_junk": "toxic = 1 AND quality = 0",
    "toxic": "toxic = 1",
}


def feature_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word and stem hashes of the passages of all texts, the passage of each,
    and the text of each passage (a text of no word has one, empty, passage).
    Passage k of a text has its words from k half passages on; the last one is
    shorter, but longer than a half."""
    words, counts, *stems = word_parts(texts)
    row = np.repeat(np.arange(len(texts)), counts)
    half = (np.arange(len(words)) - (np.cumsum(counts) - counts)[row]) // (PASSAGE // 2)
    many = np.maximum(-(-counts // (PASSAGE // 2)) - 1, 1)
    base = (np.cumsum(many) - many)[row]
    one, two = base + np.minimum(half, many[row] - 1), base + np.maximum(half - 1, 0)
    more = np.flatnonzero(one != two)  # words of two passages
    salt = [np.uint64(k * 0x9E3779B97F4A7C15 & (2**64 - 1)) for k in range(len(stems) + 1)]
    hashes = [h ^ s for h, s in zip([words, *stems], salt)]
    return (np.concatenate([*hashes, *[h[more] for h in hashes]]),
            np.concatenate([np.tile(one, len(hashes)), np.tile(two[more], len(hashes))]),
            np.repeat(np.arange(len(texts)), many))


def word_parts(texts: list[str]) -> tuple[np.ndarray, ...]:
    from .common import word_hashes
    return word_hashes(texts, BREAKS, STEMS)


@dataclass
class Linear:
    """A logistic model: feature weights, weights of the earlier categories'
    log-odds, and the intercept."""
    w: np.ndarray
    chain: np.ndarray
    b: float

    def logit(self, sums: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        return sums + earlier @ self.chain + self.b


@dataclass
class ChainModel:
    categories: list[str]
    vocabulary: np.ndarray
    models: list[Linear] = field(default_factory=list)
    prior: float = 0.0
    missing: str = ""  # why there is no model

    def __post_init__(self):
        self.slot = np.zeros(1 << 18, bool)
        self.slot[(self.vocabulary & np.uint64((1 << 18) - 1)).astype(np.int64)] = True

    def presence(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, feature) of the vocabulary's features in each passage,
        once, and the text of each passage."""
        h, row, text = feature_hashes(texts)
        near = self.slot[(h & np.uint64((1 << 18) - 1)).astype(np.int64)]
        h, row = h[near], row[near]
        if not len(self.vocabulary):
            return row[:0], row[:0], text
        at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        hit = self.vocabulary[at] == h
        pairs = np.unique(row[hit] * len(self.vocabulary) + at[hit])
        return pairs // len(self.vocabulary), pairs % len(self.vocabulary), text

    def passages(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of each passage, and the first passage of each text."""
        row, col, text = self.presence(texts)
        return run_chain(self.models, row, col, len(text)), np.flatnonzero(np.diff(text, prepend=-1))

    def probabilities(self, texts: list[str]) -> np.ndarray:
        if not self.models or not texts:
            return np.full((len(texts), len(self.categories)), self.prior)
        p, first = self.passages(texts)
        return np.maximum.reduceat(p, first, axis=0)


def run_chain(models: list[Linear], row: np.ndarray, col: np.ndarray, n: int) -> np.ndarray:
    earlier = np.zeros((n, 0))
    out = []
    for m in models:
        sums = np.bincount(row, m.w[col], n)
        p = sigmoid(m.logit(sums, earlier))
        out.append(p)
        earlier = np.column_stack([earlier, log_odds(p)])
    return np.column_stack(out)


def log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit_linear(row: np.ndarray, col: np.ndarray, k: int, earlier: np.ndarray, y: np.ndarray,
               steps: int = 150, rate: float = 0.1, ridge: float = 1.0) -> Linear:
    """Full-batch logistic regression by Adam; deterministic."""
    n, c = len(y), earlier.shape[1]
    theta = np.zeros(k + c + 1)
    rate_y = min(max(y.mean(), 1e-3), 1 - 1e-3) if n else 0.5
    theta[-1] = np.log(rate_y / (1 - rate_y))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        z = np.bincount(row, theta[:k][col], n) + earlier @ theta[k:k + c] + theta[-1]
        e = sigmoid(z) - y
        g = np.concatenate([np.bincount(col, e[row], k), earlier.T @ e, [e.sum()]])
        g[:-1] += ridge * theta[:-1]
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        theta -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return Linear(theta[:k], theta[k:k + c], float(theta[-1]))


def fit_chain(row: np.ndarray, col: np.ndarray, k: int, labels: np.ndarray, folds: np.ndarray) -> list[Linear]:
    """One model per label column, of the rows where that label is known (not
    NaN); earlier probabilities are out-of-fold."""
    n = len(labels)
    earlier = np.zeros((n, 0))
    models = []

    def fit(rows: np.ndarray, y: np.ndarray) -> Linear:
        renumber = np.cumsum(rows) - 1
        inside = rows[row]
        return fit_linear(renumber[row[inside]], col[inside], k, earlier[rows], y[rows])

    for y in labels.T.astype(float):
        known = ~np.isnan(y)
        models.append(fit(known, y))
        out = np.zeros(n)
        for f in np.unique(folds):
            own = folds == f
            part = fit(known & ~own, y)
            sums = np.bincount(row, part.w[col], n)
            out[own] = sigmoid(part.logit(sums, earlier))[own]
        earlier = np.column_stack([earlier, log_odds(out)])
    return models


def choose_features(sample: DataFrame, label: str, n: int, positives: int, most: int) -> np.ndarray:
    """The hashes whose documents are toxic most clearly more often, or less
    often, than others: by a z-score with continuity correction of at least
    ``CLEAR``, in 2 documents or more; counted by Spark, at most ``most`` of
    them come back, sorted."""
    p = positives / n
    df, toxic = F.col("df"), F.col("toxic")
    z = (F.abs(toxic - df * p) - 0.5) / F.sqrt(df * (p * (1 - p)))
    counts = (sample.select(F.explode("h").alias("h"), F.col(label).alias("y"))
              .groupBy("h").agg(F.count("*").alias("df"), F.sum("y").alias("toxic")))
    best = counts.where((df >= 2) & (z >= CLEAR)).orderBy(z.desc(), "h").limit(most).select("h").collect()
    return np.sort(np.array([r.h for r in best], np.int64).view(np.uint64))


def columns_of(vocabulary: np.ndarray):
    """An Arrow function: positions in the vocabulary of a list of hashes."""
    def pick(lists: pa.Array) -> pa.Array:
        ends = np.asarray(lists.offsets)
        h = np.asarray(lists.flatten()).view(np.uint64)
        row = np.repeat(np.arange(len(lists)), np.diff(ends))
        at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
        hit = vocabulary[at] == h
        return list_array(at[hit].astype(np.int32), np.bincount(row[hit], minlength=len(lists)))

    pick.__annotations__ = {"lists": pa.Array, "return": pa.Array}
    return F.arrow_udf(pick, T.ArrayType(T.IntegerType()))


def distinct_features(finder=None) -> Column:
    """Distinct feature hashes of each text ``x``: of its highest passage by
    the broadcast model ``finder`` (of equals the first), without one of the
    whole text."""
    schema = T.StructType([T.StructField("h", T.ArrayType(T.LongType()))])

    def distinct(texts: list[str]) -> dict:
        h, passage, text = feature_hashes(texts)
        chosen = text
        if finder is not None:
            order = np.lexsort((-finder.value.passages(texts)[0][:, -1], text))
            chosen = np.full(len(text), -1)
            best = order[np.diff(text[order], prepend=-1) != 0]
            chosen[best] = text[best]
        row = chosen[passage]
        h, row = h[row >= 0], row[row >= 0]
        order = np.lexsort((h, row))
        h, row = h[order], row[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        return {"h": list_array(h[new].view(np.int64), np.bincount(row[new], minlength=len(texts)))}

    return struct_of_text(F.col("x"), schema, distinct, TEXT_BYTES)["h"]


def train_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   categories: dict[str, str] = CATEGORIES, sample: int = 6000, features: int = 3000) -> ChainModel:
    """Learn the chain from a bounded sample of the labelled documents."""
    names = list(categories)
    # a finer category that the labels leave open is null, and not learned from
    marked = labels.select(id_col, *[F.expr(c).cast("int").alias(f"y{k}") for k, c in enumerate(categories.values())])
    ys = [f"y{k}" for k in range(len(names))]
    ids = sample_ids(marked, id_col, ys, sample)
    text = F.coalesce(text_column(docs, text_col), F.lit(""))
    own = (docs.select(id_col, text.alias("x")).join(F.broadcast(ids), id_col)
           .groupBy(id_col).agg(*[F.max(c).alias(c) for c in ys], F.max("x").alias("x"))
           .select(id_col, fold(id_col).alias("f"), *ys, "x"))
    own = as_table(own, "labelled")
    sampled = as_table(own.withColumn("h", distinct_features()).drop("x"), "sampled")
    total = sampled.agg(F.count("*").alias("n"), F.sum(ys[-1]).alias("toxic")).first()
    n, positives = total["n"], int(total["toxic"] or 0)

    def no_model(why: str) -> ChainModel:
        warnings.warn(f"no toxicity model: {why}", stacklevel=2)
        return ChainModel(names, np.empty(0, np.uint64), [], positives / n if n else 0.0, why)

    if positives < 2 or positives > n - 2:
        return no_model(f"{positives} toxic of {n} labelled rows")

    def columns(sampled: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Table]:
        vocabulary = choose_features(sampled, ys[-1], n, positives, features)
        if not len(vocabulary):
            return vocabulary, vocabulary, vocabulary, None
        got = (sampled.select(id_col, "f", *ys, columns_of(vocabulary)("h").alias("c"))
               .orderBy(F.xxhash64(F.col(id_col).cast("string")), id_col).toArrow())
        lists = got["c"].combine_chunks()
        row = np.repeat(np.arange(n), np.diff(np.asarray(lists.offsets)))
        return vocabulary, row, np.asarray(lists.flatten()).astype(np.int64), got

    vocabulary, row, col, got = columns(sampled)
    if not len(vocabulary):
        return no_model("no word or stem tells toxic rows from others")
    finder = fit_linear(row, col, len(vocabulary), np.zeros((n, 0)), np.asarray(got[ys[-1]]).astype(float))
    finder = docs.sparkSession.sparkContext.broadcast(ChainModel(names[-1:], vocabulary, [finder], positives / n))
    sampled = as_table(own.withColumn("h", distinct_features(finder)).drop("x"), "sampled")
    vocabulary, row, col, got = columns(sampled)
    if not len(vocabulary):
        return no_model("no word or stem tells toxic passages from others")
    labels_ = np.column_stack([np.asarray(got[c]) for c in ys])
    models = fit_chain(row, col, len(vocabulary), labels_, np.asarray(got["f"]) % FOLDS)
    return ChainModel(names, vocabulary, models, positives / n)


def score_toxicity(df: DataFrame, model: ChainModel, text_col: str = "text", threshold: float = 0.4,
                   prefix: str = "p_", verdict_col: str = "is_toxic") -> DataFrame:
    """``df`` plus the probability of each category and the verdict: whether
    that of the last category reaches ``threshold``."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    names = [prefix + c for c in model.categories]
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in names])

    def run(texts: list[str]) -> dict:
        p = shared.value.probabilities(texts)
        return {c: p[:, k] for k, c in enumerate(names)}

    return add_from_text(df, text_col, schema, run, TEXT_BYTES).withColumn(verdict_col, F.col(names[-1]) >= threshold)
