"""One registered query per operator, over its whole table.

The queries are thin: each calls its operator with production parameters and
derives the columns of its contract. ``ORACLES`` holds DuckDB SQL where SQL
can express the result; the others are tested against libraries and brute
force, and the learned ones by held-out accuracy.
"""

from __future__ import annotations

import importlib.util
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe_duckdb import bpe_encode
from .common import as_table
from .decontaminate import contaminated_items, mark_contamination
from .jaccard_rtree import jaccard_groups
from .licenses import scan_licenses
from .line_rules import quality_rules
from .merkle_manifest import merkle_manifest
from .oracles import ORACLES
from .periodic_runs import periodic_runs
from .pii_anchors import BASE_KINDS, find_pii
from .quality_zstd import score_quality, train_quality
from .secret_scan import BASE_RULES, find_secrets
from .sentencepiece_viterbi import sentencepiece_encode
from .token_counts import over_limit, token_counts
from .toxicity_chain import score_toxicity, train_toxicity
from .training import fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

__all__ = ["ORACLES", "QUERIES"]

PIECE_MODEL = "piece_bpe_32k.model"
BYTE_BPE = "byte_bpe_50k.json"
BYTE_BPE_RANKS = "byte_bpe_multi_50k.tiktoken"
TOKEN_LIMIT = 1024


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file: $TOKENIZER_DIR, or the package that
    is installed with the files."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    if importlib.util.find_spec("public_tokenizers"):
        import public_tokenizers
        return public_tokenizers.path(name)
    return os.path.join("/opt/tokenizers", name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_sentencepiece(spark, sf_dir):
    """Token ids of every text, and what decoding them gives back."""
    out = sentencepiece_encode(documents(spark, sf_dir).select("doc_id", "text"), vocabulary(PIECE_MODEL),
                               decoded_col="decoded")
    return out.select(
        "doc_id", F.size("tokens").cast("long").alias("n_tokens"), "tokens",
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


@query
def op4_token_counts(spark, sf_dir):
    """Byte-level BPE token counts of every text."""
    out = token_counts(documents(spark, sf_dir).select("doc_id", "text"), vocabulary(BYTE_BPE))
    return over_limit(out, TOKEN_LIMIT).select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query
def op5_secrets(spark, sf_dir):
    """Secrets in every text."""
    out = find_secrets(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", *[f"n_{r.kind}" for r in BASE_RULES], "base_sha256", "spans")


@query
def op8_pii(spark, sf_dir):
    """Personal data in every text."""
    out = find_pii(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans")


@query
def op3_decontamination(spark, sf_dir):
    """Benchmark words in every text, and the items they come from."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    out = mark_contamination(documents(spark, sf_dir).select("doc_id", "text"), bench, words_col="words")
    # only the words of texts with hits are needed from here on; written once,
    # as the items are counted and joined back
    out = as_table(out.select("doc_id", "n_words", "n_hit", "contaminated", "hits",
                              F.when(F.size("hits") > 0, F.col("words")).alias("words")), "marked")
    out = contaminated_items(out, bench, "doc_id")
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query
def op7_quality_rules(spark, sf_dir):
    """Line-first quality rules for every text."""
    out = quality_rules(documents(spark, sf_dir).select("doc_id", "text"), cleaned_col=None)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


@query
def op10_licenses(spark, sf_dir):
    """Licence notices in every text."""
    out = scan_licenses(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "license", F.round("dice", 6).alias("dice"), "n_matches", "licenses")


# labelled rows that a model learns from, at most
QUALITY_SAMPLE = 6000
TOXICITY_SAMPLE = 10_000


@query
def op6_quality(spark, sf_dir):
    """Quality score of every text, with labels of the held-out fold unseen."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = train_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), sample=QUALITY_SAMPLE)
    out = score_quality(docs, model)
    return out.select("doc_id", F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op9_toxicity(spark, sf_dir):
    """Toxicity of every text by the classifier chain."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = train_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), sample=TOXICITY_SAMPLE)
    out = score_toxicity(docs, model)
    return out.select("doc_id", F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"), "p_toxic_prose", "p_toxic_junk",
                      "p_toxic", "is_toxic")


@query
def op2_ngram_jaccard(spark, sf_dir):
    """Set size and component of every text."""
    out = jaccard_groups(documents(spark, sf_dir))
    return out.select("doc_id", "n_shingles", "component_id")


def id_crc(id_col: str = "doc_id"):
    """Unsigned crc32 of the id in decimal; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary"))


@query
def op11_merkle_manifest(spark, sf_dir):
    """Leaf, roots and proof of every document; every second one is checked
    against a copy that lost its line breaks."""
    docs = documents(spark, sf_dir)
    spoilt = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    copy = F.when(id_crc() % 2 == 0, spoilt).otherwise(F.col("text"))
    return merkle_manifest(docs, altered={"text": copy})


def looped(docs: DataFrame) -> DataFrame:
    """The documents, of which a tenth repeat the words of a stretch from some
    word on; such texts have their words joined by one space."""
    words = F.filter(F.split(F.col("text"), r"[ \t\n\x0B\f\r]+"), lambda w: w != "")
    out = docs.withColumns({"h": id_crc(), "words": F.when(id_crc() % 10 == 0, words)}).withColumn("n", F.size("words"))
    chosen = F.col("n") > 0
    out = out.withColumn("a", F.when(chosen, F.expr("(h div 10) % n")))
    out = out.withColumn("p", F.when(chosen, F.expr("1 + (n - a) div (3 + (h div 10) % 8)")))
    from_word = F.expr("transform(sequence(0, n - 1), i -> words[CAST(IF(i < a, i, a + (i - a) % p) AS INT)])")
    return out.withColumn("text", F.when(chosen, F.array_join(from_word, " ")).otherwise(F.col("text"))).select("doc_id", "text")


@query
def op12_periodic_runs(spark, sf_dir):
    """Periodic runs of the words of every document, and the text without
    their repetitions."""
    out = periodic_runs(looped(documents(spark, sf_dir)))
    # the greatest length / period, compared without rounding; runs come by
    # start and period, so of equals the first stays
    best = F.aggregate(F.col("runs"), F.lit(None).cast("struct<start:long,length:long,period:long>"), lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    out = out.withColumn("best", best)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op13_byte_bpe(spark, sf_dir):
    """Ids of every text by the multilingual ranks, and what they decode to."""
    out = bpe_encode(documents(spark, sf_dir).select("doc_id", "text"), vocabulary(BYTE_BPE_RANKS),
                     tokens_col=None, packed_col="ids", decoded_col="decoded")
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
