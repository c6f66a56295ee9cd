"""A training corpus from raw documents, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; each result is
written as Parquet under ``spark.checkpoint.dir`` and read back as the next
stage's ``docs``. All but the last return the columns of ``docs``, whatever
their names (an operator's own columns never meet them); rows with null or
empty text pass every stage unchanged, and an empty table stays empty.

1. toxicity: documents that the classifier chain rejects go.
2. jaccard: of each group of near copies one document stays, the one with the
   least doc_id.
3. decontamination: documents that a benchmark contaminates go.
4. pii: personal data in the texts is replaced by its kind; ``n_chars``, where
   the table has it, follows the changed texts.
5. sentencepiece: token ids of each text (``tokens``), how many (``n_tokens``),
   and whether decoding them gives the text back (``round_trip``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bottomgrid.llm.common import as_table, fresh, with_columns
from bottomgrid.llm.decontaminate import decontaminate
from bottomgrid.llm.jaccard_rtree import keep_one_of_each_group
from bottomgrid.llm.pii_anchors import find_pii
from bottomgrid.llm.queries import PIECE_MODEL, TOXICITY_SAMPLE, documents, vocabulary
from bottomgrid.llm.sentencepiece_viterbi import sentencepiece_encode
from bottomgrid.llm.toxicity_chain import score_toxicity, train_toxicity

TEXT, ID = "text", "doc_id"


def own_columns(docs: DataFrame, op: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """``op(frame, id column)`` with every column but the text under a fresh
    name; its result with the columns of ``docs`` only."""
    safe = {c: c if c == TEXT else fresh("c") for c in docs.columns}
    out = op(docs.withColumnsRenamed(safe), safe[ID])
    return out.select(*[F.col(safe[c]).alias(c) for c in docs.columns])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train_toxicity(docs, labels, ID, TEXT, sample=TOXICITY_SAMPLE)
    return own_columns(docs, lambda d, _: score_toxicity(d, model, TEXT).where(~F.col("is_toxic")))


def jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return own_columns(docs, lambda d, i: keep_one_of_each_group(d, i, TEXT))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return own_columns(docs, lambda d, _: decontaminate(d, bench, TEXT))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    was = fresh("text")
    out = own_columns(docs.withColumn(was, F.col(TEXT)), lambda d, _: find_pii(d, TEXT, masked_col=TEXT))
    if "n_chars" not in docs.columns:
        return out.drop(was)
    kind = dict(docs.dtypes)["n_chars"]
    n = F.when(F.col(TEXT).eqNullSafe(F.col(was)), F.col("n_chars")).otherwise(F.length(TEXT).cast(kind))
    return out.withColumn("n_chars", n).select(*docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    decoded = fresh("decoded")
    out = sentencepiece_encode(docs, vocabulary(PIECE_MODEL), TEXT, decoded_col=decoded)
    same = F.col(decoded) == F.coalesce(F.col(TEXT), F.lit(""))
    return with_columns(out, {"n_tokens": F.size("tokens").cast("long"), "round_trip": same}).drop(decoded)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("jaccard", jaccard),
    ("decontamination", decontamination),
    ("pii", pii),
    ("sentencepiece", sentencepiece),
]

# SQL has neither the classifier nor the tokenizer; the stages are tested
# against brute-force versions instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = as_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
