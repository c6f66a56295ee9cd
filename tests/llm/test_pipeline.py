"""The pipeline against a brute-force version of its deterministic stages,
and stage by stage on awkward tables."""

import corpus_pipeline as cp
import pytest
from test_jaccard import plain_groups  # noqa: F401  (same folder)
from test_native import plain_contamination
from test_text_rows import plain_pii

from bottomgrid.llm import queries as q
from bottomgrid.llm.pii_anchors import Finder, mask_text

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, is_toxic string, hits int, n_words string, spans string, node int, n_chars long"


def test_registered():
    import __spark_entry__ as entry
    got = entry.queries()
    assert got["pipeline"] is cp.run and all(any(n.startswith(f"op{k}_") for n in got) for k in range(1, 11))


def test_run_equals_brute_force(spark):
    import sentencepiece
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean = cp.toxicity(spark, docs, SF).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in clean}
    assert sum(labels.get(i) == 0 for i in gone) <= 1
    rows = [(r.doc_id, r.text) for r in clean]
    stay = [(i, x) for (i, x), (_, _, c) in zip(rows, plain_groups(rows)) if c == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    stay = [r for r, c in zip(stay, plain_contamination(items, [x for _, x in stay])) if not c[3]]
    finder = Finder()
    sp = sentencepiece.SentencePieceProcessor(model_file=q.vocabulary(q.PIECE_MODEL))
    want = {}
    for i, x in stay:
        masked = mask_text(x, finder(x))
        assert not plain_pii(x) or masked != x
        want[i] = (masked, len(masked), sp.encode(masked))
    got = {r.doc_id: (r.text, r.n_chars, r.tokens) for r in cp.run(spark, SF).collect()}
    assert got == want and len(gone) > 0 and len(want) < len(rows)


def test_stages_keep_columns_and_odd_rows(spark):
    odd = [(1, None), (2, ""), (3, "solo text"), (3, "solo text"), (None, "no id at all here"), (None, None)]
    docs = spark.createDataFrame([(*r, None, "t", None, "w", "s", 4, 9) for r in odd], COLUMNS)
    for frame, n in ((docs, 5), (docs.limit(0), 0)):
        out = frame
        for name, stage in cp.STAGES:
            out = stage(spark, out, SF)
            if name != "sentencepiece":
                assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        got = out.collect()
        assert len(got) == n, got
        assert all(r.is_toxic == "t" and r.node == 4 and r.n_chars == 9 for r in got)


@pytest.mark.parametrize("name", [n for n, _ in cp.STAGES])
def test_stage_names(name):
    assert name in ("toxicity", "jaccard", "decontamination", "pii", "sentencepiece")


def test_last_stage_decodes(spark):
    texts = [None, "", "a  b\n c", "mail <EMAIL> é 😀", "a\u2581b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'x' AS round_trip")
    out = cp.sentencepiece(spark, docs, SF)
    assert sorted(out.columns) == ["doc_id", "n_tokens", "round_trip", "text", "tokens"]
    # the model writes spaces as U+2581, so that one comes back as a space
    assert [r.round_trip for r in out.orderBy("doc_id").collect()] == [True, True, True, True, False]
