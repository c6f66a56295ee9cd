"""Classifiers: held-out accuracy, and defined results without labels."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from bottomgrid.llm import queries as q
from bottomgrid.llm import toxicity_chain as tc
from bottomgrid.llm.quality_zstd import score_quality, train_quality
from bottomgrid.llm.toxicity_chain import fit_chain, run_chain, score_toxicity, train_toxicity

SF = "/root/testdata/sf0.01"
ODD = [(10**9, None), (10**9 + 1, ""), (10**9 + 2, "word " * 30_000), (10**9 + 1, "")]


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def test_quality_held_out(spark, labels):
    rows = q.op6_quality(spark, SF).collect()
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    right = np.mean([r.predicted == labels[r.doc_id].quality for r in held])
    assert len(held) > 50 and right > 0.9


def test_toxicity_held_out(spark, labels):
    held = [r for r in q.op9_toxicity(spark, SF).collect() if r.held_out and r.doc_id in labels]
    toxic = [r.is_toxic for r in held if labels[r.doc_id].toxic]
    clean = [r.is_toxic for r in held if not labels[r.doc_id].toxic]
    assert np.mean(toxic) > 0.5 and np.mean(clean) < 0.05


def test_toxicity_of_long_texts(spark):
    """Clean texts stay clean however many are joined, and one toxic text
    among them is found; all of the held-out fold, in the language's words."""
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = train_toxicity(docs.drop("lang"), labels, sample=q.TOXICITY_SAMPLE)
    held = [r for r in docs.join(labels, "doc_id").orderBy("doc_id").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    p = model.probabilities([r.text for r in held])[:, -1]
    assert np.mean([x >= 0.4 for x, r in zip(p, held) if r.toxic]) > 0.85
    assert np.mean([x >= 0.4 for x, r in zip(p, held) if not r.toxic]) < 0.01
    rng = np.random.default_rng(0)
    clean, mixed = [], []
    for lang in ("en", "de", "fr", "es"):
        # a text that is misjudged by itself says nothing about length
        good = [r.text for x, r in zip(p, held) if r.lang == lang and not r.toxic and x < 0.4]
        bad = [r.text for x, r in zip(p, held) if r.lang == lang and r.toxic and x >= 0.4]
        for chars in (60_000, 200_000):
            for _ in range(5):
                parts = []
                while sum(map(len, parts)) < chars:
                    parts.append(good[rng.integers(len(good))])
                clean.append("\n".join(parts))
                if bad:
                    half = len(parts) // 2
                    mixed.append("\n".join([*parts[:half], bad[rng.integers(len(bad))], *parts[half:]]))
    rejected = [np.mean(model.probabilities(x)[:, -1] >= 0.4) for x in (clean, mixed)]
    print("rejected: clean, mixed", rejected, len(clean), len(mixed))
    assert rejected[0] <= 0.05 and rejected[1] >= 0.9


def test_passages_cover_every_word_and_overlap():
    from bottomgrid.llm.toxicity_chain import PASSAGE, feature_hashes
    texts = [" ".join(f"w{k}" for k in range(n)) for n in (0, 1, PASSAGE, PASSAGE + 1, 5 * PASSAGE + 3)]
    h, passage, text = feature_hashes(texts)
    assert list(np.bincount(text)) == [1, 1, 1, 2, 10]
    sizes = np.bincount(passage, minlength=len(text)) // 5
    assert sizes.max() == PASSAGE and list(sizes[:4]) == [0, 1, PASSAGE, PASSAGE]


def test_without_labels_and_odd_rows(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "'s' AS score", "'p' AS p_toxic")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in score_quality(docs, train_quality(docs, none)).collect()] == [0.5] * 4
    model = train_toxicity(docs, none)
    assert not any(r.is_toxic for r in score_toxicity(docs, model).collect())
    some = spark.createDataFrame([(10**9, 1, 0), (10**9, 0, None), (None, 1, 1), (7, 1, 1)], "doc_id long, quality int, toxic int")
    assert score_quality(docs, train_quality(docs, some)).count() == 4
    assert score_toxicity(docs, train_toxicity(docs, some)).count() == 4
    real = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    own = spark.read.parquet(f"{SF}/labels.parquet")
    scored = score_quality(docs, train_quality(real, own)).collect()
    assert all(0 <= r.score <= 1 for r in scored) and scored[1].score == scored[3].score
    model = train_toxicity(real, own)
    got = score_toxicity(docs, model).collect()
    assert got[1].p_toxic == got[3].p_toxic == got[0].p_toxic
    assert score_toxicity(docs.limit(0), model).count() == 0


def test_chain_feeds_earlier_categories():
    """A later category that only follows an earlier one is learned through
    the chain, with out-of-fold probabilities."""
    rng = np.random.default_rng(0)
    x = rng.random((600, 4)) < 0.4
    first = x[:, 0] | x[:, 1]
    row, col = np.nonzero(x)
    models = fit_chain(row, col, 4, np.column_stack([first, first]), np.arange(600) % 5)
    assert models[1].chain[0] > 0.3 and len(models[0].chain) == 0
    p = run_chain(models, row, col, 600)
    assert ((p[:, 1] > 0.5) == first).mean() > 0.98


def test_toxic_rows_without_quality_are_learned(spark, labels):
    """Toxic rows whose finer category is unknown still train the verdict."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    own = spark.read.parquet(f"{SF}/labels.parquet").selectExpr("doc_id", "toxic", "if(toxic = 1, null, quality) AS quality")
    model = train_toxicity(docs, own)
    assert model.models and model.prior > 0
    held = [r for r in docs.collect() if r.doc_id in labels and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    p = model.probabilities([r.text for r in held])[:, -1]
    toxic = np.array([labels[r.doc_id].toxic == 1 for r in held])
    assert np.mean(p[toxic] >= 0.4) > 0.5 and np.mean(p[~toxic] >= 0.4) < 0.05


def plain_features(text):
    """Passages of a text as sets of strings: words, and stems by length."""
    import re
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    half = tc.PASSAGE // 2
    starts = range(0, max(len(words) - half, 1), half)
    return [{(0, w) for w in words[a:a + tc.PASSAGE]} |
            {(k, w.encode()[:k]) for w in words[a:a + tc.PASSAGE] for k in tc.STEMS} for a in starts]


def hash_of(feature):
    """The hash that the operator gives a feature, from one word of it."""
    kind, value = feature
    text = value if isinstance(value, str) else value.decode("utf-8", "surrogateescape")
    if not isinstance(value, str) and text.encode("utf-8", "surrogateescape") != value:
        return None
    try:
        h, _, _ = tc.feature_hashes([text])
    except UnicodeEncodeError:      # a stem that ends inside a character
        return None
    return int(h[[0, *tc.STEMS].index(kind)])


def test_chain_equals_plain_version(spark):
    """Features, passages, probabilities and verdicts of a plain version, row
    by row. Stems that end inside a character have no text of their own; the
    plain version takes their hashes from the whole words."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = train_toxicity(docs, labels)
    rows = docs.collect()
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    # training: the finder's features over whole texts, counted plainly
    train = [r for r in rows if toxic.get(r.doc_id) is not None and zlib.crc32(str(r.doc_id).encode()) % 5]
    n, pos = len(train), sum(toxic[r.doc_id] for r in train)
    df, hits = Counter(), Counter()
    for r in train:
        own = set().union(*plain_features(r.text))
        df.update(own)
        if toxic[r.doc_id]:
            hits.update(own)
    p = pos / n
    clear = {f for f, d in df.items() if d >= 2 and (abs(hits[f] - d * p) - 0.5) / np.sqrt(d * p * (1 - p)) >= tc.CLEAR}
    whole = docs.join(labels, "doc_id").where("pmod(crc32(cast(doc_id AS string)), 5) <> 0").select(
        F.col("text").alias("x"), F.col("toxic").alias("y0"))
    got = tc.choose_features(whole.withColumn("h", tc.distinct_features()), "y0", n, pos, 3000)
    assert len(clear) == len(got) and {h for f in clear if (h := hash_of(f)) is not None} <= set(got.tolist())
    # scoring: every passage by itself, a dictionary of weights
    weight = [dict(zip(model.vocabulary.tolist(), m.w)) for m in model.models]
    scored = {r.doc_id: r for r in score_toxicity(docs, model).collect()}
    for r in rows:
        best = np.zeros(len(model.models))
        words = tc.feature_hashes([r.text or ""])
        for k, passage in enumerate(plain_features(r.text)):
            h = set(words[0][words[1] == k].tolist())
            assert len(h) == len(passage)
            earlier, out = [], []
            for m, w in zip(model.models, weight):
                x = sum(w.get(i, 0.0) for i in h) + sum(a * b for a, b in zip(m.chain, earlier)) + m.b
                out.append(1 / (1 + np.exp(-np.clip(x, -30, 30))))
                earlier.append(tc.log_odds(np.array(out[-1])))
            best = np.maximum(best, out)
        s = scored[r.doc_id]
        assert np.allclose([s.p_toxic_prose, s.p_toxic_junk, s.p_toxic], best) and s.is_toxic == (s.p_toxic >= 0.4)
    caught = [scored[i].is_toxic for i, t in toxic.items() if t]
    wrong = [scored[i].is_toxic for i, t in toxic.items() if t == 0]
    assert sum(caught) >= 5 and sum(wrong) <= 1, (sum(caught), len(caught), sum(wrong))


def test_no_model_is_reported(spark):
    docs = spark.createDataFrame([(k, f"w{k}") for k in range(20)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "1 AS quality", "cast(doc_id < 10 AS int) AS toxic")
    with pytest.warns(UserWarning, match="no toxicity model"):
        model = train_toxicity(docs, labels)
    assert not model.models and model.missing
    assert {r.is_toxic for r in score_toxicity(docs, model).collect()} == {model.prior >= 0.4}


def test_threshold_ties():
    """A probability of exactly the threshold is a verdict."""
    model = tc.ChainModel(["toxic"], np.empty(0, np.uint64), [], 0.4)
    assert (model.probabilities(["a", "a", ""]) >= 0.4).all()


def test_learning_reads_whole_texts(spark):
    """What tells the kinds apart stands far behind the first 20,000
    characters of every text."""
    rng = np.random.default_rng(1)
    filler = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(400)]
    mark = {0: [f"kindly{k}" for k in range(8)], 1: [f"nasty{k}" for k in range(8)]}
    rows = []
    for k in range(120):
        own = list(rng.choice(filler, 4500))
        own[-60:] = [mark[k % 2][j % 8] for j in range(60)]
        rows.append((k, " ".join(own)))
    assert all(len(x) > 25_000 for _, x in rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 = 0 AS int) AS quality", "cast(doc_id % 2 AS int) AS toxic")
    held = {k for k, _ in rows if zlib.crc32(str(k).encode()) % 5 == 0}
    verdict = {r.doc_id: r.is_toxic for r in score_toxicity(docs, train_toxicity(docs, labels)).collect()}
    assert all(verdict[k] == bool(k % 2) for k in held)
    score = {r.doc_id: r.score for r in score_quality(docs, train_quality(docs, labels)).collect()}
    assert np.mean([(score[k] >= 0.5) == (k % 2 == 0) for k in held]) > 0.9


def test_quality_equals_plain_version(spark):
    """Scores of a plain version: each whole text compressed twice."""
    import zstandard
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    model = train_quality(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    assert len(model.weights)
    both = [zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False,
                                     write_checksum=False, write_dict_id=False) for d in (model.good, model.bad)]
    scored = {r.doc_id: r.score for r in score_quality(docs, model).collect()}
    for r in docs.collect():
        b = (r.text or "").encode()
        g, d = (len(c.compress(b)) for c in both)
        x = np.array([(d - g) / max(g, d), (d - g) / (len(b) + 1), min(g / (len(b) + 1), 3), min(d / (len(b) + 1), 3), np.log(len(b) + 1)])
        z = np.clip((x - model.center) / model.scale, -6, 6)
        terms = [1.0, *z, *[z[i] * z[j] for i in range(5) for j in range(i, 5)]]
        assert abs(scored[r.doc_id] - 1 / (1 + np.exp(-np.clip(np.dot(terms, model.weights), -30, 30)))) < 1e-9
