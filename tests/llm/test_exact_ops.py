"""Merkle manifest, periodic runs and byte-level BPE against plain versions and
the tiktoken library, with nulls, empty, long and repeated texts, clashing
columns and empty tables."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from bottomgrid.llm import queries as q
from bottomgrid.llm.bpe_duckdb import Tokenizer, bpe_decode, bpe_encode, load
from bottomgrid.llm.merkle_manifest import Ranks, fold, merkle_manifest, pack, unpack
from bottomgrid.llm.periodic_runs import periodic_runs, runs_and_rest

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# --- Merkle manifest -------------------------------------------------------

def plain_field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def plain_way(levels, i):
    runs = []
    for nodes in levels[:-1]:
        runs.append((i % 3, nodes[i // 3 * 3:i // 3 * 3 + 3]))
        i //= 3
    return runs


def plain_manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, sha(*map(plain_field, r)), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    rank = {g: sorted(groups[g], key=lambda x: x[:3]) for g in order}
    trees = [plain_tree([x[2] for x in rank[g]]) for g in order]
    top = plain_tree([t[-1][0] for t in trees])
    out = []
    for k, g in enumerate(order):
        for i, (_, _, leaf, r) in enumerate(rank[g]):
            way = plain_way(trees[k], i) + plain_way(top, k)
            text = r[4]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = sha(*map(plain_field, (*r[:4], text)))
            for j, run in way:
                node = sha(*run[:j], node, *run[j + 1:])
            proof = "".join(x for j, run in way for x in run[:j] + run[j + 1:])
            out.append((r[0], leaf, trees[k][-1][0], top[-1][0], sha(proof), node, node == top[-1][0]))
    return sorted(out, key=str)


def manifest(df, **kw):
    copy = F.when(q.id_crc() % 2 == 0, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return sorted(map(tuple, merkle_manifest(df, altered={"text": copy}, **kw).collect()), key=str)


ODD_ROWS = [
    (None, None, None, None, None), (None, None, "a", 1, "x\ny"), (None, "s1", None, 2, ""), (5, "s1", "en", 3, "a\n"),
    (5, "s1", "en", 3, "a\n"), (5, "s1", "en", 4, "b"), (6, "s1", "en", 3, "zz"), (-7, "s1", "de", 1, "q\n"),
    (10**12, "s1", "de", 1, "q"), (1, "é", "x", 1, "t"), (2, "z", "x", 1, "t" * 100_000), (3, "", "x", 1, "\n")]


@pytest.mark.parametrize("levels", [1, 6])
def test_manifest_equals_plain_version(spark, levels):
    hot = [(3 * i, "h" if i % 3 else "k", "en", i, "t\n" * (i % 2)) for i in range(1500)]
    repeats = [(i % 7, "h2", "en", i % 5, "d") for i in range(200)]  # ids many rows share
    for rows in (ODD_ROWS, hot + repeats, [(1, "a", "b", 2, "c\n")], []):
        assert manifest(spark.createDataFrame(rows, COLUMNS), levels=levels) == plain_manifest(rows)


def test_manifest_query_and_proofs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = q.op11_merkle_manifest(spark, SF)
    assert sorted(map(tuple, got.collect()), key=str) == plain_manifest(rows)
    assert 0 < got.where("NOT verified").count() < len(rows)
    clash = docs.withColumns({"leaf": F.lit("x"), "root": F.lit(1), "grp": F.lit(2), "idx": F.lit(3)})
    for r in merkle_manifest(clash, proofs=True).collect():
        assert fold(r.leaf.encode(), r.proof.encode(), r.steps).decode() == r.root == r.folded_root and r.verified
        assert sha(r.proof) == r.proof_sha256


def test_bitmap_ranks():
    rnd = np.random.default_rng(2)
    for n in (1, 5, 4095, 4096, 20_000, 65_536):
        low = np.sort(rnd.choice(65_536, n, replace=False))
        data = pack(low)
        assert len(data) == min(2 * n, 8192) and (unpack(data) == low).all()
        ask = rnd.integers(0, 65_536, 500)
        assert (Ranks(data)(ask) == np.searchsorted(low, ask)).all()


# --- periodic runs ---------------------------------------------------------

def plain_runs(words):
    least = {}
    for p in range(1, len(words) // 4 + 1):
        i = 0
        while i < len(words) - p:
            j = i
            while j < len(words) - p and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(6, 4 * p):
                least.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted((s, n, p) for (s, n), p in least.items())


def plain_rest(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(rnd):
    out = []
    for _ in range(rnd.randint(0, 5)):
        if rnd.random() < 0.5:
            p = rnd.choice([1, 2, 3, 5, 7, 8, 9, 11, 15, 16, 17, 20, 31, 32, 33, 40])
            one = [rnd.choice(rnd.choice(["ab", "abc", "abcdefghijklmnop"])) for _ in range(p)]
            if rnd.random() < 0.4 and p > 6:  # a period that nearly repeats inside itself
                one = (one[:rnd.randint(1, 3)] * p)[:p - 1] + ["z"]
            if rnd.random() < 0.3 and p > 8:
                one = one[:p // 2] * 2 + one[:1]
            out += (one * 8)[:rnd.randint(2 * p, 7 * p)]
        else:
            out += [rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 40))]
    return out


def test_runs_equal_all_lags():
    rnd = random.Random(5)
    for _ in range(150):
        texts = [repetitive(rnd) for _ in range(rnd.randint(1, 12))]
        n, number, start, length, period, rest = runs_and_rest([" ".join(t) for t in texts])
        runs = list(zip(start.tolist(), length.tolist(), period.tolist()))
        for t, m, k, left in zip(texts, number.tolist(), n.tolist(), rest):
            own, runs = runs[:m], runs[m:]
            assert (own, k, left.decode()) == (plain_runs(t), len(t), plain_rest(t, own))


def test_runs_of_rows(spark):
    texts = [None, "", " \t\n", "a", "A a A a A a", "x x x x x x", "one two " * 50_000, "\u00a0 \u00a0 \u00a0 \u00a0 \u00a0 \u00a0", "x x x x x x"]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'mine' AS runs", "2 AS n_words")
    got = {r.doc_id: r for r in periodic_runs(df).collect()}
    for i, t in rows:
        words = (t or "").encode().split()
        runs = plain_runs(words) if len(words) < 100 else [(0, 100_000, 2)]
        assert [tuple(x) for x in got[i].runs] == runs and got[i].n_words == len(words)
        assert got[i].collapsed == plain_rest([w.decode() for w in words], runs)
    assert periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_runs_query_equals_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in q.op12_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs) and any(r.n_runs for r in got.values())
    for d in docs:
        words = [w.decode() for w in (d.text or "").encode().split()]
        h, n = zlib.crc32(str(d.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        want = (len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
                sha("".join(f"{s},{m},{p}\n" for s, m, p in runs)), sha(plain_rest(words, runs)))
        assert tuple(got[d.doc_id])[1:] == want


# --- byte-level BPE --------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken
    path = q.vocabulary(q.BYTE_BPE_RANKS)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return path, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_library(library):
    path, enc = library
    tok = Tokenizer(load(path))
    rnd = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = ["", "a", " " * 1000 + "z", "x" * 3000, "日本語 😀é", "the the", "ab" * 500, "abc" * 300, "=-" * 300, "<|endoftext|>"]
    texts += ["".join(rnd.choice("abeéß日 \n'1tnsr=-") for _ in range(rnd.randint(0, 80))) for _ in range(2000)]
    texts += ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 200))) for _ in range(200)]  # long and short words
    texts += ["".join(rnd.choice(letters) for _ in range(20_000)), "".join(chr(rnd.randint(0x3041, 0x3096)) for _ in range(20_000))]
    texts += [chr(c) + "a" + chr(c) * 2 + " " + chr(c) + "s'" + chr(c) + "1" + chr(c)
              for c in range(1, 0x40000, 7) if not 0xD800 <= c < 0xE000]
    got = tok.encode(texts)
    for x, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() == enc.encode_ordinary(x), repr(x[:60])
    assert tok.decode(got) == [x.encode() for x in texts]
    with pytest.raises(ValueError):
        tok.decode([(10**6).to_bytes(4, "little")])


def test_bpe_of_rows(spark, library):
    path, enc = library
    texts = [None, "", "the the", "the the", "don't  stop\n\n", "word " * 20_000]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'mine' AS tokens", "1 AS decoded")
    out = bpe_encode(df, path, packed_col="packed", decoded_col="decoded")
    assert out.columns.count("tokens") == out.columns.count("decoded") == 1
    got = {r.doc_id: r for r in bpe_decode(out, path, "tokens", "again").collect()}
    for i, t in rows:
        assert got[i].tokens == enc.encode_ordinary(t or "")
        assert got[i].packed == np.array(got[i].tokens, "<u4").tobytes()
        assert got[i].decoded == got[i].again == (t or "").encode()
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe_decode(bpe_encode(empty, path), path).count() == 0


def test_bpe_query(spark, library):
    path, enc = library
    got = {r.doc_id: r for r in q.op13_byte_bpe(spark, SF).collect()}
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = enc.encode_ordinary(d.text or "")
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[d.doc_id].decoded_sha256 == sha(d.text or "")
