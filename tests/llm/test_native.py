"""Native operators against brute force in plain Python."""

import collections
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from bottomgrid.llm import queries as q
from bottomgrid.llm.decontaminate import contaminated_items, decontaminate, mark_contamination
from bottomgrid.llm.licenses import MARKERS, TEMPLATES, bigrams, scan_licenses, size_range, template_grams
from bottomgrid.llm.line_rules import quality_rules

SF = "/root/testdata/sf0.001"
PYTHON = ("Python", "Pandas", "Arrow")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not any(p in plan for p in PYTHON)


def bench_words(x):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (x or "").translate(ASCII_LOWER))


def plain_contamination(items, texts):
    win = collections.defaultdict(set)
    for i, x in items:
        w = bench_words(x)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            win[tuple(w[k:k + n])].add(str(i))
    out = []
    for x in texts:
        w, hit, ids = bench_words(x), set(), set()
        for n in {len(k) for k in win}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in win:
                    hit |= set(range(k, k + n))
                    ids |= win[tuple(w[k:k + n])]
        out.append((len(w), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(w)))
    return out


ITEMS = [(1, "A b c d e f g h i j k l m n O"), (2, "Short item's"), (3, None), (4, "...!"), (5, "b C d e f g h i j k l m n"),
         (6, "q\\uote 'it' É é")]
TEXTS = [None, "", "a b c d e f g h i j k l m n o", "x short, ITEM-s y", "short item x", "x " * 500 + "short item s",
         "x " * 900 + "short item s", "a b c d e f g h i j k l m N o a b c d e f g h i j k l m", "q uote it É é", "q uote it é é",
         "a b c d e f g h i j k l m n o"]


@pytest.mark.parametrize("max_windows", [1000, 0])
def test_contamination_both_ways(spark, max_windows):
    bench = spark.createDataFrame(ITEMS, "item_id int, text string")
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").selectExpr("*", "'z' AS n_hit", "1 AS words")
    marked = mark_contamination(docs, bench, words_col="words", max_windows=max_windows)
    assert no_python(marked)
    got = {r.doc_id: r for r in contaminated_items(marked, bench, "doc_id").collect()}
    for i, (n, hit, ids, bad) in enumerate(plain_contamination(ITEMS, TEXTS)):
        assert (got[i].n_words, got[i].n_hit, got[i]["items"], got[i].contaminated) == (n, hit, ids, bad), TEXTS[i]
    left = decontaminate(docs, bench, max_windows=max_windows)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {i for i, r in got.items() if not r.contaminated}
    cut = {r.doc_id: r for r in decontaminate(docs, bench, remove="spans", max_windows=max_windows).collect()}
    assert cut[0].text is None and cut[3].text == "x y" and cut[4].text == "short item x" and cut[2].text == ""
    assert cut[3].n_hit == "z"


def test_contamination_empty_inputs(spark):
    bench = spark.createDataFrame(ITEMS, "item_id int, text string")
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    assert mark_contamination(docs.limit(0), bench).count() == 0
    for most in (1000, 0):
        none = mark_contamination(docs, bench.limit(0), max_windows=most).collect()
        assert len(none) == len(TEXTS) and not any(r.contaminated or r.n_hit for r in none)


def test_contamination_of_repeated_items(spark):
    """Rows that share an item_id are one item with the windows of both; equal
    rows are one row."""
    a, b = " ".join(f"a{k}" for k in range(15)), " ".join(f"b{k}" for k in range(14))
    bench = spark.createDataFrame([(1, a), (1, b), (1, b), (None, "lone words here"), (2, None)], "item_id int, text string")
    docs = spark.createDataFrame([(1, a + " x " + b), (2, "x y lone words here"), (3, b)], "doc_id long, text string")
    for most in (1000, 0):
        marked = mark_contamination(docs, bench, words_col="words", max_windows=most)
        got = {r.doc_id: r for r in contaminated_items(marked, bench, "doc_id").collect()}
        assert [(got[k].n_hit, got[k]["items"], got[k].contaminated) for k in (1, 3)] == [(29, ["1"], True), (14, ["1"], True)]
        assert got[2].n_hit == 3 and got[2].contaminated


def test_contamination_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = plain_contamination(items, [r.text for r in docs])
    got = {r.doc_id: r for r in q.op3_decontamination(spark, SF).collect()}
    for r, (n, hit, ids, bad) in zip(docs, want):
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        assert tuple(got[r.doc_id])[1:] == (n, hit, len(ids), digest, bad)
    assert any(w[3] for w in want)


def plain_rules(x):
    w = re.findall(r"[^\x20\x09-\x0D]+", x or "")
    at = collections.defaultdict(list)
    for k in range(len(w) - 2):
        at[tuple(w[k:k + 3])].append(k)
    cover = {k + d for p in at.values() if len(p) > 1 for k in p for d in range(3)}
    lines = [line for line in (x or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x or "")), len(lines) - len(set(lines)), len(cover),
            len(w) < 50 or 100 * len(cover) > 50 * len(w))


GOOD = "\n".join(" ".join(f"word{k}{c}" for c in "abcdefgh") + "." for k in range(12))


def test_line_rules(spark):
    docs = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    made = [None, "", " \n\t\n", "a b c a b c", "a a a a a", "x\nx\n x\nx", "😀 é b", GOOD, GOOD, "word " * 30_000,
            GOOD + "\n" + "Home | About | Contact | Login | Help\n" * 2, "\n".join(["A | b | c | d and some more words"] * 3 + [GOOD[:400]] * 1),
            "\n".join(f"BUY{chr(65 + k)} NOW{chr(65 + k)} TODAY!! CHEAP!!" for k in range(26))]
    texts = made + docs
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'k' AS kept", "0 AS n_words")
    out = quality_rules(df)
    assert no_python(out)
    got = {r.doc_id: r for r in out.collect()}
    for i, x in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_rules(x), repr(x)[:80]
        assert not (r.base_failed and r.kept)
    assert got[7].kept and got[7].cleaned == GOOD and got[8].kept
    assert got[10].cleaned.strip() == GOOD and got[10].kept
    assert not got[12].base_failed and not got[12].kept and got[12].lost_chars == got[12].word_chars
    assert quality_rules(df.limit(0)).count() == 0


def test_license_templates_match_and_others_do_not(spark):
    plain = "This line is about nothing in particular, and it is long enough to be compared with templates."
    texts = [t for _, t in TEMPLATES] + [None, "", "!!!", "mit", plain, plain + "\n" + TEMPLATES[0][1] + "\n" + plain,
                                         "intro\n\nThis work is licensed under\nthe GNU General Public License,\nversion 3.\n\nend",
                                         "word " * 20_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "0 AS dice")
    out = scan_licenses(df)
    assert no_python(out)
    got = {r.doc_id: r for r in out.collect()}
    n = len(TEMPLATES)
    for i, (name, _) in enumerate(TEMPLATES):
        assert got[i].license == name and got[i].dice == 1.0, TEMPLATES[i]
    assert all(got[i].license is None and got[i].n_matches == 0 and got[i].licenses == "" for i in (*range(n, n + 5), n + 7))
    assert got[n + 5].license == "MIT" and got[n + 5].n_matches == 1
    assert got[n + 6].license == "GPL-3.0"
    assert scan_licenses(df.limit(0)).count() == 0


def plain_units(text):
    """Normalised lines, paragraphs, sentences and neighbouring sentences."""
    paras = re.split(r"\n[\x20\t\r]*\n", text)
    cut = [re.sub(r"([.!?])[\x20\t\r\n]+", "\\1\x01", p).split("\x01") for p in paras]
    units = text.split("\n") + paras + [x for s in cut for x in s + [f"{a} {b}" for a, b in zip(s, s[1:])]]
    return [u for u in dict.fromkeys(" ".join(w for w in re.split("[^a-z0-9]+", u.lower()) if w) for u in units) if u]


def _order(w):
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:]))) or w


def allowed(name, joined):
    must, never = MARKERS.get(name, ((), None))
    return all(re.search(m, joined) for m in must) and not (never and re.search(never, joined))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_license_scores_equal_all_pairs(spark, sf):
    """Size bounds and key words prune nothing that could reach the threshold."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text")
    if sf == "sf0.1":      # whatever names a licence at all
        docs = docs.where("lower(text) rlike 'licen|gnu |copyright|apache|spdx|creative commons'")
    got = {r.doc_id: r for r in scan_licenses(docs).collect()}
    grams = [(name, set(template_grams(t))) for name, t in TEMPLATES]
    for r in docs.collect():
        hits = []
        for unit in plain_units(r.text):
            g = set(bigrams(unit.split()))
            j = " | ".join(_order(unit.split()))
            best = max(((2 * len(g & t) / (len(g) + len(t)), -k) for k, (n, t) in enumerate(grams) if allowed(n, j)), default=(0, 0))
            if best[0] >= 0.8:
                hits.append(best)
        assert got[r.doc_id].n_matches == len(hits)
        if hits:
            assert got[r.doc_id].license == grams[-max(hits)[1]][0] and abs(got[r.doc_id].dice - max(hits)[0]) < 1e-12
        else:
            assert got[r.doc_id].license is None
    assert size_range(6, 0.8) == (4, 9) and size_range(5, 0.8) == (4, 7)


NEAR = [
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    ("This work is licensed under the GNU General Public License, version 1.", None),
    ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", "CC-BY-NC-ND-4.0"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License.", "CC-BY-NC-SA-3.0"),
    ("This work is licensed under a Creative Commons Attribution 3.0 International License.", "CC-BY-3.0"),
    ("This work is licensed under a Creative Commons Attribution 1.0 International License.", None),
    ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0"),
    ("This project is licensed under the terms of the BSD license.", "BSD"),
    ("This project is licensed under the terms of the ACME license.", None),
    ("Licensed under the Apache License, Version 1.1.", "Apache-1.1"),
]


def test_license_siblings_are_not_taken_for_each_other(spark):
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(NEAR)], "doc_id long, text string")
    got = {r.doc_id: r.license for r in scan_licenses(df).collect()}
    assert [got[i] for i in range(len(NEAR))] == [name for _, name in NEAR]


INSIDE = [
    ("Copyright (c) 2020 Some Body. Released under the MIT License.", "MIT"),
    ("The tables below are kept by volunteers. This project is licensed under the terms of the MIT license. Please report mistakes.", "MIT"),
    ("Words before it.\nLicensed under the Apache\nLicense, Version 2.0. Words after it,\nand more of them.", "Apache-2.0"),
    ("Read this! Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
     "with the License. You may obtain a copy of the License at the usual place. Thanks for reading.", "Apache-2.0"),
    ("MIT License", "MIT"), ("The MIT License (MIT)", "MIT"), ("# MIT License\n\nCopyright (c) 2020 Some Body", "MIT"),
    ("// SPDX-License-Identifier: MIT", "MIT"), ("# SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0"),
    ("/* SPDX-License-Identifier: Apache-2.0 */", "Apache-2.0"), ("SPDX-License-Identifier: ACME", None),
    ("SPDX-License-Identifier: LGPL-3.0", "LGPL-3.0"), ("SPDX-License-Identifier: AGPL-3.0-or-later", "AGPL-3.0"),
    ("He went to MIT. His license was taken away.", None), ("GNU General Public License, Version 4", None),
    ("BSD 3-Clause License", "BSD"), ("Mozilla Public License Version 2.0", "MPL-2.0"),
]


def test_license_notices_between_other_words(spark):
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(INSIDE)], "doc_id long, text string")
    got = {r.doc_id: r.license for r in scan_licenses(df).collect()}
    assert [got[i] for i in range(len(INSIDE))] == [name for _, name in INSIDE]


PROSE = [
    "The children baked cookies with their mother.", "He wants to log in every evening from home now.",
    "She asked him to click here and there on the old map.", "Der Browser war ein alter Mann aus dem Dorf.",
    "Wir wollen uns morgen im Rathaus anmelden.", "Elle voulait accepter son invitation au bal.",
    "Quiero aceptar el regalo de mi abuela.", "The author holds the copyright of every picture in it.",
    "Sie lasen das Newsletter ihrer Schule am Abend."]
NOTICE_LINES = [
    "All rights reserved.", "© 2024 Example Ltd. Privacy policy", "This website uses cookies. Accept all", "Log in or sign up to comment",
    "Diese Webseite verwendet Cookies. Akzeptieren", "Alle Rechte vorbehalten.", "Anmelden oder registrieren",
    "Ce site web utilise des cookies. Accepter", "TOUS DROITS RÉSERVÉS", "Iniciar sesión o registrarse",
    "Este sitio web usa cookies: política de privacidad", "Subscribe to our newsletter: click here",
    "Please enable JavaScript to view this website."]


def test_notices_go_and_prose_stays(spark):
    from bottomgrid.llm.line_rules import line_verdict
    lines = PROSE + NOTICE_LINES
    df = spark.createDataFrame(list(enumerate(lines)), "i long, x string").select("i", line_verdict(F.col("x")).alias("v"))
    got = {r.i: r.v for r in df.collect()}
    assert [got[i] for i in range(len(lines))] == [None] * len(PROSE) + ["boilerplate"] * len(NOTICE_LINES)
    text = "\n".join(PROSE * 3)
    kept = quality_rules(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert kept.lost_chars == 0 and kept.cleaned == text


def test_license_key_words_lose_no_match():
    from bottomgrid.llm.licenses import key_words
    sets = [template_grams(t) for _, t in TEMPLATES]
    keys = set(key_words(sets, 0.8))
    for g in sets:
        touched = sum(bool(keys & set(x.split(" "))) for x in g)
        assert touched + size_range(len(g), 0.8)[0] > len(g)
