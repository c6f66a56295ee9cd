"""The Jaccard join against all pairs, and its R-tree against plain bounds."""

import random

import numpy as np
import pytest

from bottomgrid.llm.jaccard_rtree import (CountRTree, count_vector, jaccard_groups, join_block, keep_one_of_each_group,
                                          linked, may_link, shingle_sets)


def plain_groups(rows):
    import re
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, x in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (x or "").translate(lower))
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def near_copies(rnd, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rnd.randint(0, edits)):
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(10**6)}"
        if rnd.random() < 0.2:
            w = w[:rnd.randint(len(w) * 7 // 10, len(w))]
        out.append(" ".join(w))
    return out


def corpus(seed, hot):
    rnd = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    new = lambda n: [rnd.choice(vocab) for _ in range(n)]
    texts = [None, "", " \n", "one", "one", "two words", "A b c d", "a B c d", "a b c d e"]
    texts += near_copies(rnd, new(120), hot, 6)
    for _ in range(20):
        texts += near_copies(rnd, new(rnd.randint(5, 300)), rnd.randint(2, 5), 3)
    passage = new(60)
    texts += [" ".join(new(30) + passage + new(rnd.randint(5, 60))) for _ in range(60)]
    texts += [" ".join(passage)] * 5 + [" ".join(new(4000))] * 2
    rnd.shuffle(texts)
    return [(k * 3 + 1, x) for k, x in enumerate(texts)]


@pytest.mark.parametrize("block", [1000, 16])
def test_components_equal_all_pairs(spark, block):
    """With small blocks the large group is cut at random, and what the
    blocks miss comes from the exact pass."""
    rows = corpus(7, 90)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = jaccard_groups(df, block=block).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(plain_groups(rows))


def test_empty_table_and_only_empty_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " ")], "doc_id long, text string")
    assert sorted(tuple(r)[:3] for r in jaccard_groups(df).collect()) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]
    assert jaccard_groups(df.limit(0)).count() == 0
    assert keep_one_of_each_group(df).count() == 3


def test_one_of_each_group_stays_with_repeated_ids(spark):
    a, b = "a b c d e f g h i j", "k l m n o p q r s t"
    rows = [(1, a, "x"), (1, a, "y"), (2, a, "z"), (3, b, "x"), (1, b, "y"), (4, None, "n"), (4, None, "n"), (5, "solo", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, node string")
    got = sorted(((r.doc_id, r.text) for r in keep_one_of_each_group(df).collect()), key=str)
    assert got == sorted([(1, a), (1, b), (4, None), (4, None), (5, "solo")], key=str)


def test_rtree_join_loses_no_pair():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 2**63, int(n), dtype=np.uint64)) for n in rng.integers(1, 200, 150)]
    sets += [np.unique(np.concatenate([s[: max(1, len(s) * 9 // 10)], rng.integers(0, 2**63, 2, dtype=np.uint64)])) for s in sets[:80]]
    vec, size = np.stack([count_vector(s) for s in sets]), np.array([len(s) for s in sets])
    tree = CountRTree(vec, size)
    i, j, surplus = tree.join(tree)
    found = set(zip(i.tolist(), j.tolist()))
    for a in range(len(sets)):
        for b in range(len(sets)):
            bound = np.minimum(vec[a], vec[b]).sum()
            assert (bool(may_link(bound, size[a], size[b])) == ((a, b) in found)) or not (5 * size[a] >= 4 * size[b] and 5 * size[b] >= 4 * size[a])
            if linked(sets[a], sets[b]):
                assert (a, b) in found
    assert (surplus >= 0).all() and len(join_block(sets)) >= 1


def test_sets_do_not_depend_on_the_batch():
    texts = ["A b\tc d e f", "", "x", "a B c\nd e f", "é " * 30]
    h, size, node = shingle_sets(texts)
    assert size.tolist() == [2, 0, 1, 2, 1] and node[0] == node[3] != node[4]
    for k, x in enumerate(texts):
        _, s, n = shingle_sets([x])
        assert s[0] == size[k] and n[0] == node[k]


def test_hot_keys_are_salted_and_stay_whole(spark, monkeypatch):
    """A passage that a few texts of every batch have: its key is found by the
    global count, dealt over salts, and comes back with every node; keys of one
    node do not come back."""
    import collections

    from bottomgrid.llm import jaccard_rtree as j
    monkeypatch.setattr(j, "COUNTED", 2)
    monkeypatch.setattr(j, "HOT", 16)
    rnd = random.Random(11)
    vocab = [f"v{k}" for k in range(5000)]
    new = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    passage = new(40)
    texts = [passage + " " + new(8) for _ in range(150)] + [new(30) for _ in range(300)]
    rnd.shuffle(texts)
    texts += texts[:5] + [None, ""]
    want = collections.defaultdict(set)
    h, size, node = shingle_sets([x or "" for x in texts])
    ends = np.cumsum(size)
    for a, n, who in zip(ends - size, size, node):
        for key in h[a:a + n][:j.prefix_length(np.array([n]))[0]].view(np.int64):
            want[int(key)].add(int(who))
    df = spark.createDataFrame([(x,) for x in texts], "text string").repartition(30)
    for few in (j.HOT_KEYS, 0):      # hot keys broadcast, and joined
        monkeypatch.setattr(j, "HOT_KEYS", few)
        got = collections.defaultdict(list)
        rows = j._shared_keys(df, j._NODE)
        for r in rows.collect():
            got[r.key].append(r.node)
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items() if len(v) > 1}
    assert max(map(len, got.values())) > 20


def test_finer_vectors_lose_no_link():
    from bottomgrid.llm.jaccard_rtree import FINE, Vectors, groups_of, packed_vector
    rng = np.random.default_rng(8)
    base = [np.unique(rng.integers(0, 2**63, int(n), dtype=np.uint64)) for n in (1, 3, 40, 63, 65, 200, 500, 900, 1024, 1100, 3000)]
    sets = base + [np.unique(np.concatenate([s[: max(1, int(len(s) * f))], rng.integers(0, 2**63, max(1, int(len(s) * (1 - f))), dtype=np.uint64)]))
                   for s in base for f in (0.95, 0.9, 0.88, 0.85, 0.8, 0.75, 0.6)]
    n = np.array([len(s) for s in sets])
    v = Vectors([packed_vector(s) for s in sets], n)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    true = np.array([len(np.intersect1d(sets[i], sets[j])) for i, j in zip(a, b)])
    bound = v.overlap(a, b)
    coarse = np.minimum(v.points[a], v.points[b]).sum(1, dtype=np.int64) + v.slack[a] + v.slack[b]
    assert (bound >= true).all() and (coarse >= true).all()
    # and they tell near misses from links, where sets are of middle size
    near = (n[a] > 60) & (groups_of(n[a]) > 0) & (groups_of(n[b]) > 0) & (true / (n[a] + n[b] - true) > 0.6) & (a != b)
    assert near.any() and (bound[near] - true[near] <= 0.08 * n[a][near] + 3).all()
    assert groups_of(np.array([1, 64, 65, 1024, 1025])).tolist() == [256, 256, 512, FINE, 0]


def test_a_family_of_near_misses(spark, monkeypatch):
    """2,000 texts that share a common base but for a stretch of their own, so
    that most pairs have a Jaccard of 0.64 to 0.8 and only those with the same
    stretch are linked. Results as of all pairs, and hardly more pairs leave
    the blocks than are links between components."""
    from bottomgrid.llm import jaccard_rtree as j
    rnd = random.Random(4)
    base = [f"b{k}" for k in range(300)]
    texts, at = [], []
    for k in range(2000):
        at.append(rnd.randrange(240))
        w = list(base)
        w[at[-1]:at[-1] + 28] = [f"x{k}_{i}" for i in range(28)]
        texts.append(" ".join(w))
    # common shingles of all pairs: those of the base that both still have
    has = np.ones((2000, 296), np.int32)
    for k, p in enumerate(at):
        has[k, max(p - 4, 0):p + 28] = 0
    own = 296 - has.sum(1)
    both = has @ has.T
    union = (296 * 2) - both
    link = 100 * both >= 80 * union
    assert own.min() >= 28 and ((both / union > 0.7) & ~link).sum() > 500_000
    least = np.arange(2000)
    while True:
        new = np.array([least[row].min() for row in link | np.eye(2000, dtype=bool)])
        if (new == least).all():
            break
        least = new
    counts = {}
    real = j.as_table

    def noted(df, name):
        out = real(df, name)
        counts[name] = counts.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(j, "as_table", noted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    got = {r.doc_id: r.component_id for r in jaccard_groups(df, block=200).collect()}
    assert [got[k] for k in range(2000)] == least.tolist() and len(set(least.tolist())) > 200
    assert counts["pairs"] < 20_000, counts


def test_no_table_stays_behind_but_the_result(spark):
    from bottomgrid.session import checkpoint_dir, child_names
    before = set(child_names(spark, checkpoint_dir(spark)))
    df = spark.createDataFrame(corpus(3, 10)[:60], "doc_id long, text string")
    out = jaccard_groups(df)
    new = set(child_names(spark, checkpoint_dir(spark))) - before
    assert len(new) == 1 and out.count() == 60


def test_nodes_that_meet_are_hashed_anew(spark, monkeypatch):
    """A node hash under which all sets meet is given up."""
    from bottomgrid.llm import jaccard_rtree as j
    real = j.set_hashes

    def weak(h, size, salt):
        return real(h, size, salt) if salt != j._NODE else np.ones(len(size), np.int64)

    monkeypatch.setattr(j, "set_hashes", weak)
    import pyarrow as pa
    texts = ["a b c d e f", "g h i j k l", "a b c d e f"]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(texts)], names=["id", "text"])
    first = pa.Table.from_batches(j._members(iter([batch]), j._NODE)).to_pydict()
    assert first["node"] == [1, 1, 1] and first["again"][0] == first["again"][2] != first["again"][1]
    second = pa.Table.from_batches(j._members(iter([batch]), (j._NODE + j._ODD) % 2**64)).to_pydict()
    assert second["node"][0] == second["node"][2] != second["node"][1]


def test_columns_of_the_input_may_clash(spark):
    rows = [(1, "a b c d e f", "n"), (2, "a b c d e f", "n"), (3, None, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, node string").selectExpr(
        "*", "'x' AS component_id", "5 AS n_shingles", "7 AS id", "'k' AS key")
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_groups(df).collect()) == [(1, 2, 1), (2, 2, 1), (3, 0, 3)]
    kept = keep_one_of_each_group(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_groups_span_batches():
    import pyarrow as pa

    from bottomgrid.llm.jaccard_rtree import _groups
    keys = [1] * 7 + [2] + [3] * 5
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[k:k + 3])], names=["k"]) for k in range(0, len(keys), 3)]
    tables = [t.column("k").to_pylist() for t in _groups(iter(batches + [batches[0].slice(0, 0)]), ["k"])]
    assert sum(tables, []) == keys and all(not set(a) & set(b) for k, a in enumerate(tables) for b in tables[:k])
    assert list(_groups(iter([]), ["k"])) == []
