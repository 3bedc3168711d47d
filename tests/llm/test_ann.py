"""Nearest neighbours against brute force."""

import numpy as np

from voltweave.llm import ann


def brute(rows, is_query, k=5):
    use = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in use:
        if is_query(i):
            s = [(-(q @ v) / np.sqrt((q @ q) * (v @ v)), j) for j, v in use if j != i]
            out[i] = [j for _, j in sorted((round(a, 12), j) for a, j in s)[:k]]
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").drop("label")
    got = {}
    for r in ann.search(df, lambda c: c % 5 == 0, **kw).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    return {q: [j for _, j in sorted(x)] for q, x in got.items()}


def test_recall_and_copies(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 16))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 30] + 0.3 * rng.normal(size=16)]) for i in range(900)]
    rows += [(1000 + i, rows[7][1]) for i in range(300)]  # a third of all rows are one vector
    got = run(spark, [(i, v, 0) for i, v in rows], sample=200, leaf=20, probes=40)
    want = brute(rows, lambda i: i % 5 == 0)
    assert got.keys() == want.keys()
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * sum(map(len, want.values()))
    assert got[1000] == want[1000] == [7, 1001, 1002, 1003, 1004]


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 0), (5, None, 0), (10, [], 0), (15, [0.0, 0.0], 0), (20, [nan, 1.0], 0), (25, [inf, 1.0], 0), (30, [None, 1.0], 0), (1, [1.0, 1.0], 0), (2, [2.0, 2.0], 0), (None, [1.0, 1.0], 0), (35, [1.0, 2.0, 3.0], 0)]
    assert run(spark, rows) == {0: [1, 2]}
    assert run(spark, rows[1:3]) == {}
    assert run(spark, []) == {}


def test_walk_reaches_every_leaf():
    x = ann.unit(np.random.default_rng(2).normal(size=(500, 8)))
    tree = ann.fit(x, leaf=20)
    assert sorted(tree.best_bins(x[0], tree.n_leaves)) == list(range(tree.n_leaves))
    assert tree.best_bins(x[3], 1)[0] == tree.descend(x[3:4])[0]


def test_pages_hold_their_leaves():
    first, blocks = ann.pages(np.array([10, 5000, 3, 4, 0]), 4096)
    assert blocks.tolist() == [1, 2, 1, 1, 1] and first[1] == 1 and first[2] == first[3] == 3


def case(n=3000, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(60, 16))
    return [(i, [float(np.float32(x)) for x in centres[rng.integers(60)] + 0.4 * rng.normal(size=16)], 0) for i in range(n)]


def recall(got, want):
    return sum(len(set(got[q]) & set(want[q])) for q in want) / sum(map(len, want.values()))


def test_the_tree_decides_over_many_pages(spark, monkeypatch):
    """Fewer leaves are visited than there are, over several pages, and recall holds on queries that did not calibrate."""
    rows, seen = case(), {}
    whole = ann.calibrate

    def calibrate(tree, index, q_key, *rest):
        seen["visits"], seen["leaves"], seen["sizes"] = whole(tree, index, q_key, *rest), tree.n_leaves, ann.leaf_sizes(index, tree)
        seen["keys"] = set(q_key.tolist())
        return seen["visits"]

    monkeypatch.setattr(ann, "calibrate", calibrate)
    got, want = run(spark, rows, sample=1000, probes=60, leaf=40, page_rows=200), brute([r[:2] for r in rows], lambda i: i % 5 == 0)
    first, blocks = ann.pages(seen["sizes"], 200)
    assert seen["visits"] < seen["leaves"] / 2 and first.max() >= 10
    held = {r.vec_id for r in ann.usable(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).selectExpr("vec_id", "xxhash64(vector) AS k").collect() if r.k not in seen["keys"]}
    assert len(held & set(want)) >= 500 and recall(got, {q: want[q] for q in want if q in held}) >= 0.9


def test_leaves_grow_in_number_with_the_table(spark):
    rows = case()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    plain = ann.distinct_vectors(ann.usable(df), 5)
    drawn = np.array([r.vector for r in plain.limit(200).collect()])
    tree = ann.fit(ann.unit(drawn), leaf=64)
    index = ann.indexed(plain, tree, 16)
    before = ann.leaf_sizes(index, tree)
    grown, index, sizes = ann.grow(tree, index, 16, 100, 400, 1 << 20)
    assert before.max() > 100 >= sizes.max() and sizes.sum() == len(rows) and grown.n_leaves > tree.n_leaves
    assert (sizes > 0).sum() <= grown.n_leaves and sorted(set(grown.bins(ann.unit(drawn)[0]))) == sorted(set(grown.leaf[grown.leaf >= 0]))
    small, _, sizes = ann.grow(tree, ann.indexed(plain, tree, 16), 16, 100, 400, 0)  # a tree that may not grow keeps large leaves
    assert small.n_leaves == tree.n_leaves and sizes.sum() == len(rows)
    want = brute([r[:2] for r in rows], lambda i: i % 5 == 0)
    assert recall(run(spark, rows, sample=200, leaf=60, leaf_rows=100, leaf_sample=400, page_rows=150), want) >= 0.9


def test_many_ties_and_nearly_empty_leaves(spark):
    rows = [(i, [2.0**i, 2.0 ** (i + 1)], 0) for i in range(1, 40)] + [(50 + i, [-1.0, float(i)], 0) for i in range(3)]
    got = run(spark, rows, sample=10, leaf=2, leaf_rows=4, leaf_sample=8, probes=2, recall=0.1)
    want = brute([r[:2] for r in rows], lambda i: i % 5 == 0)
    assert all(got[q] == want[q] for q in (5, 10, 35)) and all(len(x) == 5 for x in got.values())


def test_lengths_are_searched_each_and_other_columns_do_not_matter(spark):
    rows = [(i, [1.0, float(i)], 0) for i in range(1, 8)] + [(10 + i, [1.0, float(i), 2.0], 0) for i in range(7)] + [(5, [1.0, 5.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS leaf", "2 AS query", "'x' AS score", "0 AS vector")
    got = {}
    for r in ann.search(df, lambda c: c % 5 == 0).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == {5, 10, 15} and set(got[5]) <= set(range(1, 8)) and set(got[10]) <= set(range(10, 17))
