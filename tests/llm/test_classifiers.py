"""Quality and toxicity: held-out accuracy, folding, edge cases."""

import random

import numpy as np
import pytest

from voltweave.llm import quality, toxicity

SF = "/root/testdata/sf0.01"


def auc(y, s):
    order = np.argsort(np.argsort(s)) + 1
    n1 = y.sum()
    return (order[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def held_out(spark, df, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = df.where("held_out").join(labels, "doc_id").select(label, "score", "predicted").collect()
    return np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), np.array([r[2] for r in rows])


def test_quality_on_held_out_rows(spark):
    df = quality.op2_quality(spark, SF)
    y, s, p = held_out(spark, df, "quality")
    assert auc(y, s + 1e-9 * np.arange(len(s))) > 0.97 and (y == p).mean() > 0.95
    assert df.count() == 1000 and s.min() >= 0 and s.max() <= 1


def test_toxicity_on_held_out_rows(spark):
    df = toxicity.op5_toxicity(spark, SF)
    y, s, p = held_out(spark, df, "toxic")
    assert (y == p).mean() > 0.93 and p[y == 1].mean() > 0.7 and p[y == 0].mean() < 0.03


def test_quality_edge_cases(spark, make_docs):
    docs = make_docs([None, "", "a", "\n\n", "x" * 200_000, "!" * 1000, "é" * 50])
    m = quality.measure(docs)
    assert all(np.isfinite(r.stats).all() for r in m.collect())
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(7)], "doc_id long, quality int, toxic int")
    for model in (quality.learn(m, labels, lambda c: c >= 0), quality.learn(m, labels.limit(0), lambda c: c >= 0)):
        rows = quality.score_quality(m, model).collect()
        assert len(rows) == 7 and all(0 <= r.score <= 1 for r in rows) and "text" not in rows[0]
    assert quality.score_quality(quality.measure(docs.limit(0)), None).collect() == []


@pytest.mark.parametrize("text", ["You IDIOT", "an 1d1ot!", "іdіоt", "ｉｄｉｏｔ", "i​diot", "ïdíöt.", "(idiot)", "$cum", "tr@sh", "m0r0n"])
def test_folding(text):
    assert toxicity.hits(toxicity.Model().automaton(), toxicity.tokens(toxicity.fold(text))) > 0


@pytest.mark.parametrize("text", ["", "idiotic", "trash can", "Trash, can", "the class clown", "video", "10 07 2020", "!!!", "clo wn"])
def test_what_is_no_hit(text):
    assert toxicity.hits(toxicity.Model().automaton(), toxicity.tokens(toxicity.fold(text))) == 0


def test_exception_covers_only_its_own_words():
    a = toxicity.Model().automaton()
    assert toxicity.hits(a, "trash can trash".split()) == toxicity.SEED_WEIGHT


def test_toxicity_without_labels_and_edge_cases(spark, make_docs):
    docs = make_docs([None, "", "you idiot and moron, you scum", "good day " * 20_000])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = sorted(toxicity.score_toxicity(docs, toxicity.learn(docs, labels, lambda c: c >= 0)).collect(), key=lambda r: r.doc_id)
    assert [r.score >= toxicity.THRESHOLD for r in rows] == [False, False, True, False]
    assert toxicity.score_toxicity(docs.limit(0), toxicity.Model()).collect() == []


def test_stems_are_learned():
    toxic = [{f"blurg{s}", "w"} for s in ("a", "ed", "ing", "er", "est", "o")] * 3
    clean = [{"w", f"word{i}"} for i in range(60)]
    weights = toxicity.choose(toxic, clean)
    assert list(weights) == ["blurg"]


def naive(model, words):
    """The summed weight by comparing every entry with every word, and every phrase with every run of words."""
    total = 0.0
    covered = [set(range(i, i + len(p.split()))) for p in model.exceptions for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    for entry, weight in model.weights.items():
        for i, w in enumerate(words):
            if (w == entry[:-1] if entry.endswith("$") else w.startswith(entry)) and not any(i in c for c in covered):
                total += weight
    return total


def test_automaton_equals_a_naive_matcher():
    rng = random.Random(8)
    model = toxicity.Model(exceptions=("trash can", "a clown fish", "fool moon", "fo"))
    model.weights = {"trash$": 2.0, "clown": 1.5, "fool": 1.0, "fo$": 0.25, "can$": 3.0, "foolish": 0.5, "moon$": 0.125}
    automaton = model.automaton()
    some = ["trash", "can", "a", "clown", "clowns", "fish", "fool", "foolish", "fo", "moon", "moons", "word"]
    for _ in range(2000):
        words = [rng.choice(some) for _ in range(rng.randint(0, 12))]
        assert abs(toxicity.hits(automaton, words) - naive(model, words)) < 1e-9, words


def test_exceptions_act_in_learning(spark, make_docs):
    rng = random.Random(7)
    own = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(20))
    toxic = [f"you blurgh there {own()}" for _ in range(30)]
    clean = [f"the blurgh fish swims {own()}" for _ in range(10)] + [f"a calm day you there {own()}" for _ in range(120)]
    docs = make_docs(toxic + clean)
    labels = spark.createDataFrame([(i, 0, int(i < 30)) for i in range(160)] + [(3, 0, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs, labels, lambda c: c >= 0, exceptions=("blurgh fish",))
    assert any("blurgh".startswith(w.rstrip("$")) for w in model.weights)
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()}
    assert min(got[i] for i in range(30)) >= 0.7 > max(got[i] for i in range(30, 160))


def test_repeated_labelled_ids_are_learned_once(spark, make_docs):
    docs = make_docs(["good day"] * 400 + [f"fine word{i}" for i in range(20)] + [f"scum idiot{i}" for i in range(20)], [1] * 400 + list(range(2, 42)))
    labels = spark.createDataFrame([(i, 0, int(i >= 22)) for i in range(1, 42)], "doc_id long, quality int, toxic int")
    assert toxicity.training(docs, labels, "toxic", lambda c: c >= 0).count() == 41
    assert toxicity.score_toxicity(docs, toxicity.learn(docs, labels, lambda c: c >= 0)).count() == 440


def test_discriminant_equals_dense_gaussian_log_densities():
    rng = np.random.default_rng(4)
    d = len(quality.NAMES)
    x = {k: rng.normal(size=(200, d)) @ rng.normal(size=(d, d)) + k for k in (0, 1)}
    sums = {k: (float(len(v)), v.sum(0), v.T @ v) for k, v in x.items()}
    amount = 0.3
    model = quality.shrunk(sums, amount)
    within = {k: np.cov(v.T, bias=True) for k, v in x.items()}
    pooled = (within[0] + within[1]) / 2
    scale = np.diag(np.diag(pooled))
    test = rng.normal(size=(50, d)) * 3

    def log_density(k):
        s = (1 - amount) * within[k] + amount * 0.5 * (pooled + scale) + 1e-3 * scale
        e = test - x[k].mean(0)
        return -0.5 * np.einsum("ij,jk,ik->i", e, np.linalg.inv(s), e) - 0.5 * np.linalg.slogdet(s)[1]

    want = log_density(1) - log_density(0)
    assert np.allclose(model.difference(test), want, rtol=1e-6, atol=1e-6)
    d = np.sign(want) * np.log1p(np.abs(want))
    assert np.allclose(model.score(test), 1 / (1 + np.exp(-(model.slope * d + model.constant))))


def test_sums_are_over_all_labelled_rows(spark, make_docs):
    docs = make_docs([f"text {i} " * (i % 7 + 1) for i in range(60)])
    rows = quality.measure(docs).selectExpr("cast(doc_id % 2 as int) AS y", "cast(doc_id % 3 as int) AS fold", "stats")
    got = quality.add_up(rows)
    for (y, fold), (n, total, cross) in got.items():
        v = np.array([r.stats for r in rows.where(f"y = {y} AND fold = {fold}").collect()])
        assert n == len(v) and np.allclose(total, v.sum(0)) and np.allclose(cross, v.T @ v)
