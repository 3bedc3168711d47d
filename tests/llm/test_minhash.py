"""Near duplicates against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from voltweave.llm import minhash as M

WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def text(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n))


def edited(rng, t, n):
    w = t.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = "edit" + str(rng.randrange(10**6))
    return " ".join(w)


def classes(df):
    return {r.doc_id: (r.class_id, r.n_class) for r in M.near_duplicates(df).collect()}


def plain(a, b):
    x, y = (Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) for w in (WORD.findall(t.lower().encode()) for t in (a, b)))
    low = sum((x & y).values())
    return low / (sum(x.values()) + sum(y.values()) - low)


def test_planted_copies(spark, make_docs):
    rng = random.Random(1)
    base = [text(rng, rng.randint(80, 400)) for _ in range(120)]
    texts, origin = list(base), list(range(120))
    for i in range(60):
        for k in (0, 1):  # an exact copy, but for case and punctuation, and a near one
            t = base[i].upper().replace(" ", ", ") if k == 0 else edited(rng, base[i], max(1, len(base[i].split()) // 60))
            if k == 0 or plain(t, base[i]) >= 0.84:
                texts.append(t)
                origin.append(i)
    got = classes(make_docs(texts))
    for i, o in enumerate(origin):
        assert got[i][0] == o, (i, o)
    assert all(n == origin.count(c) for c, n in got.values())


def test_large_groups_and_shared_passages(spark, make_docs):
    rng = random.Random(2)
    passage, one = text(rng, 60), text(rng, 300)
    texts = [passage + " " + text(rng, 200) for _ in range(150)]  # share a passage, are not alike
    texts += [one] * 150 + [edited(rng, one, 2) for _ in range(150)]
    got = classes(make_docs(texts))
    assert all(got[i] == (i, 1) for i in range(150))
    assert {got[i] for i in range(150, 450)} == {(150, 300)}


def test_edge_cases(spark, make_docs):
    got = classes(make_docs([None, "", "!!!", "one two", "One, two!", "a b c d e", "a b c d e f", "x " * 50_000, "x " * 50_000], [0, 1, 2, 3, 4, 5, 6, 7, 7]))
    assert got == {0: (0, 1), 1: (1, 1), 2: (2, 1), 3: (3, 2), 4: (3, 2), 5: (5, 1), 6: (6, 1), 7: (7, 1)}
    assert M.near_duplicates(make_docs([])).collect() == []
    assert M.near_duplicates(make_docs(["a"], [None]).selectExpr("*", "1 AS bands", "2 AS seq")).collect() == []


def test_vectors_and_samples():
    rng = random.Random(3)
    a = text(rng, 300)
    docs, s, count, seq = M.vectors([a.encode(), b"", edited(rng, a, 5).encode()])
    assert docs.tolist() == sorted(docs.tolist()) and set(docs) == {0, 2} and seq[1] == 0
    ones = np.ones((2, 1 << M.LOG), np.float32)
    v = [(s[docs == d], count[docs == d]) for d in (0, 2)]
    want = plain(a, a)
    assert want == 1 and M.jaccard(v[0], v[0], ones) == 1
    # Shares of equal samples estimate the similarity.
    got = M.samples(docs, s, count * M.idf(ones, s), 3)
    assert abs((got[0] == got[1]).mean() - M.jaccard(*v, ones)) < 0.3


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 60) if i != 30] + [(100, 7), (5, 5)]
    got = {r.id: r["class"] for r in M.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 31)}, **{i: 31 for i in range(32, 61)}, 100: 0}


def test_original_without_the_smallest_id(spark, make_docs):
    """Copies are like the original alone, which is only a member of the buckets that copies lead."""
    rng = random.Random(4)
    texts, groups = [], 10
    for g in range(groups):
        one = text(rng, 300).split()
        copies = []
        for k in range(6):  # scattered edits, at other places in each copy
            w = list(one)
            for j in range(6):
                w[10 + 47 * j + 7 * k] = f"edit{g}x{k}x{j}"
            copies.append(" ".join(w))
        group = copies[: (3, 6)[g % 2]] + [" ".join(one)] + copies[(3, 6)[g % 2] :]
        assert all(plain(c, " ".join(one)) > 0.805 for c in copies) and plain(copies[0], copies[1]) < 0.7
        texts += group
    got = classes(make_docs(texts))
    assert all(got[i] == (i // 7 * 7, 7) for i in range(7 * groups))


@pytest.mark.parametrize("block", [M.BLOCK, 16])
def test_pairs_within_a_family_of_unlike_texts(spark, make_docs, monkeypatch, block):
    """Texts that share a template are unlike each other; their copies are found whichever leaders their buckets have."""
    monkeypatch.setattr(M, "BLOCK", block)
    rng = random.Random(6)
    template, texts = text(rng, 300).split(), []
    for i in range(240):
        w = list(template)
        at = rng.randrange(0, 282)
        w[at : at + 18] = text(rng, 18).split()
        texts.append(" ".join(w))
        if i % 5 == 0:
            for e in range(3):
                w[(at + 60 + 45 * e) % 290] = f"edit{i}x{e}"
            texts.append(" ".join(w))
    rng.shuffle(texts)
    df = make_docs(texts)
    weights = M.weights_of(*M.sketch(df))
    doc, s, count, _ = M.vectors([t.encode() for t in texts])
    keys = M.bands(M.samples(doc, s, count * M.idf(weights, s), len(texts)))
    v = [(s[doc == i], count[doc == i]) for i in range(len(texts))]
    together = [(i, j) for i in range(len(texts)) for j in range(i) if (keys[i] == keys[j]).any()]
    like = [(i, j) for i, j in together if M.jaccard(v[i], v[j], weights) >= M.SIMILARITY]
    want = list(range(len(texts)))
    for i, j in like:
        want = [min(want[i], want[j]) if c in (want[i], want[j]) else c for c in want]
    got = classes(df)
    assert len(together) > 500 * len(like) and len(like) >= 48
    assert [got[i][0] for i in range(len(texts))] == want


def whole_classes(texts, weights):
    """Classes by the similarity of all pairs of texts."""
    doc, s, count, _ = M.vectors([t.encode() for t in texts])
    weight = count * M.idf(weights, s).astype(float)
    v = [dict(zip(s[doc == i].tolist(), weight[doc == i].tolist())) for i in range(len(texts))]
    total = [sum(x.values()) for x in v]
    want, links = list(range(len(texts))), []
    for i in range(len(texts)):
        for j in range(i):
            if not v[i] or not v[j] or min(total[i], total[j]) < 0.8 * max(total[i], total[j]):
                continue
            low = sum(min(x, v[j][k]) for k, x in v[i].items() if k in v[j])
            if low / (total[i] + total[j] - low) >= M.SIMILARITY:
                links.append((i, j))
                a, b = want[i], want[j]
                want = [min(a, b) if c in (a, b) else c for c in want]
    return want, links


def test_a_table_against_all_pairs(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id")
    rows = df.collect()
    texts = [r.text or "" for r in rows]
    want, links = whole_classes(texts, M.weights_of(*M.sketch(df)))
    got = {r.doc_id: r.class_id for r in M.op1_minhash_dedup(spark, "/root/testdata/sf0.001").collect()}
    assert len(links) > 10 and [got[r.doc_id] for r in rows] == [rows[c].doc_id for c in want]


@pytest.mark.parametrize("edits", [1, 2])
def test_pairs_beside_many_texts_of_their_template(spark, make_docs, edits):
    """400 texts of one template with smaller ids, none like another, lead all buckets; copies of 60 others are joined to them."""
    rng = random.Random(12)
    template = text(rng, 200).split()

    def of_template():
        w = list(template)
        at = rng.randrange(0, 175)
        w[at : at + 13] = text(rng, 13).split()
        return w

    texts = [" ".join(of_template()) for _ in range(400)]
    pairs = []
    for i in range(60):
        one = of_template()
        two = list(one)
        for e in range(edits):
            two[(17 + 40 * e + i) % 195] = f"edit{i}x{e}"
        pairs.append((len(texts), len(texts) + 1))
        texts += [" ".join(one), " ".join(two)]
    df = make_docs(texts)
    want, links = whole_classes(texts, M.weights_of(*M.sketch(df)))
    assert {(b, a) for a, b in pairs} <= set(links) and len(set(want)) > 380
    got = classes(df)
    assert [got[i][0] for i in range(len(texts))] == want


def test_rows_that_repeat_a_doc_id_have_one_text(spark, make_docs):
    rng = random.Random(3)
    a, b, c = (text(rng, 100) for _ in range(3))
    docs = make_docs([a, b, a, b, c, c], [5, 5, 7, 8, 9, 9]).selectExpr("*", "1 AS class_id", "2 AS id", "3 AS seq", "4 AS `x.y`")
    got = {tuple(sorted(classes(docs).items())) for _ in range(2)}
    docs = docs.repartition(3).sortWithinPartitions("text")
    got.add(tuple(sorted(classes(docs).items())))
    assert len(got) == 1
    got = dict(got.pop())
    assert got[9] == (9, 1) and {got[7][0], got[8][0]} in ({5, 8}, {5, 7}) and got[5] == (5, 2)
