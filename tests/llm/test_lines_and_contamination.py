"""Line dedup and decontamination against brute force."""

import hashlib
import random
import re

import numpy as np

from voltweave.llm import common, decontam, line_dedup

STRIP = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def kept_lines(rows):
    """rows (doc_id, text) -> [(doc_id, n_lines, n_dropped, text)] by definition."""
    holders = {}
    for d, t in rows:
        for x in (t or "").split("\n"):
            k = x.strip(STRIP).translate(LOWER)
            if len(k) >= 40:
                holders.setdefault(k, set()).add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if not (len(h := holders.get(x.strip(STRIP).translate(LOWER), ())) >= 5 and max(h) != d)]
        out.append((d, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out)


def lines_case():
    rng = random.Random(1)
    common = ["  The same long line, number %d, stands in many documents.  \r" % i for i in range(6)] + ["é" * 40, "é" * 39, "short line", ""]
    rows = [(i, "\n".join(rng.choice(common).upper() if rng.random() < 0.3 else rng.choice(common) for _ in range(rng.randint(0, 8)))) for i in range(60)]
    return [*rows, (70, None), (71, ""), (72, common[0]), (72, common[0] + "\n" + common[0])]


def test_line_dedup_broadcast_and_routed(spark, make_docs):
    rows = lines_case()
    docs = make_docs([t for _, t in rows], [d for d, _ in rows]).selectExpr("*", "1 AS h1", "2 AS shard")
    want = kept_lines(rows)
    for kw in ({}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "shard_keys": 2}, {"shard_keys": 1}):
        got = line_dedup.dedup_lines(docs, **kw).collect()
        assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got) == want, kw
        assert set(docs.columns) <= set(got[0].asDict())
    assert line_dedup.dedup_lines(docs.limit(0)).collect() == []


def test_perfect_hash():
    rng = np.random.default_rng(2)
    h1, h2 = rng.integers(0, 1 << 63, (2, 5000), dtype=np.uint64)
    index = line_dedup.ShardIndex(h1, h2, np.arange(5000), np.arange(5000) * 2)
    assert sorted(index.position(h1, h2).tolist()) == list(range(5000))
    n, keep = index.probe(h1, h2)
    assert n.tolist() == list(range(5000)) and keep.tolist() == [2 * i for i in range(5000)]
    n, _ = index.probe(h1, h2 + np.uint64(1))
    assert not n.any()


def contamination(docs, items, window=13):
    wins = {}
    for i, t in items:
        w = WORD.findall((t or "").translate(LOWER))
        for k in range(max(1, len(w) - window + 1)) if w else ():
            wins.setdefault(tuple(w[k : k + window]), set()).add(str(i))
    sizes = {len(k) for k in wins}
    out = {}
    for d, t in docs:
        w, hit, found = WORD.findall((t or "").translate(LOWER)), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in wins:
                    hit |= set(range(k, k + n))
                    found |= wins[tuple(w[k : k + n])]
        out[d] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def test_decontamination_against_brute_force(spark, make_docs):
    rng = random.Random(3)
    vocabulary = ["a", "b", "c", "dé", "e1"]  # so few words that windows recur by chance
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([1, 4, 8, 12, 13, 14, 30]) if i else 6)) for i in range(2, 30)] + [(100, None), (101, "!!!"), (9, "q w e r"), (10, "q w e r")]
    items = [(i, t) for i, t in items if t is None or len(t.split()) != 1]
    docs = [(d, text(rng.randint(0, 120))) for d in range(60)]
    docs += [(60, None), (61, ""), (62, "Q, w; E r."), (63, "x " * 300 + items[0][1].upper()), (64, "q w e"), (65, "z " * 100_000)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = contamination(docs, items)
    for kw in ({}, {"block_words": 40}, {"block_words": 40, "pass_blocks": 2}):
        got = decontam.decontaminate(make_docs([t for _, t in docs], [d for d, _ in docs]), bench, **kw).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, decontam.digest(r["items"]), r.contaminated) for r in got} == want
    clean = {r.doc_id: r.clean_text for r in got}
    assert clean[62] == "." and clean[60] == "" and clean[64] == "q w e"
    assert decontam.decontaminate(make_docs(["a b"]), bench.limit(0)).first().n_hit == 0


def test_many_blocks_are_one_pass_and_leave_no_table(spark, make_docs):
    rng = random.Random(5)
    text = lambda n: " ".join(f"w{rng.randrange(900)}" for _ in range(n))
    items = [(i, text(20)) for i in range(10)]
    docs = [(i, text(30) + " " + items[i][1] + " " + text(9)) for i in range(10)] + [(10, items[3][1] + " . " + items[8][1]), (11, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert len(list(decontam.blocks(bench, 20))) == 10
    df, want = make_docs([t for _, t in docs], [d for d, _ in docs]), contamination(docs, items)
    for most, left in ((16, 0), (3, 1)):
        before = set(common._LEFT)
        out = decontam.decontaminate(df, bench, block_words=20, pass_blocks=most)
        assert len(set(common._LEFT) - before) == left  # of several passes the last one's input is still read
        got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, decontam.digest(r["items"]), r.contaminated) for r in out.collect()}
        assert got == want
    assert decontam.decontaminate(df.limit(0), bench).collect() == []


def test_routed_index_decides_each_row_of_a_doc_id(spark, make_docs):
    line = "A line that stands in many documents, of over forty characters."
    rows = [(i, line) for i in range(5)] + [(9, line), (9, "first\n" + line), (9, line + "\nlast"), (2, "own\n" + line), (None, "x\n" + line), (None, line)]
    docs = make_docs([t for _, t in rows], [d for d, _ in rows])
    plain, routed = (sorted(map(str, line_dedup.dedup_lines(docs, broadcast_bytes=b).collect())) for b in (1 << 20, 0))
    assert plain == routed


def test_single_word_items(spark, make_docs):
    bench = spark.createDataFrame([(1, "secret"), (2, "a b")], "item_id long, text string")
    got = decontam.decontaminate(make_docs(["x Secret y", "a b a", "none"]), bench).collect()
    assert {r.doc_id: (r.n_hit, r["items"]) for r in got} == {0: (1, ["1"]), 1: (2, ["2"]), 2: (0, [])}
