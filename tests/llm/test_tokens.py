"""Token counts and packing against the libraries themselves."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from voltweave.llm import packing, token_counts

TEXTS = [None, "", " ", "a", "héllo wörld  foo\n\nbar", "日本語のテキスト。" * 50, "<s> <|endoftext|> x", "x" * 5000, " \u0085  y", "one two three " * 900]


@pytest.fixture(scope="module")
def encoder():
    return token_counts.PieceEncoder(public_tokenizers.path(token_counts.MODEL))


def test_counts_are_the_librarys(spark, make_docs, encoder):
    rows = token_counts.count_tokens(make_docs(TEXTS), public_tokenizers.path(token_counts.MODEL)).collect()
    for r, t in zip(sorted(rows, key=lambda r: r.doc_id), TEXTS, strict=True):
        n = len(encoder.processor.encode(t or "", num_threads=1))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((t or "").encode()), n, n > 4096)


def test_splice_equals_whole(encoder):
    rng = random.Random(1)
    parts = ["alpha", "be", "γ", "日本", " ", "  ", "\n", "\t", ".", "▁", " ▁", "é", "internationalisation", "123", "\r\n", "😀"]
    for k in range(60):
        text = "".join(rng.choice(parts) + (" " if rng.random() < 0.4 else "") for _ in range(rng.randrange(1, 900)))
        whole = len(encoder.processor.encode(text, num_threads=1))
        for chunk, overlap in ((64, 8), (200, 16), (1000, 64)):
            assert token_counts.splice_count(text.encode(), encoder.starts, encoder.stable, chunk, overlap) == whole, (k, chunk)


def test_splice_without_any_stable_boundary(encoder):
    text = "abc" * 2000
    assert token_counts.splice_count(text.encode(), encoder.starts, encoder.stable, 64, 8) == len(encoder.processor.encode(text, num_threads=1))


def test_fast_encoder_equals_the_library_for_every_low_character():
    both = packing.ByteEncoder(public_tokenizers.path(packing.TOKENIZER), public_tokenizers.path(packing.RANKS))
    for c in range(0x280):
        c = chr(c)
        text = f"a{c}b {c}{c} 1{c}2 {c}a {c}1 .{c}. {c}  {c} \n{c}\n'{c} x{c}"
        assert both.fast.encode_ordinary(text) == both.exact.encode(text, add_special_tokens=False).ids, repr(c)


LONG = [" " * 2_000_000, "\n" * 2_000_000, "a" * 2_000_000, " \n" * 600_000 + "end", ("word " * 9 + "\n") * 20_000, "\u00a0" * 400_000, (" " * 4000 + "x") * 50]


def test_very_long_texts_are_packed(spark, make_docs):
    rows = packing.pack(make_docs(LONG), public_tokenizers.path(packing.TOKENIZER), public_tokenizers.path(packing.RANKS)).collect()
    check_pack(rows, dict(enumerate(LONG)))


def test_very_long_texts_are_counted_by_the_default_path(spark, make_docs, encoder):
    texts = [*LONG[:2], "a" * 300_000, *LONG[3:], "日本語のテキスト。" * 20_000, " ".join(f"w{i} é," for i in range(40_000))]
    rows = sorted(token_counts.count_tokens(make_docs(texts), public_tokenizers.path(token_counts.MODEL)).collect(), key=lambda r: r.doc_id)
    for r, t in zip(rows, texts, strict=True):
        assert (r.n_bytes, r.n_tokens) == (len(t.encode()), len(encoder.processor.encode(t, num_threads=1)))


def test_repeated_rows_empty_tables_and_clashing_columns(spark, make_docs):
    docs = make_docs(["one two", "one two", None, "x " * 3000, "x " * 3000], [1, 1, None, 2, 2]).selectExpr("*", "7 AS n_tokens", "8 AS N_bytes", "9 AS sequence_id", "'p' AS `a.b`")
    model = public_tokenizers.path(token_counts.MODEL)
    rows = token_counts.count_tokens(docs, model).collect()
    assert len(rows) == 5 and len({(r.doc_id, r.n_tokens) for r in rows}) == 3 and rows[0]["a.b"] == "p" and rows[0].sequence_id == 9
    assert token_counts.count_tokens(docs.limit(0), model).collect() == []
    out = packing.pack(docs, public_tokenizers.path(packing.TOKENIZER), public_tokenizers.path(packing.RANKS))
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    got = out.collect()
    assert sorted((r.doc_id or 0, r.start) for r in got) == sorted([(0, 0), (1, 0), (1, 0)] + [(2, s) for r in range(2) for s in range(0, next(r.doc_tokens for r in got if r.doc_id == 2), 2048)])
    spans = sorted((r.sequence_id, r.offset, r.offset + r.length) for r in got)
    assert all(a[0] != b[0] or a[2] == b[1] for a, b in zip(spans, spans[1:]))


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check_pack(rows, texts, size=2048):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, t in texts.items():
        ids, at = ids_of(tokenizer, t), 0
        for r in sorted(by_doc.pop(i), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            at += r.length
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : at], "<u4").tobytes())
        assert at == len(ids)
    assert not by_doc
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    return len(by_sequence)


def test_packing_edge_cases(spark, make_docs):
    docs = make_docs(TEXTS)
    check_pack(packing.pack(docs, public_tokenizers.path(packing.TOKENIZER), public_tokenizers.path(packing.RANKS)).collect(), dict(enumerate(TEXTS)))
    assert packing.pack(docs.limit(0), public_tokenizers.path(packing.TOKENIZER)).collect() == []


def test_packing_of_a_table_wastes_little(spark):
    sf = "/root/testdata/sf0.001"
    rows = packing.op10_packing(spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    n = check_pack(rows, texts)
    assert n <= -(-sum(r.length for r in rows) // 2048) + 2


def test_program_is_near_its_bound_and_whole():
    rng = np.random.default_rng(3)
    for n in (1, 2, 50, 2000):
        lengths = rng.integers(1, 2048, n)
        counts = {int(k): int((lengths == k).sum()) for k in set(lengths.tolist())}
        chosen = packing.plan(counts)
        held = {}
        for p, k in chosen:
            assert sum(a * b for a, b in p.items()) <= 2048
            for a, b in p.items():
                held[a] = held.get(a, 0) + b * k
        assert held == counts
        big = (lengths > 1024).sum()
        assert sum(k for _, k in chosen) <= max(lengths.sum() / 2048, big) * 1.06 + 2


def test_knapsack_against_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(20):
        lengths = np.unique(rng.integers(1, 40, 5))
        values = rng.random(len(lengths))
        most, pattern = packing.price(lengths, values, 40)
        best = [0.0] * 41
        for c in range(1, 41):
            best[c] = max([best[c - 1], *(best[c - k] + v for k, v in zip(lengths, values, strict=True) if k <= c)])
        assert abs(most - best[40]) < 1e-9
        assert abs(sum(n * values[list(lengths).index(k)] for k, n in pattern.items()) - most) < 1e-9
