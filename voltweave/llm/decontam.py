"""Benchmark decontamination by a generalised suffix automaton (operator 7).

The automaton holds all substrings of the normalised items. Training words are streamed through
it with the length of the longest match that ends at each word; wherever that length reaches a
window (13 words, or a whole shorter item) the window's words are hit. A word outside the items'
vocabulary resets the automaton, so only runs of vocabulary words need to be streamed, and of
these only runs as long as the shortest window.

Items are dealt to blocks of at most ``block_words`` words; each block's automaton is a set of sorted arrays, built and broadcast
by itself, so that the driver holds one block at a time. A pass over the documents takes ``pass_blocks`` blocks and or-s their hits
(a window never spans two items): benchmarks of up to block_words * pass_blocks words are one pass, without a copy of the texts;
each further pass writes one and deletes the one before.

Edge cases: a null or empty text has no words, no hits and is not contaminated; items without words
(null, empty, symbols) have no window; repeated items and rows are each kept; item ids are compared as strings, a null one as "".
Other columns pass through, but for n_words, n_hit, n_items, items, contaminated and clean_text, which the results replace.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_TABLE, as_bytes, drop_stage, schema_of, ship, slices, stage, table, with_plain_names, without, words

WINDOW, COVER = 13, 20
BLOCK_WORDS, PASS_BLOCKS = 200_000, 16


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences; each sequence has an item id.

    It is built with dictionaries and kept as arrays: transitions as sorted numbers (state, word), and what each state stands for.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        items = [(i, w) for i, w in items if w]
        self.vocabulary: dict[bytes, int] = {}
        texts = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws] for _, ws in items]
        self.names = [i for i, _ in items]
        nxt, link, length = _build(texts)
        self.least = min([window, *map(len, texts)])
        n = len(nxt)
        self.link, self.length = np.array(link, np.int32), np.array(length, np.int32)
        #: For a state whose strings reach the window: the state of their last ``window`` words.
        reach = np.full(n, -1, np.int32)
        by_length = np.argsort(self.length, kind="stable").tolist()
        for v in by_length:
            if length[v] >= window:
                reach[v] = v if length[link[v]] < window else reach[link[v]]
        self.window_state = reach
        full, short = set(), set()
        for item, text in enumerate(texts):
            v = 0
            for w in text:
                v = nxt[v][w]
                if len(text) >= window and reach[v] >= 0:
                    full.add((int(reach[v]), item))
            if len(text) < window:
                while length[link[v]] >= len(text):
                    v = link[v]
                short.add((v, len(text), item))
        #: Items whose window a state stands for, and short items (length, item) that are whole in it, by state.
        self.full = np.array(sorted(full), np.int32).reshape(-1, 2)
        self.short = np.array(sorted(short), np.int32).reshape(-1, 3)
        #: The nearest state upwards, itself included, that has short items.
        self.short_state = np.full(n, -1, np.int32)
        own = set(self.short[:, 0].tolist())
        for v in by_length if own else ():
            self.short_state[v] = v if v in own else self.short_state[link[v]] if v else -1
        width = max(1, len(self.vocabulary))
        moves = sorted((v * width + w, to) for v, out in enumerate(nxt) for w, to in out.items())
        self.move, self.to = (np.array(x, t) for x, t in zip(zip(*moves, strict=True) if moves else ((), ()), (np.int64, np.int32), strict=True))
        pairs = {(a, b) for t in texts for a, b in zip(t, t[1:], strict=False)}
        self.bigrams = np.zeros(1 << 20, bool)
        if pairs:
            self.bigrams[self._pair(*(np.array(x, np.int64) for x in zip(*pairs, strict=True)))] = True

    @staticmethod
    def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Where a pair of words lies in the filter; two pairs may share a place."""
        return (a * 0x9E3779B1 + b * 0x85EBCA77) >> 7 & ((1 << 20) - 1)

    def _step(self, v: int, w: int) -> int:
        """The state behind ``v`` by word ``w``; -1 where there is none."""
        key = v * len(self.vocabulary) + w
        at = int(np.searchsorted(self.move, key))
        return int(self.to[at]) if at < len(self.move) and self.move[at] == key else -1

    def scan(self, text: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words are hit, and the items with windows that occur."""
        hit, found = np.zeros(len(text), bool), set()
        if len(text) < self.least or not self.vocabulary:
            return hit, found
        ids = np.fromiter(map(self.vocabulary.get, text, repeat(-1)), np.int64, len(text))
        joined = np.zeros(len(text) + 1, bool)  # word i follows word i-1 in some item, as far as the filter can tell
        known = ids >= 0
        joined[1:-1] = known[1:] & known[:-1] & self.bigrams[self._pair(ids[:-1], ids[1:])]
        if self.least == 1:
            starts = np.flatnonzero(known & ~joined[:-1])
            stops = np.flatnonzero(known & ~joined[1:]) + 1
        else:
            inner = joined[1:-1]
            edge = np.flatnonzero(np.diff(np.concatenate(([False], inner, [False])).astype(np.int8)))
            starts, stops = edge[::2], edge[1::2] + 1
        long = stops - starts >= self.least
        for a, b in zip(starts[long].tolist(), stops[long].tolist(), strict=True):
            self._stream(ids[a:b].tolist(), a, hit, found)
        return hit, {self.names[i] for i in found}

    def _stream(self, run: list[int], at: int, hit: np.ndarray, found: set[int]) -> None:
        link, length, window = self.link, self.length, self.window
        v = matched = 0
        for i, w in enumerate(run):
            to = self._step(v, w)
            while v and to < 0:
                v = int(link[v])
                matched = int(length[v])
                to = self._step(v, w)
            v, matched = (to, matched + 1) if to >= 0 else (0, 0)
            if matched >= window:
                hit[at + i + 1 - window : at + i + 1] = True
                found.update(self._rows(self.full, self.window_state[v])[:, 1].tolist())
            s = int(self.short_state[v])
            while s >= 0:
                for n, item in self._rows(self.short, s)[:, 1:].tolist():
                    if n <= matched:
                        hit[at + i + 1 - n : at + i + 1] = True
                        found.add(item)
                s = int(self.short_state[link[s]]) if s else -1

    @staticmethod
    def _rows(table_: np.ndarray, state: int) -> np.ndarray:
        return table_[np.searchsorted(table_[:, 0], state) : np.searchsorted(table_[:, 0], state, side="right")]


def _build(texts: list[list[int]]) -> tuple[list[dict[int, int]], list[int], list[int]]:
    """Transitions, suffix links and longest lengths of the states of the texts' automaton."""
    nxt: list[dict[int, int]] = [{}]
    link, length = [-1], [0]

    def clone(p: int, w: int, q: int) -> int:
        c = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = c
        while p != -1 and nxt[p].get(w) == q:
            nxt[p][w] = c
            p = link[p]
        return c

    def extend(last: int, w: int) -> int:
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else clone(last, w, q)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else clone(p, w, q)
        return cur

    for text in texts:
        last = 0
        for w in text:
            last = extend(last, w)
    return nxt, link, length


def blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items in runs of at most ``block_words`` words (a longer item comes alone); one run is held at a time."""
    out: list[tuple[str, list[bytes]]] = []
    n = 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text"))
    for r in rows.toLocalIterator():
        item = words(bytes(r["text"] or b""))
        if out and n + len(item) > block_words:
            yield out
            out, n = [], 0
        out.append(("" if r["item_id"] is None else r["item_id"], item))
        n += len(item)
    yield out


def mark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, pass_blocks: int = PASS_BLOCKS) -> DataFrame:
    """``docs`` with __hits (one bit for each word) and __items (ids of items with occurring windows)."""
    spark = docs.sparkSession
    ship(spark)
    docs = without(docs, "__hits", "__items")
    names = docs.columns

    def passed(frame: DataFrame, automata: list) -> DataFrame:
        def scan(batches):
            for batch in slices(batches):
                hits, items, none = [], [], [None] * batch.num_rows
                old = batch.column("__hits").to_pylist() if "__hits" in batch.schema.names else none
                had = batch.column("__items").to_pylist() if "__items" in batch.schema.names else none
                for text, bits, found in zip(as_bytes(batch.column("text")), old, had, strict=True):
                    own = words(text)
                    hit = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(own)).astype(bool) if bits else np.zeros(len(own), bool)
                    found = set(found or ())
                    for automaton in automata:
                        more, which = automaton.value.scan(own)
                        hit |= more
                        found |= which
                    hits.append(np.packbits(hit).tobytes())
                    items.append(sorted(found))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(x) for x in names), pa.array(hits, pa.binary()), pa.array(items, pa.list_(pa.string()))], names=[*names, "__hits", "__items"]
                )

        return frame.mapInArrow(scan, schema_of(docs, "__hits binary, __items array<string>"))

    held, waiting, out = None, [], docs
    for part in blocks(benchmark, block_words):
        if len(waiting) == pass_blocks:
            before, held = held, stage(passed(out, waiting), "decontam-pass")
            if before is not None:
                drop_stage(before)
            out, waiting = held, []
        waiting.append(spark.sparkContext.broadcast(SuffixAutomaton(part, window)))
    return passed(out, waiting)


@with_plain_names
def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, cover: int = COVER, block_words: int = BLOCK_WORDS, spans: bool = True, pass_blocks: int = PASS_BLOCKS
) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items, contaminated and, with ``spans``, clean_text.

    A document is contaminated if hit words are at least one in ``cover`` of its words. clean_text
    is the text without its hit spans (from the first byte of a span's first word to the last of its last).
    """
    docs = without(docs, "n_words", "n_hit", "n_items", "items", "contaminated", *["clean_text"] * spans)
    marked = mark(docs, benchmark, window, block_words, pass_blocks)
    names = docs.columns

    def finish(batches):
        for batch in slices(batches):
            n_words, n_hit, clean = [], [], []
            for text, bits in zip(as_bytes(batch.column("text")), batch.column("__hits").to_pylist(), strict=True):
                hits = int(np.bitwise_count(np.frombuffer(bits, np.uint8)).sum()) if bits else 0
                n_words.append(len(words(text)))
                n_hit.append(hits)
                if spans:
                    clean.append(cut(text, np.unpackbits(np.frombuffer(bits, np.uint8))) if hits else text)
            items = batch.column("__items")
            arrays = [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in items.to_pylist()], pa.int64()), items]
            flags = pa.array([h > 0 and cover * h >= n for h, n in zip(n_hit, n_words, strict=True)])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in names), *arrays, flags, *([pa.array(clean, pa.binary()).cast(pa.string())] if spans else [])],
                names=[*names, "n_words", "n_hit", "n_items", "items", "contaminated", *(["clean_text"] if spans else [])],
            )

    return marked.mapInArrow(finish, schema_of(docs, "n_words long, n_hit long, n_items long, items array<string>, contaminated boolean" + ", clean_text string" * spans))


def cut(text: bytes, hit: np.ndarray) -> bytes:
    """The text without the runs of hit words."""
    raw = np.frombuffer(text.translate(WORD_TABLE), np.uint8) != 32
    edge = np.diff(np.concatenate(([False], raw, [False])).astype(np.int8))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    h = hit[: len(starts)].astype(bool)
    runs = np.flatnonzero(np.diff(np.concatenate(([False], h, [False])).astype(np.int8)))
    out, at = [], 0
    for a, b in zip(runs[::2], runs[1::2], strict=True):
        out.append(text[at : starts[a]])
        at = stops[b - 1]
    return b"".join([*out, text[at:]])


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), spans=False)
    # Ids are digits, so that the order of strings is the same in every collation.
    sha = F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256)
    return out.select("doc_id", "n_words", "n_hit", "n_items", sha.alias("items_sha256"), "contaminated")


_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), {WINDOW}) AS n, array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') AS s
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - {WINDOW - 1}, 1))) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM win), strings AS (SELECT DISTINCT n, s FROM win),
grams AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)
), occ AS (SELECT doc_id, g.n, i, g.s FROM grams g JOIN strings USING (n, s)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM occ) GROUP BY doc_id),
own AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM occ JOIN win USING (n, s)) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND {COVER} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN own USING (doc_id)
"""
