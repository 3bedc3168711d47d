"""Sequence packing by cutting-stock column generation (operator 10).

1. One pass turns each document into ids and cuts it into full pieces of ``size`` ids and a
   remainder; a piece is known by its start, length and checksum, so that ids are made once
   and never kept.
2. The remainders' length histogram (at most ``size`` - 1 counts) goes to the driver. A linear
   program over patterns (multisets of lengths that fit in a sequence) covers it: the start is a
   greedy triangular basis, columns are priced by a knapsack dynamic program, and it ends
   when the bound it implies shows the use of sequences to be within ``gap`` of the least.
3. Pattern counts are rounded down; what is left (no more than a few items for each length) is
   packed best fit first. Remainders are ranked within their length, in salted groups of bounded
   size, and a rank selects its slot. Full pieces are sequences of their own.

Nothing that reaches the driver or a broadcast grows with the corpus: the histogram, the patterns and
the slot table are bounded by ``size``.

Edge cases: a null or empty text is its end id alone; a document of exactly k * ``size`` ids has no
remainder; rows with equal or null doc_id are packed each; ties rank by doc_id, then checksum. Only doc_id and text are
read: other columns, of any name, are left out.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import as_bytes, drop_stage, ship, slices, stage, table

SIZE, END_ID = 2048, 1
#: Columns are generated until the proven gap is this small, or so many have been: the last plan is whole in any case.
GAP, MAX_COLUMNS = 0.0005, 600
GROUP_ROWS = 2000
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
_BLANK = np.zeros(256, bool)
_BLANK[[*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0xC2]] = True
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class ByteEncoder:
    """Ids as the tokenizers library gives them for ``tokenizer``.

    Texts of characters up to U+027F go through tiktoken with the same vocabulary, which gives the same
    ids several times faster (tests compare the two libraries character class by character class);
    all others, texts that hold a special token's string, and long texts with a long run of white space (on which
    tiktoken's pattern overflows) through tokenizers itself.
    """

    #: Bytes, and white space in one run, up to which tiktoken's pattern is far from its limit of a million steps.
    SAFE_BYTES, SAFE_RUN = 1 << 17, 1 << 12

    def __init__(self, tokenizer: str, ranks: str | None):
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.load = lambda: Tokenizer.from_file(tokenizer)
        self.loaded = None
        with open(tokenizer, encoding="utf-8") as f:
            self.special = [t["content"].encode() for t in json.load(f)["added_tokens"]]
        self.fast = None
        if ranks:
            with open(ranks, "rb") as f:
                vocabulary = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary, special_tokens={})
        self.other = re.compile(rb"[\xca-\xff]|" + b"|".join(map(re.escape, self.special or [b"\xff"])))

    @property
    def exact(self):
        """The library's tokenizer, loaded when the first text asks for it."""
        if self.loaded is None:
            self.loaded = self.load()
        return self.loaded

    def blank(self, text: bytes) -> bool:
        """Whether a long text has a run of over SAFE_RUN bytes that white space is made of."""
        if len(text) <= self.SAFE_BYTES:
            return False
        ink = np.flatnonzero(~_BLANK[np.frombuffer(text, np.uint8)])
        return int(np.diff(ink, prepend=-1, append=len(text)).max()) > self.SAFE_RUN

    def ids(self, text: bytes) -> list[int]:
        s = text.decode("utf-8", "replace")
        if self.fast is None or self.other.search(text) or self.blank(text):
            return self.exact.encode(s, add_special_tokens=False).ids
        return self.fast.encode_ordinary(s)


def _encoder(tokenizer: str, ranks: str | None, cache: dict = {}) -> ByteEncoder:  # noqa: B006  one for each worker
    if (tokenizer, ranks) not in cache:
        cache[tokenizer, ranks] = ByteEncoder(tokenizer, ranks)
    return cache[tokenizer, ranks]


def pieces(docs: DataFrame, tokenizer: str, ranks: str | None, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """Full pieces and remainders of all documents."""
    ship(docs.sparkSession)

    def cut(batches):
        encoder = _encoder(tokenizer, ranks)
        for batch in slices(batches):
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), as_bytes(batch.column("text")), strict=True):
                ids = encoder.ids(text)
                ids.append(end_id)
                raw, n = memoryview(np.array(ids, "<u4").tobytes()), len(ids)
                rows += [(doc, s, min(size, n - s), zlib.crc32(raw[4 * s : 4 * (s + size)]), n) for s in range(0, n, size)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


def greedy_basis(counts: dict[int, int], size: int) -> tuple[list[dict[int, int]], list[float]]:
    """Patterns, largest lengths first, each used until a length runs out, and their (fractional) counts.

    Each pattern holds the length that it exhausts and none exhausted before, so that the patterns
    are a triangular, invertible basis. A length exhausted beside another gets a pattern of its own at 0.
    """
    left = {k: float(v) for k, v in counts.items()}
    order = sorted(left, reverse=True)
    patterns, used = [], []
    while order:
        room, pattern = size, {}
        for k in order:
            n = min(room // k, max(1, int(left[k])))
            if n:
                pattern[k] = n
                room -= n * k
        x = min(left[k] / n for k, n in pattern.items())
        gone = [k for k, n in pattern.items() if left[k] / n - x <= 1e-9 * max(1.0, x)]
        for k, n in pattern.items():
            left[k] -= x * n
        patterns.append(pattern)
        used.append(x)
        for k in gone[1:]:
            patterns.append({k: size // k})
            used.append(0.0)
        order = [k for k in order if k not in set(gone)]
    return patterns, used


def price(lengths: np.ndarray, values: np.ndarray, size: int) -> tuple[float, dict[int, int]]:
    """The most valuable pattern (an unbounded knapsack), by dynamic programming over capacities."""
    choice = np.full(size + 1, -1, np.int64)
    by_length = np.zeros(size + 1)
    by_length[lengths] = np.maximum(values, 0)
    positive = lengths[values > 1e-12]
    best = np.zeros(size + 1)
    worth = by_length[positive]
    for c in range(1, size + 1):
        n = np.searchsorted(positive, c, side="right")
        best[c] = best[c - 1]
        if n:
            v = worth[:n] + best[c - positive[:n]]
            k = int(v.argmax())
            if v[k] > best[c] + 1e-12:
                best[c], choice[c] = v[k], positive[k]
    pattern: dict[int, int] = {}
    c = size
    while c > 0:
        if choice[c] < 0:
            c -= 1
            continue
        pattern[int(choice[c])] = pattern.get(int(choice[c]), 0) + 1
        c -= int(choice[c])
    return float(best[size]), pattern


def solve(counts: dict[int, int], size: int = SIZE, gap: float = GAP, max_columns: int = MAX_COLUMNS) -> tuple[list[tuple[dict[int, int], float]], float]:
    """(patterns with counts, proven gap) of the covering linear program, by the revised simplex method."""
    if not counts:
        return [], 0.0
    patterns, used = greedy_basis(counts, size)
    lengths = np.array(sorted(counts), np.int64)
    row = {int(k): i for i, k in enumerate(lengths)}

    def column(p: dict[int, int]) -> np.ndarray:
        a = np.zeros(len(lengths))
        for k, n in p.items():
            a[row[k]] = n
        return a

    demand = np.array([counts[int(k)] for k in lengths], float)
    inverse = np.linalg.inv(np.stack([column(p) for p in patterns], 1))
    # A slightly moved demand keeps the simplex method from standing still at ties.
    moved = demand + np.random.default_rng(0).uniform(1e-4, 1e-3, len(demand))
    x = inverse @ moved
    least = float(lengths @ demand) / size
    good = (list(patterns), inverse @ demand)
    for step in range(max_columns):
        duals = inverse.sum(0)
        most, pattern = price(lengths, duals, size)
        # Duals over the largest value are feasible, so that x.sum() / most bounds the least use from below.
        least = max(least, x.sum() / max(most, 1.0)) if most > 0 else least
        if most <= 1 + 1e-9 or x.sum() - least <= max(1.0, gap * least):
            break
        move = inverse @ column(pattern)
        grow = move > 1e-7
        ratio = np.full(len(x), np.inf)
        ratio[grow] = np.maximum(x[grow], 0) / move[grow]
        if not np.isfinite(ratio.min()):
            break
        out = int(np.where(ratio <= ratio.min() + 1e-9, move, -1).argmax())
        pivot = inverse[out] / move[out]
        inverse -= np.outer(move, pivot)
        inverse[out] = pivot
        patterns[out] = pattern
        if step % 50 == 49:  # against drift; a basis that has become singular gives way to the last good one
            try:
                inverse = np.linalg.inv(np.stack([column(p) for p in patterns], 1))
            except np.linalg.LinAlgError:
                break
            if (inverse @ moved).min() < -1e-3:
                break
            good = (list(patterns), inverse @ demand)
        x = inverse @ moved
    final = inverse @ demand
    if np.isfinite(final).all() and final.min() > -1.0 and final.sum() <= good[1].sum() + 1:
        good = (patterns, final)
    solved = [(p, float(max(0.0, v))) for p, v in zip(*good, strict=True)]
    used_now = sum(v for _, v in solved)
    return solved, max(0.0, 1 - least / max(used_now, 1e-9))


def fill(left: dict[int, int], size: int) -> list[dict[int, int]]:
    """Sequences for the few items left, best fit first: the largest item, then the best set that fits behind it."""
    left = {k: v for k, v in left.items() if v > 0}
    out = []
    while left:
        first = max(left)
        pattern, room = {first: 1}, size - first
        left[first] -= 1
        # Bounded subset sum over what is left: reach[c] is a last item of a set that fills c.
        reach = np.full(room + 1, -1, np.int64)
        reach[0] = 0
        filled = {0: {}}
        for k in sorted((k for k, v in left.items() if v and k <= room), reverse=True):
            for c in sorted(filled, reverse=True):
                for n in range(1, min(left[k], (room - c) // k) + 1):
                    if c + n * k not in filled:
                        filled[c + n * k] = {**filled[c], k: n}
            if room in filled:
                break
        for k, n in filled[max(filled)].items():
            pattern[k] = pattern.get(k, 0) + n
            left[k] -= n
        left = {k: v for k, v in left.items() if v}
        out.append(pattern)
    return out


def plan(counts: dict[int, int], size: int = SIZE, gap: float = GAP, max_columns: int = MAX_COLUMNS) -> list[tuple[dict[int, int], int]]:
    """Integer pattern counts that hold every item exactly once."""
    solved, _ = solve(counts, size, gap, max_columns)
    left, out = dict(counts), []
    for pattern, x in solved:
        # A pattern may hold more of a length than remains of it.
        n = min([int(x + 1e-6), *(left[k] // m for k, m in pattern.items())])
        if n > 0:
            out.append((pattern, n))
            for k, m in pattern.items():
                left[k] -= m * n
    return out + [(p, 1) for p in fill(left, size)]


def slots(chosen: list[tuple[dict[int, int], int]]) -> pd.DataFrame:
    """For each pattern and length: the ranks (first, last + 1) that it takes, and where they lie."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, n in chosen:
        offset = 0
        for k in sorted(pattern, reverse=True):
            m, first = pattern[k], taken.get(k, 0)
            rows.append((k, first, m, sequence, offset))
            taken[k] = first + m * n
            offset += m * k
        sequence += n
    out = pd.DataFrame(rows, columns=["length", "first", "each", "sequence", "offset"]).sort_values(["length", "first"], ignore_index=True)
    out.attrs["sequences"] = sequence
    return out


def ranked(rest: DataFrame, n_salts: int) -> DataFrame:
    """``rest`` with its rank (from 0) within its length; a group to be sorted holds about GROUP_ROWS rows."""
    salted = rest.withColumn("salt", F.pmod(F.xxhash64("doc_id", "ids_crc32", "start"), F.lit(n_salts)))
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "ids_crc32", "start"))
    return salted.withColumn("inside", inside).join(sizes.drop("n"), ["length", "salt"]).withColumn("rank", F.col("before") + F.col("inside") - 1).drop("salt", "inside", "before")


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, size: int = SIZE, end_id: int = END_ID, gap: float = GAP, max_columns: int = MAX_COLUMNS) -> DataFrame:
    """Pieces of all documents with their sequence_id and offset."""
    spark = docs.sparkSession
    cut = stage(pieces(docs, tokenizer, ranks, size, end_id), "pieces")
    rest, full = cut.where(F.col("length") < size), cut.where(F.col("length") == size)
    counts = {r["length"]: r["n"] for r in rest.groupBy("length").agg(F.count("*").alias("n")).collect()}
    where = slots(plan(counts, size, gap, max_columns))
    sequences = where.attrs["sequences"]
    most = max(counts.values(), default=0)
    n_salts = max(1, -(-most // max(GROUP_ROWS, most // 100_000)))
    shared = spark.sparkContext.broadcast(where)

    def place(frames):
        at = shared.value
        key = at.length.to_numpy(np.int64) * (1 << 48) + at["first"].to_numpy(np.int64)
        first, each, sequence, offset = (at[x].to_numpy(np.int64) for x in ("first", "each", "sequence", "offset"))
        for f in frames:
            length, rank = f.length.to_numpy(np.int64), f["rank"].to_numpy(np.int64)
            i = np.searchsorted(key, length * (1 << 48) + rank, side="right") - 1
            inside = rank - first[i]
            yield f.drop(columns="rank").assign(sequence_id=sequence[i] + inside // each[i], offset=offset[i] + inside % each[i] * length)

    placed = ranked(rest, n_salts).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank")
    placed = placed.mapInPandas(place, f"{PIECES}, sequence_id long, offset long")
    alone = full.withColumn("sequence_id", F.monotonically_increasing_id() + F.lit(sequences)).withColumn("offset", F.lit(0).cast("long"))
    return placed.unionByName(alone)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.path(RANKS))
