"""Near-duplicate documents by improved consistent weighted sampling (operator 1).

A document is the multiset of its shingles of five words; a shingle weighs its count times an inverse
document frequency. Similarity is the weighted Jaccard similarity, and documents are linked at 0.8 or more.

1. Document frequencies of all shingles of all documents go into a count sketch of fixed size: rows of
   counters, less what other shingles add to a counter on average; the least counter of a shingle is its frequency. The weight
   depends on the share of documents alone: ``1 - DAMP * log(share / FLOOR) / log(1 / FLOOR)`` above FLOOR, else 1; so it is alike at
   every size, and a passage that very many documents share weighs little without making large groups of copies dissimilar.
2. Documents with the same sequence of words are one text: they are reduced to the smallest doc_id.
3. Each distinct text gets ``BANDS`` x ``ROWS`` consistent weighted samples, banded into bucket keys. In a bucket
   texts are compared with its leader (the smallest id) first, by exact weighted Jaccard similarity; a leader's text goes
   once to each task that has its partners. In a bucket of more than ``BLOCK`` texts that holds several classes then, the
   largest id is a second leader.
4. Buckets that still hold texts of several classes are compared in full, cell by cell: every pair that shares a bucket is in one
   class or verified. Buckets with the same members, and small ones with the same leader, are one. A bucket's largest class meets the others, and the others
   each other, in blocks of texts, two to a cell, so that no pair is a row and a large bucket is many tasks' work.
5. Links are joined into classes by alternating large-star and small-star steps, cut by written tables.

Edge cases: a text of one to four words is one shingle; texts without words (null, empty, symbols) are like
nothing, each a class of its own; rows that repeat a doc_id are one document, whose text is the one of the least hash; null
doc_ids take no part and are not returned. Only doc_id and text are read: other columns, of any name, are left out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_TABLE, as_bytes, drop_stage, mix64, ship, slices, stage, table

WIDTH, SIMILARITY = 5, 0.8
BANDS, ROWS = 12, 3
#: The sketch: rows of 2 ** LOG counters, in parts of PART counters.
SKETCH_ROWS, LOG, PART = 2, 19, 1 << 13
FLOOR, DAMP = 1 / 1024, 0.5
MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)
#: Random parameters of the samples are drawn from tables of 2 ** TABLE entries.
TABLE = 18
#: Bytes of text that are made into shingles at a time: some fifty times as much memory is used for them.
SLICE = 1 << 20
#: A class's size meets its documents in so many groups.
CLASS_SALTS = 32
#: Texts, and distinct shingles, of a block of a bucket that is compared in full (on average: blocks are dealt by hash).
BLOCK, BLOCK_SHINGLES = 512, 1_500_000
#: Buckets of at most so many texts that have the same leader are compared as one: each has BANDS at most, so a group has BANDS * SMALL texts.
SMALL = 64
#: Bits of the map of ids that keeps texts out of the shuffle (4 MB): those without partners, and those that no class drops.
MAP_BITS = 25

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACE = [np.uint64(x | 1) for x in _RNG.integers(1, 1 << 63, WIDTH, dtype=np.uint64).tolist()]


def _powers(n: int, base: int, cache: dict = {}) -> np.ndarray:  # noqa: B006  one for each worker
    have = cache.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        cache[base] = have
    return have[:n]


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, hash) of every shingle of the texts, in order, and each text's hash of its word sequence (0: no words).

    Word hashes come from prefix sums of byte codes times powers, all in unsigned 64-bit arithmetic.
    """
    joined = b" ".join(texts) + b" "
    raw = np.frombuffer(joined.translate(WORD_TABLE), np.uint8)
    inside = raw != 32
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    ends = np.cumsum([len(t) + 1 for t in texts])
    n = len(raw)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * _powers(n, MULTIPLIER), dtype=np.uint64)))
    word = mix64((sums[stops] - sums[starts]) * _powers(n, INVERSE)[starts])
    doc = np.searchsorted(ends, starts, side="right")
    counts = np.bincount(doc, minlength=len(texts))
    first = np.concatenate(([0], np.cumsum(counts)))
    # Hash of the whole sequence of words, to collapse equal texts.
    at = np.arange(len(word)) - first[doc]
    most = int(counts.max(initial=1))
    seq = np.zeros(len(texts), np.uint64)
    some = counts > 0
    if len(word):
        seq[some] = np.add.reduceat(word * _powers(most, MULTIPLIER)[at], first[:-1][some], dtype=np.uint64)
        seq[some] = mix64(seq[some] + counts[some].astype(np.uint64)) | np.uint64(1)
    # A shingle starts at each word that has WIDTH - 1 words of its document behind it, or at the first of a short one.
    own = (at + WIDTH <= counts[doc]) | ((at == 0) & (counts[doc] < WIDTH))
    begin = np.flatnonzero(own)
    h = np.zeros(len(begin), np.uint64)
    for j in range(WIDTH):
        k = np.minimum(begin + j, len(word) - 1)
        h += np.where(begin + j < first[doc[begin] + 1], word[k], np.uint64(0)) * _PLACE[j]
    return doc[begin], mix64(h), seq


def vectors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, 48-bit shingle, count) of distinct shingles, by document, and the texts' hashes."""
    doc, h, seq = shingles(texts)
    key = np.sort((doc.astype(np.uint64) << np.uint64(48)) | (h >> np.uint64(16)))
    new = np.flatnonzero(np.diff(key, prepend=~key[:1]))
    count = np.diff(np.append(new, len(key)))
    key = key[new]
    return (key >> np.uint64(48)).astype(np.int64), key & np.uint64((1 << 48) - 1), count, seq


def counters(shingle: np.ndarray) -> list[np.ndarray]:
    """The shingle's counter in each row of the sketch."""
    mixed = mix64(shingle)
    return [(mixed >> np.uint64(LOG * r)).astype(np.int64) & ((1 << LOG) - 1) for r in range(SKETCH_ROWS)]


def sketch(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Weights by counter (rows x 2 ** LOG), and the number of documents with words. Size fixed by LOG."""

    def count(batches):
        total, n = np.zeros((SKETCH_ROWS, 1 << LOG), np.int64), 0
        for batch in slices(batches, most=SLICE):
            _, s, _, seq = vectors(as_bytes(batch.column("text")))
            n += int((seq > 0).sum())
            for r, c in enumerate(counters(s)):
                total[r] += np.bincount(c, minlength=1 << LOG)
        flat = total.ravel()
        parts = [(p, flat[p * PART : (p + 1) * PART].astype("<i8")) for p in range(len(flat) // PART)]
        rows = [(p, x.tobytes()) for p, x in parts if x.any()] + [(-1, np.array([n], "<i8").tobytes())]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())], names=["part", "counts"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for p, b in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                total[p] = total.get(p, 0) + np.frombuffer(b, "<i8")
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["part", "counts"])

    kind = "part int, counts binary"
    parts = docs.select("text").mapInArrow(count, kind).repartition("part").mapInArrow(add, kind).collect()
    flat, n = np.zeros(SKETCH_ROWS << LOG, np.int64), 0
    for r in parts:
        x = np.frombuffer(bytes(r["counts"]), "<i8")
        if r["part"] < 0:
            n += int(x[0])
        else:
            flat[r["part"] * PART : (r["part"] + 1) * PART] = x
    return flat.reshape(SKETCH_ROWS, -1), n


def weights_of(total: np.ndarray, n: int) -> np.ndarray:
    """Inverse document frequency by counter, as float32; larger for rarer shingles."""
    # A counter holds its share of all other shingles too: their mean is taken off.
    others = (total.sum(1, keepdims=True) - total) / (total.shape[1] - 1)
    share = np.maximum(total - others, 1) / max(n, 1)
    rare = 1 - DAMP * np.log(np.maximum(share, FLOOR) / FLOOR) / np.log(1 / FLOOR)
    return rare.clip(1 - DAMP, 1).astype(np.float32)


def idf(weights: np.ndarray, shingle: np.ndarray) -> np.ndarray:
    return np.maximum.reduce([weights[r][c] for r, c in enumerate(counters(shingle))])


def _tables(cache: dict = {}) -> tuple[np.ndarray, np.ndarray, np.ndarray]:  # noqa: B006  one for each worker
    """r ~ Gamma(2, 1), log c with c ~ Gamma(2, 1), beta ~ uniform."""
    if not cache:
        rng = np.random.default_rng(7)
        cache["t"] = (rng.gamma(2, 1, 1 << TABLE).astype(np.float32), np.log(rng.gamma(2, 1, 1 << TABLE)).astype(np.float32), rng.random(1 << TABLE, dtype=np.float32))
    return cache["t"]


def samples(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n_docs: int) -> np.ndarray:
    """Consistent weighted samples, 32 bits each: one row for each document with shingles, BANDS * ROWS columns."""
    r_all, c_all, b_all = _tables()
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    out = np.zeros((len(first), BANDS * ROWS), np.uint32)
    log_w = np.log(weight).astype(np.float32)
    base = mix64(shingle + np.uint64(1))
    low = np.uint64((1 << 32) - 1)
    for k in range(BANDS * ROWS):
        h = base * np.uint64((MULTIPLIER * (2 * k + 3)) & ((1 << 64) - 1)) + np.uint64(k)
        h ^= h >> np.uint64(32)
        i = (h & np.uint64((1 << TABLE) - 1)).astype(np.int64)
        r = r_all[i]
        t = np.floor(log_w / r + b_all[i])
        log_a = c_all[i] - r * (t - b_all[i] + 1)
        # The least a wins; its order as an integer, then the element and its level.
        bits = log_a.view(np.uint32)
        order = np.where(bits >> np.uint32(31), ~bits, bits | np.uint32(1 << 31)).astype(np.uint64)
        name = (h >> np.uint64(20)) + t.astype(np.int64).view(np.uint64) * np.uint64(0x85EBCA6B)
        out[:, k] = (np.minimum.reduceat((order << np.uint64(32)) | (name & low), first) & low).astype(np.uint32)
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    keys = np.zeros((len(signature), BANDS), np.uint64)
    for b in range(BANDS):
        h = np.full(len(signature), b + 1, np.uint64)
        for j in range(ROWS):
            h = mix64(h * np.uint64(MULTIPLIER) + signature[:, b * ROWS + j].astype(np.uint64))
        keys[:, b] = h
    return keys


def sign(docs: DataFrame, weights) -> DataFrame:
    """doc_id, h (hash of the text), seq (hash of the word sequence; null without words), band keys, number of distinct shingles."""

    def run(batches):
        for batch in slices(batches, most=SLICE):
            texts = as_bytes(batch.column("text"))
            doc, s, count, seq = vectors(texts)
            some = np.unique(doc)
            signature = samples(doc, s, count * idf(weights.value, s), len(texts)) if len(some) else np.zeros((0, BANDS * ROWS), np.uint32)
            held = np.zeros(len(texts), bool)
            held[some] = True
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(held * BANDS))), pa.int32()), pa.array(bands(signature).ravel().view(np.int64)))
            sizes = np.bincount(doc, minlength=len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("h"), pa.array(seq.view(np.int64), mask=~held), lists, pa.array(sizes, pa.int64())], names=["doc_id", "h", "seq", "bands", "size"]
            )

    return docs.select("doc_id", "text", F.xxhash64("text").alias("h")).mapInArrow(run, "doc_id long, h long, seq long, bands array<long>, size long")


def perhaps(ids: DataFrame, key: str) -> Column:
    """Whether a row's ``key`` may be among ``ids``' (one column, ``key``): never false for one that is.

    A bit map of hashed ids, of a size fixed by MAP_BITS; a full map says yes to more.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(1 << MAP_BITS))
    longs = ids.select(slot.alias("s")).groupBy(F.shiftright("s", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("b")).toArrow()
    bits = np.zeros(1 << (MAP_BITS - 6), np.int64)
    bits[longs.column("w").to_numpy()] = longs.column("b").to_numpy()
    shared = ids.sparkSession.sparkContext.broadcast(bits.view(np.uint64))

    @F.pandas_udf("boolean")
    def maybe(s: pd.Series) -> pd.Series:
        at = s.to_numpy()
        return pd.Series((shared.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1)

    return maybe(slot)


def among(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents whose ``key`` is in ``ids``. The map takes out nearly all others before texts are shuffled; the join decides."""
    return docs.where(perhaps(ids, key)).join(ids, key, "left_semi")


def beside(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents whose ``key`` is not in ``ids``. Nearly all of them pass by the map, and are not shuffled; the join decides on the rest."""
    maybe = perhaps(ids, key)
    rest = docs.where(maybe).join(ids.select(F.col(key).alias("__in")), F.col(key) == F.col("__in"), "left_anti")
    return docs.where(~maybe).union(rest)


def leaders(keyed: DataFrame) -> DataFrame:
    """(a, b): each bucket's smallest id with each other member. Sizes of buckets do not matter: no member list is made."""
    least = keyed.groupBy("key").agg(F.min("id").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    return keyed.join(least, "key").where("id <> a").select("a", F.col("id").alias("b")).distinct()


def jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], weights: np.ndarray) -> float:
    """Weighted Jaccard similarity of two (distinct sorted shingles, counts)."""
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = float((np.minimum(a[1][i], b[1][j]) * idf(weights, both).astype(np.float64)).sum())
    whole = sum(float((c * idf(weights, s).astype(np.float64)).sum()) for s, c in (a, b))
    return low / (whole - low) if whole > low else 1.0


def verify(pairs: DataFrame, docs: DataFrame, weights, similarity: float, n_salts: int = 16) -> DataFrame:
    """``pairs`` (a, b) with their exact similarity and whether it suffices; a's text is sent once to each salt that has partners of a."""
    texts = docs.select("doc_id", F.col("text").alias("t"))
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(n_salts)))
    right = salted.join(texts, F.col("b") == F.col("doc_id")).select("a", "salt", "b", "t")
    left = salted.select("a", "salt").distinct().join(texts, F.col("a") == F.col("doc_id")).select("a", "salt", F.lit(None).cast("long").alias("b"), "t")
    dealt = left.unionByName(right).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").isNotNull())

    def run(batches):
        held, own = None, None
        for batch in slices(batches, "t", SLICE):
            doc, s, count, _ = vectors(as_bytes(batch.column("t")))
            cut = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            rows = []
            for i, (a, b) in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)):
                v = (s[cut[i] : cut[i + 1]], count[cut[i] : cut[i + 1]])
                if b is None:
                    held, own = a, v
                elif held == a:
                    rows.append((a, b, jaccard(own, v, weights.value)))
            a, b, x = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(x, pa.float64())], names=["a", "b", "similarity"])

    return dealt.mapInArrow(run, "a long, b long, similarity double").withColumn("linked", F.col("similarity") >= similarity)


def undecided(reps: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, id, size, class) of buckets' members other than the leader, where these are of several classes.

    Buckets of at most SMALL texts with one leader are one, as they share most members: a text is sent once for them, not once for each.
    """
    keyed = reps.select("id", "size", F.explode("bands").alias("key"))
    least = keyed.groupBy("key").agg(F.min("id").alias("a"), F.count("*").alias("n")).where("n > 2")
    of = classes.select(F.col("id").alias("__id"), "class")
    members = keyed.join(least, "key").where("id <> a").join(of, F.col("id") == F.col("__id"), "left")
    members = members.select("key", "a", "n", "id", "size", F.coalesce("class", "id").alias("class"))
    several = members.groupBy("key").agg(F.min("class").alias("c0"), F.max("class").alias("c1")).where("c0 <> c1").select("key")
    key = F.when(F.col("n") <= SMALL, F.xxhash64(F.lit("led by"), F.col("a"))).otherwise(F.col("key"))
    return members.join(several, "key", "left_semi").select(key.alias("key"), "id", "size", "class").distinct()


def cells(members: DataFrame) -> DataFrame:
    """(key, kind, i, j, side, id, class): the cells in which a bucket's members meet. Members of side -1 meet all, others those of the other side."""
    of = members.groupBy("key", "class").agg(F.count("*").alias("n"), F.sum("size").alias("m"), *(F.bit_xor(F.xxhash64("id", F.lit(x))).alias(f"h{x}") for x in (0, 1)))
    buckets = of.groupBy("key").agg(
        F.max_by("class", F.struct("n", "class")).alias("main"), F.max(F.struct("n", "class", "m")).alias("most"),
        F.sum("n").alias("n"), F.sum("m").alias("m"), F.bit_xor("h0").alias("h0"), F.bit_xor("h1").alias("h1"),
    )
    blocks = lambda n, m: F.ceil(F.greatest(n / BLOCK, m / BLOCK_SHINGLES, F.lit(1))).cast("int")
    buckets = buckets.select("key", "main", "n", "h0", "h1", blocks(F.col("most.n"), F.col("most.m")).alias("bm"), blocks(F.col("n") - F.col("most.n"), F.col("m") - F.col("most.m")).alias("bo"))
    # Buckets with the same members are one.
    buckets = buckets.groupBy("n", "h0", "h1").agg(F.min_by(F.struct("key", "main", "bm", "bo"), "key").alias("x")).select("x.*")
    cell = lambda kind, i, j, side: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.cast("int").alias("side"))
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    zero, p, q = F.lit(0), F.col("p"), F.col("q")
    with_main = F.transform(upto(F.col("bo")), lambda j: cell(1, q, j, F.lit(0)))
    other = F.concat(
        F.transform(upto(F.col("bm")), lambda i: cell(1, i, p, F.lit(1))),
        F.transform(upto(F.col("bo")), lambda j: cell(2, F.least(p, j), F.greatest(p, j), F.when(j == p, -1).when(p < j, 0).otherwise(1))),
    )
    at = lambda b: F.pmod(F.xxhash64("id"), F.col(b)).cast("int")
    dealt = members.join(buckets, "key").withColumn("p", at("bo")).withColumn("q", at("bm"))
    where = F.when((F.col("bm") == 1) & (F.col("bo") == 1), F.array(cell(0, zero, zero, F.lit(-1)))).when(F.col("class") == F.col("main"), with_main).otherwise(other)
    return dealt.select("key", "id", "class", F.explode(where).alias("c")).select("key", "c.*", "id", "class")


def links_of_cell(ids: list[int], classes: list[int], sides: list[int], vectors_: list, weights: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Links (a, b) that join the classes of a cell's members as all pairs of them would.

    Pairs of one class, of one side, and of total weights too far apart for the similarity are left out: they add nothing.
    One text is held against all others left at once.
    """
    if min(classes) == max(classes):
        return []
    count = np.concatenate([c for _, c in vectors_]).astype(np.float64)
    shingle = np.concatenate([s for s, _ in vectors_])
    weight = idf(weights, shingle).astype(np.float64)
    size = np.array([len(s) for s, _ in vectors_])
    start = np.concatenate(([0], np.cumsum(size)))
    whole = np.add.reduceat(count * weight, start[:-1])
    local = np.unique(shingle, return_inverse=True)[1]
    dense = np.zeros(int(local.max()) + 1)
    root, side = np.unique(np.array(classes), return_inverse=True)[1], np.array(sides)
    out = []
    for i in range(len(ids) - 1):
        low_, high = whole[i] * similarity * (1 - 1e-9), whole[i] / similarity * (1 + 1e-9)
        rest = slice(i + 1, None)
        left = i + 1 + np.flatnonzero((root[rest] != root[i]) & ((side[rest] < 0) | (side[rest] != side[i])) & (whole[rest] >= low_) & (whole[rest] <= high))
        if not len(left):
            continue
        own = slice(start[i], start[i + 1])
        dense[local[own]] = count[own]
        ends = np.cumsum(size[left])
        at = np.arange(ends[-1]) + np.repeat(start[left] - (ends - size[left]), size[left])
        low = np.add.reduceat(np.minimum(count[at], dense[local[at]]) * weight[at], ends - size[left])
        dense[local[own]] = 0
        for j in left[low / (whole[i] + whole[left] - low) >= similarity]:
            if root[i] != root[j]:
                out.append((ids[i], ids[j]))
                root[root == root[j]] = root[i]
    return out


def compare_in_full(members: DataFrame, texts: DataFrame, weights, similarity: float) -> DataFrame:
    """Links (a, b) among ``members`` (of :func:`undecided`): each pair that shares a bucket is in one class or compared."""
    cell = ["key", "kind", "i", "j"]
    dealt = cells(members).join(texts.select("doc_id", F.col("text").alias("t")), F.col("id") == F.col("doc_id")).drop("doc_id")
    dealt = dealt.repartition(*cell).sortWithinPartitions(*cell)

    def run(batches):
        name, held = None, ([], [], [], [])

        def done():
            found = links_of_cell(*held, weights.value, similarity) if len(held[0]) > 1 else []
            a, b = zip(*found, strict=True) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in slices(batches, "t", SLICE):
            doc, s, count, _ = vectors(as_bytes(batch.column("t")))
            cut = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            names = zip(*(batch.column(c).to_pylist() for c in cell), strict=True)
            for i, (new, *row) in enumerate(zip(names, *(batch.column(c).to_pylist() for c in ("id", "class", "side")), strict=True)):
                if new != name:
                    yield done()
                    name, held = new, ([], [], [], [])
                for x, to in zip((*row, (s[cut[i] : cut[i + 1]].copy(), count[cut[i] : cut[i + 1]].copy())), held, strict=True):
                    to.append(x)
        yield done()

    return dealt.mapInArrow(run, "a long, b long")


def components(links: DataFrame, most: int = 60) -> DataFrame:
    """(id, class): the smallest id of each node's component, by large-star and small-star steps.

    An edge goes from its larger end u to its smaller end v. Each round shortens the longest chain by half or so; ``most`` rounds are
    far more than any number of ids needs, and an error else.
    """
    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    for _ in range(most):
        # Large star: u is tied to the least neighbour of v, which is v itself where v has no smaller one.
        low = edges.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m"))
        large = edges.join(low, "v", "left").select("u", F.coalesce("m", "v").alias("v")).repartition("u").distinct()
        # Small star: u and its neighbours, all smaller, are tied to the least of them.
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        new = stage(small, "links")
        drop_stage(edges)
        edges = new
        if settled(edges):
            break
    else:
        raise RuntimeError("components did not settle")
    out = edges.select(F.col("u").alias("id"), F.col("v").alias("class"))
    out._voltweave_path = edges._voltweave_path
    return out


def settled(edges: DataFrame) -> bool:
    """Whether every node is tied to one smaller node, and that one to none."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("id"), F.lit(1).alias("up")), F.struct(F.col("v").alias("id"), F.lit(0).alias("up")))).alias("x")).select("x.*")
    return ends.groupBy("id").agg(F.sum("up").alias("n"), F.min("up").alias("least")).where("n > 1 OR n = 1 AND least = 0").isEmpty()


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (the class's smallest doc_id) and n_class (its documents) of each document of ``docs``."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    weights = spark.sparkContext.broadcast(weights_of(*sketch(docs)))
    signed = stage(sign(docs, weights), "signed")
    if not signed.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        rows, signed = signed, stage(signed.groupBy("doc_id").agg(F.min(F.struct("h", "seq", "bands", "size")).alias("x")).select("doc_id", "x.*"), "signed")
        drop_stage(rows)
    # One representative for each sequence of words: the smallest id. Equal sequences have equal bands.
    worded = signed.where("seq IS NOT NULL").groupBy("seq")
    reps = stage(worded.agg(F.min("doc_id").alias("id"), F.count("*").alias("n"), F.first("bands").alias("bands"), F.first("size").alias("size")), "reps")

    pairs = stage(leaders(reps.select("id", F.explode("bands").alias("key"))), "pairs")
    # The texts that have partners are taken out once.
    involved = stage(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "involved")
    texts = stage(among(docs, involved).groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text")), "texts")
    first = stage(verify(pairs, texts, weights, similarity).where("linked").select("a", "b"), "verified")
    used = [signed, reps, pairs, involved, texts, first]
    found = components(first)
    members = stage(undecided(reps, found), "members")
    used.append(members)
    # A second leader makes most of a large group of copies one class, and the comparison in full short. It leaves nothing out.
    large = members.groupBy("key").agg(F.max("id").alias("a"), F.max_by("class", "id").alias("ac"), F.count("*").alias("n")).where(F.col("n") > BLOCK).drop("n")
    more = stage(members.join(large, "key").where("class <> ac").select("a", F.col("id").alias("b")).distinct(), "pairs")
    used += [more, found]
    if not more.isEmpty():
        second = stage(verify(more, texts, weights, similarity).where("linked").select("a", "b"), "verified")
        found = components(found.select(F.col("id").alias("a"), F.col("class").alias("b")).unionByName(second))
        members = stage(undecided(reps, found), "members")
        used += [second, members, found]
    if not members.isEmpty():
        third = stage(compare_in_full(members, texts, weights, similarity), "verified")
        used.append(third)
        if not third.isEmpty():
            found = components(found.select(F.col("id").alias("a"), F.col("class").alias("b")).unionByName(third))
            used.append(found)
    out = stage(spread(signed, reps, found), "classes")
    for done in used:
        drop_stage(done)
    return out


def spread(signed: DataFrame, reps: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, class_id, n_class of every signed document, from the classes ``found`` of representatives."""
    tied = reps.select("seq", "id", "n").join(found, "id", "left").select("seq", "n", F.coalesce("class", "id").alias("class_id"))
    # A class may hold a third of all texts: its size is sent to several salts, and only sizes over one are sent.
    size = tied.groupBy("class_id").agg(F.sum("n").alias("n_class")).where("n_class > 1")
    size = size.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(CLASS_SALTS - 1))))
    salted = tied.withColumn("salt", F.pmod(F.xxhash64("seq"), F.lit(CLASS_SALTS)).cast("int"))
    groups = salted.join(size, ["class_id", "salt"]).select("seq", "class_id", "n_class")
    # A sequence may be that of a third of all documents: a join right below the write is one that Spark splits where it is uneven.
    worded = signed.where("seq IS NOT NULL").select("doc_id", "seq").join(groups, "seq", "left")
    worded = worded.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_class", F.lit(1).cast("long")).alias("n_class"))
    return worded.unionByName(signed.where("seq IS NULL").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("n_class")))


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
