"""Line deduplication by a sharded minimal perfect hash (operator 9).

1. Each task hashes the long line keys of its documents to 128 bits and counts the documents
   that hold them; Spark adds the counts up and keeps the keys of at least ``min_docs`` documents.
2. These distinct hashes are dealt to shards of bounded size by their hash. Each shard gets a
   minimal perfect hash (levels of bit arrays with rank counts) and three arrays at its
   positions: a 64-bit fingerprint, the count, and the document that keeps the line.
3. Documents probe the arrays. Up to ``broadcast_bytes`` the shards are broadcast and documents
   are never shuffled; beyond that, hashes travel to their shard (salted by document) and only
   the numbers of dropped lines travel back.

Edge cases: a null or empty text is one empty line; null doc_id counts as a document and sorts
below every other; repeated doc_id rows are one document for counting, and each row is
returned; columns other than doc_id and text are passed through by :func:`dedup_lines`, but for n_lines and n_dropped,
which the results replace.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, code_points, drop_stage, mix64, schema_of, ship, slices, stage, table, with_plain_names, without

MIN_CHARS, MIN_DOCS = 40, 5
SHARD_KEYS = 200_000
BROADCAST_BYTES = 48 << 20
STRIP = b" \t\n\x0b\x0c\r"
NULL_ID = -(1 << 63)


def line_key(line: bytes) -> bytes:
    return line.strip(STRIP).lower()


def long_keys(text: bytes, min_chars: int) -> Iterator[tuple[int, bytes]]:
    """(line number, 128-bit key hash) of the lines whose key has at least ``min_chars`` code points."""
    for i, line in enumerate(text.split(b"\n")):
        if len(line) >= min_chars:
            key = line_key(line)
            if len(key) >= min_chars and code_points(key) >= min_chars:
                yield i, xxhash.xxh3_128_digest(key)


class ShardIndex:
    """A minimal perfect hash over distinct 128-bit hashes, with arrays at its positions."""

    GAMMA, LEVELS = 2.0, 40

    def __init__(self, h1: np.ndarray, h2: np.ndarray, count: np.ndarray, keep: np.ndarray):
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        left, base = self._key(h1, h2), 0
        for level in range(self.LEVELS):
            if not len(left):
                break
            size = max(64, int(self.GAMMA * len(left)))
            at = self._at(left, level, size)
            alone = np.bincount(at, minlength=size) == 1
            bits = np.zeros(-(-size // 64) * 64, np.uint8)
            bits[:size] = alone
            blocks = np.packbits(bits, bitorder="little").view(np.uint64)
            ones = np.bitwise_count(blocks).astype(np.int64)
            rank = base + np.cumsum(ones) - ones
            self.levels.append((size, blocks, rank))
            base += int(ones.sum())
            left = left[~alone[at]]
        self.rest = {int(k): base + i for i, k in enumerate(left)}  # equal 64-bit keys, all but impossible
        n = base + len(left)
        at = self.position(h1, h2)
        if len(left):
            at[at < 0] = [self.rest[int(k)] for k in self._key(h1, h2)[at < 0]]
        self.fingerprint, self.count, self.keep = np.zeros(n, np.uint64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.fingerprint[at], self.count[at], self.keep[at] = h2, count, keep

    @staticmethod
    def _key(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        return mix64(h1 + np.uint64(0x9E3779B97F4A7C15) * h2)

    @staticmethod
    def _at(key: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix64(key + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))) % np.uint64(size)).astype(np.int64)

    def position(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        key, out = self._key(h1, h2), np.full(len(h1), -1, np.int64)
        todo = np.arange(len(h1))
        for level, (size, blocks, rank) in enumerate(self.levels):
            if not len(todo):
                break
            at = self._at(key[todo], level, size)
            block, bit = blocks[at >> 6], (at & 63).astype(np.uint64)
            hit = (block >> bit) & np.uint64(1) == 1
            below = block & ((np.uint64(1) << bit) - np.uint64(1))
            out[todo[hit]] = (rank[at >> 6] + np.bitwise_count(below))[hit]
            todo = todo[~hit]
        for i in todo if self.rest else ():
            out[i] = self.rest.get(int(key[i]), -1)
        return out

    def probe(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(in how many documents, which document keeps it) of each hash; 0 documents if not indexed."""
        n = np.zeros(len(h1), np.int64)
        keep = np.zeros(len(h1), np.int64)
        if len(self.fingerprint):
            at = self.position(h1, h2)
            own = (at >= 0) & (self.fingerprint[at] == h2)
            n[own], keep[own] = self.count[at[own]], self.keep[at[own]]
        return n, keep


def split_hash(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
    return pairs[:, 0].copy(), pairs[:, 1].copy()


def count_keys(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """h1, h2, n_docs, keep: the line keys found in at least ``min_docs`` documents."""

    def hashes(batches):
        for batch in slices(batches):
            seen: dict[tuple[bytes, int], None] = {}
            for doc, text in zip(batch.column("doc_id").to_pylist(), as_bytes(batch.column("text")), strict=True):
                doc = NULL_ID if doc is None else doc
                seen.update(dict.fromkeys((h, doc) for _, h in long_keys(text, min_chars)))
            h1, h2 = split_hash([h for h, _ in seen])
            yield pa.RecordBatch.from_arrays(
                [pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array([d for _, d in seen], pa.int64())], names=["h1", "h2", "doc"]
            )

    rows = docs.select("doc_id", "text").mapInArrow(hashes, "h1 long, h2 long, doc long")
    # Two steps count a document once however many rows hold it; both combine before they shuffle.
    per_doc = rows.groupBy("h1", "h2", "doc").agg(F.count("*").alias("rows"))
    counted = per_doc.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc").alias("keep"))
    return counted.where(F.col("n_docs") >= min_docs)


def build_shards(keys: DataFrame, n_shards: int) -> DataFrame:
    """One row for each shard: its number, and its pickled index."""

    def build(key, pdf):
        import pandas as pd

        index = ShardIndex(pdf.h1.to_numpy().view(np.uint64), pdf.h2.to_numpy().view(np.uint64), pdf.n_docs.to_numpy(), pdf.keep.to_numpy())
        return pd.DataFrame({"shard": [key[0]], "index": [pickle.dumps(index, 5)]})

    return keys.groupBy(F.pmod("h1", F.lit(n_shards)).alias("shard")).applyInPandas(build, "shard long, index binary")


def probe_shards(shards: dict[int, ShardIndex], n_shards: int, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n, keep = np.zeros(len(h1), np.int64), np.zeros(len(h1), np.int64)
    number = h1.view(np.int64) % n_shards
    for s, index in shards.items():
        own = np.flatnonzero(number == s)
        if len(own):
            n[own], keep[own] = index.probe(h1[own], h2[own])
    return n, keep


def kept_lines(text: bytes, dropped: set[int]) -> tuple[bytes, int]:
    lines = text.split(b"\n")
    return (b"\n".join(x for i, x in enumerate(lines) if i not in dropped) if dropped else text), len(lines)


def _rewrite(batch: pa.RecordBatch, drops: list[set[int]]) -> pa.RecordBatch:
    kept, n_lines = [], []
    for text, dropped in zip(as_bytes(batch.column("text")), drops, strict=True):
        k, n = kept_lines(text, dropped)
        kept.append(k)
        n_lines.append(n)
    names = [x for x in batch.schema.names if x not in ("text", "__drop")]
    return pa.RecordBatch.from_arrays(
        [*(batch.column(x) for x in names), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(map(len, drops), pa.int64())],
        names=[*names, "text", "n_lines", "n_dropped"],
    )


RESULTS = "text string, n_lines long, n_dropped long"


def _probe_broadcast(docs: DataFrame, shards: DataFrame, n_shards: int, min_chars: int) -> DataFrame:
    index = docs.sparkSession.sparkContext.broadcast({r["shard"]: bytes(r["index"]) for r in shards.collect()})

    def probe(batches):
        mine = {s: pickle.loads(x) for s, x in index.value.items()}
        for batch in slices(batches):
            owner, line, digest = [], [], []
            for d, text in enumerate(as_bytes(batch.column("text"))):
                for i, h in long_keys(text, min_chars):
                    owner.append(d)
                    line.append(i)
                    digest.append(h)
            h1, h2 = split_hash(digest)
            n, keep = probe_shards(mine, n_shards, h1, h2)
            ids = np.array([NULL_ID if x is None else x for x in batch.column("doc_id").to_pylist()], np.int64)
            drops: list[set[int]] = [set() for _ in range(batch.num_rows)]
            for j in np.flatnonzero((n > 0) & (keep != ids[np.array(owner, np.int64)])) if owner else ():
                drops[owner[j]].add(line[j])
            yield _rewrite(batch, drops)

    return docs.mapInArrow(probe, schema_of(docs, RESULTS, "text"))


def _probe_routed(docs: DataFrame, shards: DataFrame, n_shards: int, n_salts: int, min_chars: int) -> DataFrame:
    """As :func:`_probe_broadcast` for an index of any size: a task holds one shard at a time.

    A row is known by its doc_id and a hash of its text: rows that repeat a doc_id are decided each for itself.
    """
    docs = docs.withColumn("__text", F.xxhash64("text"))

    def hashes(batches):
        for batch in slices(batches):
            rows, ids, marks = [], batch.column("doc_id").to_pylist(), batch.column("__text").to_pylist()
            for d, x, t in zip(ids, marks, as_bytes(batch.column("text")), strict=True):
                rows += [(d, x, i, h) for i, h in long_keys(t, min_chars)]
            h1, h2 = split_hash([h for *_, h in rows])
            own = [pa.array([r[j] for r in rows], pa.int64()) for j in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(h1.view(np.int64) % n_shards), *own, pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))], names=["shard", "doc_id", "__text", "line", "h1", "h2"])

    probes = docs.select("doc_id", "text", "__text").mapInArrow(hashes, "shard long, doc_id long, __text long, line long, h1 long, h2 long")
    probes = probes.withColumn("salt", F.pmod(F.xxhash64("doc_id", "__text"), F.lit(n_salts))).withColumn("index", F.lit(None).cast("binary"))
    copies = shards.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_salts - 1).cast("long"))))
    copies = copies.select("shard", *(F.lit(None).cast("long").alias(x) for x in ("doc_id", "__text", "line", "h1", "h2")), "salt", "index")
    dealt = probes.unionByName(copies).repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.col("index").isNull())

    def look_up(batches):
        index, number = None, None
        for batch in batches:
            shard, blob = batch.column("shard").to_numpy(), batch.column("index")
            cuts = [0, *(np.flatnonzero(~np.asarray(blob.is_null())).tolist()), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if part.column("index")[0].is_valid:
                    index, number = pickle.loads(part.column("index")[0].as_py()), shard[a]
                    part = part.slice(1)
                part = part.filter(pc.equal(part.column("shard"), -1 if number is None else int(number)))
                if index is None or not part.num_rows:
                    continue
                h1, h2 = (part.column(x).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for x in ("h1", "h2"))
                n, keep = index.probe(h1, h2)
                doc = part.column("doc_id").fill_null(NULL_ID).to_numpy(zero_copy_only=False)
                hit = part.filter(pa.array((n > 0) & (keep != doc)))
                yield pa.RecordBatch.from_arrays([hit.column(x) for x in ("doc_id", "__text", "line")], names=["doc_id", "__text", "line"])

    hits = dealt.mapInArrow(look_up, "doc_id long, __text long, line long").groupBy("doc_id", "__text").agg(F.collect_set("line").alias("__drop"))
    hits = hits.withColumnsRenamed({"doc_id": "__id", "__text": "__of"})
    joined = docs.join(hits, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__of")), "left").drop("__id", "__of", "__text")

    def rewrite(batches):
        for batch in slices(batches):
            yield _rewrite(batch, [set(x or ()) for x in batch.column("__drop").to_pylist()])

    return joined.mapInArrow(rewrite, schema_of(joined.drop("__drop"), RESULTS, "text"))


@with_plain_names
def dedup_lines(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    shard_keys: int = SHARD_KEYS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text`` (put last), and with n_lines and n_dropped."""
    ship(docs.sparkSession)
    docs = without(docs, "n_lines", "n_dropped")
    keys = stage(count_keys(docs, min_chars, min_docs), "line-keys")
    n_keys = keys.count()
    n_shards = max(1, -(-n_keys // shard_keys))
    shards = stage(build_shards(keys, n_shards), "line-shards")
    size = shards.agg(F.coalesce(F.sum(F.length("index")), F.lit(0))).first()[0]
    drop_stage(keys)
    if size <= broadcast_bytes:
        out = _probe_broadcast(docs, shards, n_shards, min_chars)
        drop_stage(shards)
        return out
    n_salts = max(1, docs.rdd.getNumPartitions() // n_shards)
    return _probe_routed(docs, shards, n_shards, n_salts, min_chars)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    # sha2 is of the UTF-8 bytes and stays in the JVM.
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE = f"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS k FROM lines
), often AS (
  SELECT k, max(doc_id) AS keep FROM keyed WHERE length(k) >= {MIN_CHARS} GROUP BY k HAVING count(DISTINCT doc_id) >= {MIN_DOCS}
), marked AS (
  SELECT doc_id, i, line, o.k IS NOT NULL AND keyed.doc_id <> o.keep AS gone FROM keyed LEFT JOIN often o ON keyed.k = o.k
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
