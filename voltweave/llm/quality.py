"""Quality classifier: a regularised quadratic discriminant (operator 2).

Each whole text gives a vector of transformed statistics (character classes, words, repetition,
lines, compressibility). From the labelled rows each class's sums, cross products and counts are
added up in one aggregation, over all rows. The class covariances are shrunk towards the
pooled one and towards its diagonal; the amount is the one, of a fixed grid, with the least loss on a fold of
the learned rows. The score is a logistic function of the difference of log densities, from Mahalanobis
distances with Cholesky factors that are made once.

Edge cases: null and empty texts have the statistics of a text of no characters; without labels of
both classes every score is the prior's (one half); repeated rows are each scored; other columns pass through, but for
stats and score, which the results replace. An id labelled twice has the larger label; a row without doc_id is never learned from and counts as not held out.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_TABLE, as_bytes, quoted, schema_of, ship, slices, stage, table, with_plain_names, without

THRESHOLD = 0.7
NAMES = (
    "size", "upper", "digit", "symbol", "exclaim", "bar", "stop", "space", "beyond_ascii", "word_length", "variety",
    "top_word", "repeated_pair", "lines", "line_length", "repeated_line", "compressed", "marked_words", "long_words", "sentence",
)
#: At most so many labelled rows tune the amount of shrinkage and the logistic scale.
TUNING_ROWS = 4000
SHRINK = (0.05, 0.15, 0.3, 0.5, 0.8)

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STOP = np.zeros(256, bool)
_STOP[[33, 44, 46, 58, 59, 63]] = True
_SYMBOL = ~(_LETTER | _DIGIT | _SPACE | _STOP)
_SYMBOL[[34, 39, 40, 41, 45]] = False


def logit(share: float) -> float:
    """A share on an unbounded scale, finite at 0 and 1."""
    return float(np.log((share + 0.002) / (1.002 - share)))


def statistics(text: bytes) -> list[float]:
    n = len(text)
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    one = max(n, 1)
    letters = max(int(seen[_LETTER].sum()), 1)
    words = text.translate(WORD_TABLE).split()
    raw = text.split()
    m, r = max(len(words), 1), max(len(raw), 1)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    pairs = sum(map(bytes.__eq__, words, words[1:]))
    lines = [x for x in text.split(b"\n") if x.strip()]
    k = max(len(lines), 1)
    marked = sum(not (w[-1:].isalnum() or w[-1] >= 128 or w[-1:] in b".,") for w in raw)
    sentences = int(seen[[33, 46, 63]].sum())
    # The window of the compressor bounds what it compares; longer texts are judged by the same kind of rate.
    packed = len(zlib.compress(text, 1)) / one
    return [
        float(np.log1p(n)),
        logit(int(seen[_UPPER].sum()) / letters),
        logit(int(seen[_DIGIT].sum()) / one),
        logit(int(seen[_SYMBOL].sum()) / one),
        logit(int(seen[33]) / one),
        logit(int(seen[124]) / one),
        logit(int(seen[_STOP].sum()) / one),
        logit(int(seen[_SPACE].sum()) / one),
        logit(int(seen[128:].sum()) / one),
        float(np.log1p(sum(map(len, words)) / m)),
        float(np.log((len(counts) + 1) / (m**0.75 + 1))),
        logit(max(counts.values(), default=0) / m),
        logit(pairs / m),
        float(np.log1p(k)),
        float(np.log1p(n / k)),
        logit(1 - len(set(lines)) / k) if lines else logit(0),
        float(np.log(packed + 0.05)),
        logit(marked / r),
        logit(sum(len(w) > 14 for w in words) / m),
        float(np.log1p(m / (sentences + 1))),
    ]


@with_plain_names
def measure(docs: DataFrame) -> DataFrame:
    """``docs`` without text, with the vector of statistics."""
    ship(docs.sparkSession)
    docs = without(docs, "stats")
    names = [x for x in docs.columns if x != "text"]

    def run(batches):
        for batch in slices(batches):
            x = np.array([statistics(t) for t in as_bytes(batch.column("text"))]).reshape(-1, len(NAMES))
            vectors = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, len(NAMES)), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), vectors], names=[*names, "stats"])

    return docs.mapInArrow(run, schema_of(docs, "stats array<double>", "text"))


@dataclass
class Discriminant:
    means: np.ndarray
    #: Inverse Cholesky factors of the class covariances, and the logarithms of their determinants.
    factors: np.ndarray
    logdets: np.ndarray
    slope: float = 1.0
    constant: float = 0.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0."""
        out = []
        for k in (0, 1):
            z = (x - self.means[k]) @ self.factors[k].T
            out.append(-0.5 * (z * z).sum(1) - 0.5 * self.logdets[k])
        return out[1] - out[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        # Densities of twenty statistics differ by thousands; a signed root keeps the order and the scale.
        d = squash(self.difference(x))
        return 1 / (1 + np.exp(-np.clip(self.slope * d + self.constant, -40, 40)))


def squash(d: np.ndarray) -> np.ndarray:
    return np.sign(d) * np.log1p(np.abs(d))


def shrunk(sums: dict[int, tuple[float, np.ndarray, np.ndarray]], amount: float) -> Discriminant:
    """A discriminant from each class's count, sum and cross products."""
    n_all = sum(s[0] for s in sums.values())
    means = np.stack([sums[k][1] / sums[k][0] for k in (0, 1)])
    within = {k: sums[k][2] / sums[k][0] - np.outer(means[k], means[k]) for k in (0, 1)}
    pooled = sum(within[k] * sums[k][0] for k in (0, 1)) / n_all
    scale = np.diag(np.maximum(np.diag(pooled), 1e-4))
    factors, logdets = [], []
    for k in (0, 1):
        s = (1 - amount) * within[k] + amount * (0.5 * pooled + 0.5 * scale) + 1e-3 * scale
        lower = np.linalg.cholesky(s)
        factors.append(np.linalg.inv(lower))
        logdets.append(2 * np.log(np.diag(lower)).sum())
    return Discriminant(means, np.stack(factors), np.array(logdets))


def add_up(rows: DataFrame) -> dict[tuple[int, int], tuple[float, np.ndarray, np.ndarray]]:
    """(class, fold) -> count, sum, cross products over all ``rows`` (y, fold, stats); one small row for each task and key."""
    width = len(NAMES)

    def part(frames):
        total: dict[tuple[int, int], np.ndarray] = {}
        for f in frames:
            if not len(f):
                continue
            x = np.stack(f.stats.to_numpy())
            for key, at in f.groupby(["y", "fold"]).indices.items():
                own = np.hstack([np.ones((len(at), 1)), x[at]])
                total[key] = total.get(key, 0) + own.T @ own
        yield pd.DataFrame([(int(y), int(fold), i, m.ravel()[i]) for (y, fold), m in total.items() for i in range(m.size)], columns=["y", "fold", "i", "v"])

    got = rows.mapInPandas(part, "y int, fold int, i int, v double").groupBy("y", "fold", "i").agg(F.sum("v").alias("v")).collect()
    out: dict[tuple[int, int], np.ndarray] = {}
    for r in got:
        out.setdefault((r.y, r.fold), np.zeros((width + 1) ** 2))[r.i] = r.v
    return {k: (m[0], m[1 : width + 1], m.reshape(width + 1, width + 1)[1:, 1:]) for k, m in out.items()}


def learn(measured: DataFrame, labels: DataFrame, use, tuning_rows: int = TUNING_ROWS) -> Discriminant | None:
    """A discriminant from the rows of ``labels`` that ``use`` selects by doc_id; None without both classes.

    Its sums are over all labelled rows; the amount of shrinkage and the logistic scale come from at most ``tuning_rows``.
    """
    y = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & use(F.col("doc_id")))
    y = y.groupBy("doc_id").agg(F.max("quality").cast("int").alias("y"))
    rows = measured.select("doc_id", "stats").join(y, "doc_id").withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(5)).cast("int")).select("y", "fold", "stats", "doc_id")
    sums = add_up(rows)

    def total(folds) -> dict[int, tuple]:
        return {k: tuple(sum(sums[k, f][i] for f in folds if (k, f) in sums) for i in range(3)) for k in (0, 1) if any((k, f) in sums for f in folds)}

    whole, most = total(range(5)), total(range(1, 5))
    if len(whole) < 2 or len(most) < 2 or min(s[0] for s in most.values()) < 3:
        return None
    # The fold that tunes the amount of shrinkage and the logistic scale: a bounded sample of it is enough for two numbers.
    tuning = rows.where(F.col("fold") == 0).orderBy(F.xxhash64("doc_id", F.lit(1)), "stats").limit(tuning_rows).select("y", "stats").toPandas()
    if tuning.y.nunique() < 2:
        return shrunk(whole, 0.3)
    x, t = np.stack(tuning.stats.to_numpy()), tuning.y.to_numpy()
    best = None
    for amount in SHRINK:
        model = shrunk(most, amount)
        slope, constant, loss = scale(squash(model.difference(x)), t)
        if best is None or loss < best[0] - 1e-6:
            best = (loss, amount, slope, constant)
    model = shrunk(whole, best[1])
    model.slope, model.constant = best[2], best[3]
    return model


def scale(d: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> tuple[float, float, float]:
    """Slope, constant and loss of a one-variable logistic regression with both classes weighted alike."""
    w = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    b = np.array([0.0, 1.0])
    x = np.stack([np.ones(len(d)), d], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        grad = x.T @ (w * (p - y)) + ridge * np.array([0, b[1] - 1])
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + np.diag([1e-6, ridge])
        b = b - np.clip(np.linalg.solve(hess, grad), -2, 2)
        b[1] = max(b[1], 0.05)
    p = np.clip(1 / (1 + np.exp(-np.clip(x @ b, -30, 30))), 1e-9, 1 - 1e-9)
    return float(b[1]), float(b[0]), float(-(w * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum())


@with_plain_names
def score_quality(measured: DataFrame, model: Discriminant | None) -> DataFrame:
    """``measured`` without its statistics, with score."""
    measured = without(measured, "score")
    names = [x for x in measured.columns if x != "stats"]

    def run(batches):
        for batch in batches:
            x = np.asarray(batch.column("stats").flatten()).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(model.score(x), pa.float64())], names=[*names, "score"])

    if model is None:
        return measured.select(*map(quoted, names), F.lit(0.5).alias("score"))
    return measured.mapInArrow(run, schema_of(measured, "score double", "stats"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    measured = stage(measure(table(spark, sf_dir, "documents").select("doc_id", "text")), "quality-stats")
    model = learn(measured, table(spark, sf_dir, "labels"), lambda c: remainder != 2)
    return score_quality(measured, model).select("doc_id", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
