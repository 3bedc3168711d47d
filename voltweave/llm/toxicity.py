"""Toxicity by a weighted lexicon (operator 5).

Matching: the text is folded (case, accents, homoglyphs of other scripts, full-width forms, digits
and signs that stand for letters), an Aho-Corasick automaton finds the lexicon's entries, and a
match counts where it is a whole word that no exception phrase covers. The score is a logistic
function of the weighted hits, their weight for each hundred words, and a constant.

Entries are whole words or stems (any word that begins with the stem), as labels show them.
Learning: a bounded sample of labelled rows (``SAMPLE`` of each class, in the order of a hash of
their id; of rows that repeat an id the one whose text has the least hash; near copies are reduced to one) gives for each stem and
word how many rows of either class hold it. Entries are chosen one at a time: the one that explains most toxic rows that no chosen
entry explains yet, less the clean rows it would mark, so that words which only stand beside insults do
not enter. Seed words that no clean row holds enter with a prior weight. Exception phrases are a parameter. The
coefficients are fitted on the rows as they are scored: by the automaton over whole texts, exception phrases included.

Edge cases: null and empty texts have no hits and get the constant's score; without usable
labels the seed lexicon and default coefficients are used; repeated rows are each scored; an id labelled twice has the larger
label; a row without doc_id is never learned from and counts as not held out. Other columns pass through, but for score and
toxic_weight, which the results replace.
"""

from __future__ import annotations

import math
import sys
import unicodedata
import zlib
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_stage, schema_of, ship, slices, stage, table, with_plain_names, without

THRESHOLD = 0.7
#: At most so many labelled rows of each class are learned from.
SAMPLE = 1500
#: The lexicon has at most so many chosen entries, best first.
ENTRIES = 200
#: Insults that count even where the labels are too few to learn them, with the weight of a learned entry.
SEED = (
    "asshole", "bastard", "bitch", "clown", "cretin", "disgusting", "dumbass", "filth", "idiot", "imbecile", "loser",
    "moron", "pathetic", "scum", "stupid", "trash", "vermin", "worthless",
)
SEED_WEIGHT = 4.0
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "class clown", "sore loser", "circus clown", "trash bag", "trash collection")

#: Letters of other scripts that look like Latin ones, and what they stand for.
LOOKALIKE_FROM = "аеорсухіјѕԁһԛԝьвкмнтгαερορτυχικνωηϲ"
LOOKALIKE_TO = "aeopcyxijsdhqwbbkmhtraepoptuxiknwhc"
#: Digits and signs used for letters; they are folded only inside words that have a letter.
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i"}


def _folded(c: str) -> str:
    c = unicodedata.normalize("NFKD", c.casefold())
    c = "".join(x for x in c if not unicodedata.combining(x))
    return "".join(LOOKALIKES.get(x, x) for x in c)


LOOKALIKES = dict(zip(LOOKALIKE_FROM, LOOKALIKE_TO, strict=True))
INVISIBLE = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])


class _Fold(dict):
    """Translation table that is filled as characters appear; its size is bounded by Unicode."""

    def __missing__(self, c: int):
        s = _folded(chr(c))
        self[c] = s
        return s


FOLD = _Fold(INVISIBLE)


def fold(text: str) -> str:
    """Case, accents and look-alike letters folded; invisible characters dropped."""
    return text.lower() if text.isascii() else text.translate(FOLD)


def _lettered(word: str) -> str:
    return "".join(SIGNS.get(c, c) for c in word)


def tokens(text: str) -> list[str]:
    """Folded words: letters, and signs that stand for letters in it; signs at its end, and ! and | at its start, are dropped."""
    out = []
    for raw in text.translate(BREAKS).split():
        if raw.isalpha():
            out.append(raw)
            continue
        word = raw.strip("!|").rstrip("!|$@")
        if any(c.isalpha() for c in word):
            out.append(word if word.isalpha() else _lettered(word))
    return out


#: Everything between ASCII letters, digits and the signs above breaks words.
BREAKS = {i: " " for i in range(128) if not chr(i).isalnum() and chr(i) not in SIGNS}
BREAKS |= {i: " " for i in range(0x2010, 0x2060)} | {0xA0: " ", 0xAB: " ", 0xBB: " ", 0xBF: " ", 0xA1: " "}


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=lambda: dict.fromkeys((f"{w}$" for w in SEED), SEED_WEIGHT))
    exceptions: tuple[str, ...] = EXCEPTIONS
    #: Constant, for the logarithm of the weighted hits, for that of their weight for each hundred words.
    coefficients: tuple[float, float, float] = (-3.5, 2.2, 0.8)

    def automaton(self) -> ahocorasick.Automaton:
        a = ahocorasick.Automaton()
        for w, x in self.weights.items():  # "word$" is a whole word, "stem" begins one
            entry = f" {w[:-1]} " if w.endswith("$") else f" {w}"
            a.add_word(entry, (len(entry), x))
        for p in self.exceptions:
            a.add_word(f" {p} ", (len(p) + 2, None))
        if len(a):
            a.make_automaton()
        return a

    def score(self, weight: float, n_words: int) -> float:
        a, b, c = self.coefficients
        z = a + b * math.log1p(weight) + c * math.log1p(100 * weight / max(n_words, 1))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def hits(automaton: ahocorasick.Automaton, words: list[str]) -> float:
    """The summed weight of entries that no exception phrase covers."""
    if not len(automaton) or not words:
        return 0.0
    found, covered = [], []
    for end, (n, weight) in automaton.iter(" " + " ".join(words) + " "):
        (covered if weight is None else found).append((end - n + 1, end, weight))
    if covered:
        found = [x for x in found if not any(a <= x[0] and x[1] <= b for a, b, _ in covered)]
    return sum(w for *_, w in found)


def crc_mod(n: int) -> Callable:
    """crc32(doc_id as text) mod n as a column."""
    return lambda c: F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(n))


def training(docs: DataFrame, labels: DataFrame, label: str, use) -> DataFrame:
    """The bounded, deterministic sample: doc_id, text and label (y) of ``SAMPLE`` rows of each class."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & use(F.col("doc_id"))).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    chosen = None
    for y in (0, 1):
        part = rows.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
        chosen = part if chosen is None else chosen.unionByName(part)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def learn(docs: DataFrame, labels: DataFrame, use, exceptions: tuple[str, ...] = EXCEPTIONS) -> Model:
    """A model from the rows of ``labels`` that ``use`` selects by doc_id."""
    ship(docs.sparkSession)

    def reduce(batches):
        for batch in slices(batches):
            n, bag, same = [], [], []
            for text in batch.column("text").to_pylist():
                ws = tokens(fold(text or ""))
                n.append(len(ws))
                counts = Counter(ws)
                bag.append(" ".join(counts))
                raw = [w.encode("utf-8", "replace") for w in counts]
                same.append("-".join(str(min((zlib.crc32(w, k) for w in raw), default=0)) for k in (1, 2, 3)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(n, pa.int64()), pa.array(bag), pa.array(same)], names=["doc_id", "y", "n", "bag", "same"])

    sample = stage(training(docs.withColumn("doc_id", F.col("doc_id").cast("long")), labels, "toxic", use), "toxic-sample")
    rows = []
    seen = set()
    for r in sample.mapInArrow(reduce, "doc_id long, y int, n long, bag string, same string").orderBy("doc_id").toLocalIterator():
        if (r.y, r.same) not in seen:  # copies count once
            seen.add((r.y, r.same))
            rows.append((r.doc_id, r.y, r.n, {sys.intern(w) for w in r.bag.split()}))
    toxic, clean = ([bag for _, y, _, bag in rows if y == k] for k in (1, 0))
    if len(toxic) < 5 or len(clean) < 5:
        drop_stage(sample)
        return Model(exceptions=exceptions)
    weights = choose(toxic, clean)
    known = {w.rstrip("$") for w in weights}
    words_held = {w for bag in clean for w in bag}
    model = Model(weights | {f"{w}$": SEED_WEIGHT for w in SEED if w not in words_held and not any(w.startswith(k) for k in known)}, exceptions)
    once = {d for d, *_ in rows}
    scored = [(r.y, r.n, r.toxic_weight) for r in weighed(sample, model).select("doc_id", "y", "n", "toxic_weight").collect() if r.doc_id in once]
    drop_stage(sample)
    model.coefficients = calibrate(scored)
    return model


def weighed(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without text, with n (words) and toxic_weight (the summed weight of the entries found)."""
    names = [x for x in docs.columns if x != "text"]

    def run(batches):
        automaton = model.automaton()
        for batch in slices(batches):
            found = [tokens(fold(text or "")) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in names), pa.array(map(len, found), pa.int64()), pa.array([hits(automaton, ws) for ws in found], pa.float64())], names=[*names, "n", "toxic_weight"]
            )

    return docs.mapInArrow(run, schema_of(docs, "n long, toxic_weight double", "text"))


def features(bag: set[str]) -> set[str]:
    """Stems of 3 to 8 letters, and whole words (marked by $)."""
    return {sys.intern(w[:k]) for w in bag for k in range(3, min(len(w), 8) + 1)} | {f"{w}$" for w in bag if len(w) > 2}


def choose(toxic: list[set[str]], clean: list[set[str]], most: int = ENTRIES) -> dict[str, float]:
    """Entries and weights, each the best explanation of toxic rows that are not explained yet."""
    t, c = len(toxic), len(clean)
    # With few rows, chance alone puts many words into two or three of them and into no clean one.
    least = max(4, t // 60)
    own = [features(bag) for bag in toxic]
    everywhere = Counter(f for fs in own for f in fs)
    seeds = {f"{w}$" for w in SEED}
    allowed = {f for f, n in everywhere.items() if n >= least or f in seeds}
    held = Counter(f for bag in clean for f in features(bag) & allowed)

    def weight(f: str) -> float:
        return math.log((everywhere[f] + 0.5) / (t + 1)) - math.log((held[f] + 0.5) / (c + 1))

    def overlaps(f: str) -> bool:
        return any(f.startswith(k.rstrip("$")) or k.startswith(f.rstrip("$")) for k in weights)

    allowed = {f for f in allowed if weight(f) >= 2}
    weights: dict[str, float] = {}
    left = [fs & allowed for fs in own]
    while left and len(weights) < most:
        gain = Counter(f for fs in left for f in fs)
        worth = {f: n - 3 * held[f] * t / c for f, n in gain.items() if not overlaps(f)}
        best = max(worth, key=lambda f: (worth[f], len(f), f), default=None)
        if best is None or worth[best] < (1 if best in seeds else least):
            break
        weights[best] = round(weight(best), 4)
        left = [fs for fs in left if best not in fs]
    # Entries that never stand alone explain no row by themselves: they are as frequent and as clean as those chosen.
    for f in sorted(allowed, key=lambda f: (-everywhere[f], -len(f), f)):
        if (everywhere[f] >= max(2 * least, 0.03 * t) and held[f] <= 0.002 * c or f in seeds) and weight(f) >= 3 and not overlaps(f):
            weights[f] = round(weight(f), 4)
    return weights


def calibrate(rows: list[tuple[int, int, float]], rounds: int = 60) -> tuple[float, float, float]:
    """Coefficients of a ridge-penalised logistic regression on (label, words, weight), both classes weighted alike, kept non-negative."""
    n_of = Counter(y for y, *_ in rows)
    x = [(1.0, math.log1p(w), math.log1p(100 * w / max(n, 1))) for _, n, w in rows]
    y, s = [y for y, *_ in rows], [1 / n_of[y] for y, *_ in rows]
    x, y, s = np.array(x), np.array(y, float), np.array(s) * len(y) / 2
    start = b = np.array(Model().coefficients)
    penalty = np.diag([0.01, 1.0, 1.0]) * len(y) * 0.002
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        grad = x.T @ (s * (p - y)) + penalty @ (b - start)
        hess = (x * (s * p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(hess, grad)
        b = b - np.clip(step, -1, 1)
        b[1:] = np.maximum(b[1:], 0.05)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in b)


@with_plain_names
def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with score (0 to 1) and toxic_weight (the summed weight of the entries found)."""
    ship(docs.sparkSession)
    docs = without(docs, "score", "toxic_weight")
    names = docs.columns

    def run(batches):
        automaton = model.automaton()
        for batch in slices(batches):
            scores, weights = [], []
            for text in batch.column("text").to_pylist():
                ws = tokens(fold(text or ""))
                weights.append(hits(automaton, ws))
                scores.append(model.score(weights[-1], len(ws)))
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(scores), pa.array(weights, pa.float64())], names=[*names, "score", "toxic_weight"])

    return docs.mapInArrow(run, schema_of(docs, "score double, toxic_weight double"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = learn(docs, labels, lambda c: crc_mod(3)(c) != 1)
    return score_toxicity(docs, model).select(
        "doc_id", F.coalesce(crc_mod(3)(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
