"""The corpus pipeline: toxicity, line dedup, near dedup, decontamination, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read as the next one's docs. All but the last return the columns of documents; n_chars is
that of the text as it then is. Other columns of docs, whatever their names, pass through the filtering stages with their values; packing
leaves them out. Empty tables give empty tables of the same columns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltweave.llm import decontam, line_dedup, minhash, packing, toxicity
from voltweave.llm.common import drop_stage, quoted, stage, table

#: What the stages read or change; all other columns are set aside meanwhile.
OWN = ("doc_id", "text", "n_chars")


def aside(docs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` on ``docs``, whose columns beside OWN have private names in it: no result's name can clash with them."""
    private = {x: f"__own_{i}" for i, x in enumerate(docs.columns) if x not in OWN}
    out = work(docs.select(*(quoted(x).alias(private.get(x, x)) for x in docs.columns)))
    return out.select(*(quoted(private.get(x, x)).alias(x) for x in docs.columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold; the lexicon is learned as op5_toxicity learns it, on these documents' labels.

    Null and empty texts are below it. Repeated rows are each scored.
    """
    labels = table(spark, sf_dir, "labels")
    model = toxicity.learn(docs.select("doc_id", "text"), labels, lambda c: toxicity.crc_mod(3)(c) != 1)
    return aside(docs, lambda d: toxicity.score_toxicity(d, model).where(F.col("score") < toxicity.THRESHOLD))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated lines; a text that keeps none is empty and stays; a null text stays null."""

    def work(d: DataFrame) -> DataFrame:
        kept = line_dedup.dedup_lines(d.withColumn("__null", F.col("text").isNull()))
        kept = kept.withColumn("text", F.when(~F.col("__null"), F.col("text")))
        return kept.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.lit(0).cast("long")))

    return aside(docs, work)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document of the smallest doc_id, in one row.

    Rows that repeat a doc_id are one document: the row whose text has the least hash stays (of wholly repeated rows any one). Rows
    without doc_id are documents known by a hash of their text, and give way to those with one. Documents without words are
    like nothing and stay.
    """
    known = 1 << 62
    unnamed = F.xxhash64("text").bitwiseAND(F.lit(known - 1)) + F.lit(known)
    keyed = docs.withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), unnamed))
    classes = minhash.near_duplicates(keyed.select(F.col("__id").alias("doc_id"), "text"))
    gone = classes.where(F.col("doc_id") != F.col("class_id")).select(F.col("doc_id").alias("__id"))
    # Ids that several rows have are rare; only their rows are compared with each other.
    repeated = keyed.groupBy("__id").agg(F.count("*").alias("n")).where("n > 1").select("__id")
    repeated = stage(repeated.join(gone, "__id", "left_anti"), "repeated")
    columns = [quoted(x) for x in docs.columns]
    if repeated.isEmpty():
        drop_stage(repeated)
        return minhash.beside(keyed, gone, "__id").select(*columns)
    single = minhash.beside(keyed, gone.unionByName(repeated), "__id").select(*columns)
    row = F.struct(*(quoted(x).alias(f"c{i}") for i, x in enumerate(docs.columns)))
    one = minhash.among(keyed, repeated, "__id").groupBy("__id").agg(F.min_by(row, F.xxhash64("text")).alias("row"))
    return single.unionByName(one.select(*(F.col(f"row.c{i}").alias(x) for i, x in enumerate(docs.columns))))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated, less the spans that benchmark items' windows hit. Texts without words are clean."""

    def work(d: DataFrame) -> DataFrame:
        marked = decontam.decontaminate(d, table(spark, sf_dir, "benchmark")).where(~F.col("contaminated"))
        text = F.when(F.col("n_hit") > 0, F.col("clean_text")).otherwise(F.col("text"))
        n_chars = F.when(F.col("n_hit") > 0, F.length("clean_text").cast("long")).otherwise(F.col("n_chars"))
        return marked.withColumn("n_chars", n_chars).withColumn("text", text)

    return aside(docs, work)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in sequences, as op10_packing gives them. A null or empty text is its end id alone; repeated rows are packed each."""
    return packing.pack(docs, public_tokenizers.path(packing.TOKENIZER), public_tokenizers.path(packing.RANKS))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again; a stage's table is deleted when the next one's is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            drop_stage(before)
        before = docs
    return docs


#: Learned lexicons, similarity classes and tokens are beyond SQL; tests hold each stage against a brute-force version of its rule.
ORACLE_SQL = None
