"""The corpus pipeline: each stage against a brute-force version of its rule, planted documents, and a given table."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tests.llm.test_classifiers import naive
from tests.llm.test_lines_and_contamination import LOWER, WORD, contamination, kept_lines
from tests.llm.test_minhash import whole_classes
from tests.llm.test_tokens import check_pack
from voltweave.llm import common, minhash, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_stages_keep_clean_documents_and_catch_planted_ones(spark, make_docs):
    rng = random.Random(9)
    text = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 7))) for _ in range(n))
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").limit(2).collect()]
    clean = [text(120) for _ in range(20)]
    line = text(60)
    texts = clean + ["You idiot, worthless scum, moron " + text(40)] + [text(50) + "\n" + line for _ in range(6)] + [clean[0], clean[1] + " end"] + [bench[0] + " " + text(20)] + ["", None]
    docs = make_docs(texts)
    columns = docs.columns
    one = P.drop_toxic(spark, docs, SF)
    assert one.columns == columns and {r.doc_id for r in one.collect()} == set(range(len(texts))) - {20}
    two = P.drop_repeated_lines(spark, one, SF)
    got = {r.doc_id: r for r in two.collect()}
    assert two.columns == columns and [line in got[i].text for i in range(21, 27)] == [False] * 5 + [True]
    assert all(r.n_chars == len(r.text or "") for r in got.values()) and got[len(texts) - 1].text is None
    three = P.drop_near_duplicates(spark, two, SF)
    assert three.columns == columns and {r.doc_id for r in three.collect()} == set(got) - {27, 28}
    four = P.drop_contaminated(spark, three, SF)
    assert four.columns == columns and {r.doc_id for r in four.collect()} == set(got) - {27, 28, 29}


def test_toxicity_stage_against_a_naive_matcher(spark, table):
    model = toxicity.learn(table.select("doc_id", "text"), spark.read.parquet(f"{SF}/labels.parquet"), lambda c: toxicity.crc_mod(3)(c) != 1)
    want = set()
    for r in table.collect():
        words = toxicity.tokens(toxicity.fold(r.text or ""))
        if model.score(naive(model, words), len(words)) < toxicity.THRESHOLD:
            want.add(r.doc_id)
    assert {r.doc_id for r in P.drop_toxic(spark, table, SF).collect()} == want and 0 < len(want) < table.count()


def test_line_stage_against_brute_force(spark, table):
    want = {d: t for d, _, _, t in kept_lines([(r.doc_id, r.text) for r in table.collect()])}
    got = P.drop_repeated_lines(spark, table, SF).collect()
    assert {r.doc_id: r.text or "" for r in got} == want and all(r.n_chars == len(r.text or "") for r in got)


def test_near_stage_against_all_pairs(spark, table):
    rows = sorted(table.collect(), key=lambda r: r.doc_id)
    want, _ = whole_classes([r.text or "" for r in rows], minhash.weights_of(*minhash.sketch(table)))
    kept = {rows[i].doc_id for i, c in enumerate(want) if c == i}
    assert {r.doc_id for r in P.drop_near_duplicates(spark, table, SF).collect()} == kept and len(kept) < len(rows)


def test_contamination_stage_against_brute_force(spark, table):
    rows = table.collect()
    marks = contamination([(r.doc_id, r.text) for r in rows], [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()])
    got = {r.doc_id: r for r in P.drop_contaminated(spark, table, SF).collect()}
    assert set(got) == {d for d, m in marks.items() if not m[-1]} and len(got) < len(rows)
    for r in rows:
        if r.doc_id in got:
            assert len(WORD.findall((got[r.doc_id].text or "").translate(LOWER))) == marks[r.doc_id][0] - marks[r.doc_id][1]


def test_packing_stage_against_the_library(spark, table):
    check_pack(P.pack(spark, table, SF).collect(), {r.doc_id: r.text for r in table.collect()})


CLASHES = ("score", "toxic_weight", "n_lines", "n_dropped", "n_words", "n_hit", "n_items", "items", "contaminated", "clean_text", "class_id", "seq", "id", "key", "h", "Text2", "sequence_id", "a.b", "__null")


def test_columns_of_any_name_pass_through_with_their_values(spark, make_docs):
    docs = make_docs(["a b c d e f " * 9, "a b c d e f " * 9, "other words stand here now", None, ""])
    docs = docs.select("*", *(F.concat(F.lit(x), F.col("doc_id").cast("string")).alias(x) for x in CLASHES))
    for name, function in P.STAGES[:-1]:
        out = function(spark, docs, SF)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert len(rows) == (4 if name == "near_dedup" else 5)
        assert all(r[x] == f"{x}{r.doc_id}" for r in rows for x in CLASHES), name
    assert {r.doc_id for r in P.pack(spark, docs, SF).collect()} == set(range(5))


def test_near_stage_with_repeated_rows_and_without_ids(spark, make_docs):
    rng = random.Random(4)
    text = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(40))
    a, b, c, d = text(), text(), text(), text()
    docs = make_docs([a, a, a, b, b, c, c, d, d, None, None, ""], [1, 1, 2, 5, 5, 7, None, None, None, None, 9, 9])
    for part in (docs, docs.repartition(3)):
        got = sorted((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in P.drop_near_duplicates(spark, part, SF).collect())
        assert [x for x in got if x[0] in (1, 2, 5, 7)] == [(1, a), (5, b), (7, c)]
        assert [x for x in got if x[0] == -1] == [(-1, ""), (-1, d)] and len([x for x in got if x[0] == 9]) == 1


def exchanged(df, column):
    """Rows that the plan of ``df``, which has run, wrote to its exchanges that carry ``column``."""

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        own = 0
        if kind == "ShuffleExchangeExec" and f"{column}#" in node.output().mkString(","):
            own = node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        return own + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())


@pytest.mark.parametrize("repeats", [0, 3])
def test_near_stage_shuffles_no_text_that_stays(spark, make_docs, repeats):
    """Where the dropped ids are too many to be broadcast, only the rows they name are shuffled."""
    rng = random.Random(14)
    text = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(60))
    texts = [text() for _ in range(300)]
    texts += [t + " end" for t in texts[:40]]
    docs = make_docs(texts + texts[100 : 100 + repeats], [*range(340), *range(100, 100 + repeats)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = P.drop_near_duplicates(spark, docs, SF)
        got = sorted(r.doc_id for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == list(range(300))
    assert exchanged(out, "text") <= 40 + 6 * repeats


@pytest.mark.parametrize("bits", [6, 9])
def test_near_stage_with_a_full_map_of_ids(spark, make_docs, monkeypatch, bits):
    """A map that says yes to rows that stay changes nothing: the join decides."""
    rng = random.Random(15)
    text = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(60))
    texts = [text() for _ in range(300)]
    texts += [t + " end" for t in texts[:80]]
    monkeypatch.setattr(minhash, "MAP_BITS", bits)
    for more in ([], [7, 7, 299, None]):
        docs = make_docs(texts + [text() for _ in more], [*range(380), *more])
        got = [r.doc_id for r in P.drop_near_duplicates(spark, docs, SF).collect()]
        assert sorted(x for x in got if x is not None) == list(range(300)) and got.count(None) == more.count(None)


def test_empty_tables(spark, make_docs):
    for name, function in P.STAGES:
        out = function(spark, make_docs([]), SF)
        assert out.collect() == [], name


def test_run_on_a_table(spark, table):
    before = set(common._LEFT)
    out = P.run(spark, SF)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert 0 < out.select("doc_id").distinct().count() <= table.count()
    assert len(P.STAGES) == 5 and out.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 2048
    assert sum("pipeline-" in x for x in set(common._LEFT) - before) == 1  # the last stage's table, which the result reads
