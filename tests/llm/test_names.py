"""Columns whose names are those of results are replaced by them; all others pass through."""

from voltweave.llm import decontam, line_dedup, quality, toxicity


def with_columns(docs, *names):
    return docs.selectExpr("*", *(f"'{x}' AS `{x}`" for x in names), "'kept' AS `a.b`", "array(1) AS other")


def test_each_operator(spark, make_docs):
    docs = make_docs(["You idiot and moron", "a line of text", None])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "a line of text")], "item_id long, text string")
    cases = {
        "toxicity": (lambda d: toxicity.score_toxicity(d, toxicity.learn(d, labels, lambda c: c >= 0)), ("score", "Toxic_weight", "n")),
        "quality": (lambda d: quality.score_quality(quality.measure(d), quality.learn(quality.measure(d), labels, lambda c: c >= 0)), ("stats", "SCORE")),
        "lines": (line_dedup.dedup_lines, ("n_lines", "N_dropped", "__drop_")),
        "routed lines": (lambda d: line_dedup.dedup_lines(d, broadcast_bytes=0), ("n_lines", "n_dropped", "index", "salt")),
        "contamination": (lambda d: decontam.decontaminate(d, bench), ("n_words", "n_hit", "N_items", "items", "contaminated", "clean_text")),
    }
    for name, (f, names) in cases.items():
        plain, more = f(docs), f(with_columns(docs, *names))
        lower = [x.lower() for x in more.columns]
        assert len(set(lower)) == len(lower) and set(plain.columns) <= set(more.columns), name
        rows = {r.doc_id: r for r in more.collect()}
        for r in plain.collect():
            assert all(rows[r.doc_id][x] == r[x] for x in plain.columns), name
            assert rows[r.doc_id]["a.b"] == "kept" and rows[r.doc_id].other == [1], name
