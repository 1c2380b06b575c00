from pyspark.sql import functions as F

import corpus_pipeline as cp
from siftline.llm._common import written

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({"ids": F.lit(1), "row": F.lit("r"), "kept": F.lit(None).cast("string"), "d": F.lit(2)})
    counts = [docs.count()]
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        if name != cp.STAGES[-1][0]:
            assert out.schema.simpleString() == docs.schema.simpleString()
        docs = written(out, "test")
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * counts[0]
    assert docs.filter("NOT intact").count() == 0


def test_nulls_repeats_and_empty_tables(spark):
    words = " ".join(f"w{i}" for i in range(70))
    rows = [(None, None, None, None, None), (1, words, "en", "a", 9), (1, words, "en", "a", 9), (2, words + ".", None, None, None), (3, "", "en", "a", 0), (4, "x " * 60_000, "en", "a", None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in cp.STAGES:
            docs = written(stage(spark, docs, SF), "test")
        assert [r.doc_id for r in docs.collect()] == ([1] if data else [])


def test_near_copies_and_leaks_go(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    base = [f"word{i}" for i in range(200)]
    near = list(base)
    near[50] = near[120] = "other"
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(base)), (4, " ".join(f"q{i}" for i in range(80)) + " " + item), (5, " ".join(f"z{i}" for i in range(90)))]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int")
    for _, stage in cp.STAGES:
        docs = written(stage(spark, docs, SF), "test")
    assert sorted(r.doc_id for r in docs.collect()) == [1, 5]


def test_passages_go_from_documents_that_mostly_repeat(spark):
    part = lambda c, n: "".join(" ".join(f"{c}{i}x{k}" for k in range(8)) + ". " for i in range(n))
    p, q, x = part("p", 10), part("q", 10), part("x", 10)
    rows = [(0, p + part("a", 20)), (1, p + x), (2, p + x), (3, q + part("b", 20)), (4, p + part("c", 4)), (5, p + q)]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int")
    for name, stage in cp.STAGES[1:3]:
        docs = written(stage(spark, docs, SF), "test")
    out = {r.doc_id: r.text for r in docs.collect()}
    assert len(out.pop(5, "")) < 50  # a line at the end of a passage may stay
    assert out == {0: rows[0][1], 1: x, 3: rows[3][1]}  # what is left of 4 is under the least length
