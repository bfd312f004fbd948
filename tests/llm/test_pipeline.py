"""The pipeline's stages on their own input, and the whole on a small table."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stopover.llm import language, mixing, pii, simhash
from stopover.session import staged
from tests.llm.test_documents import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF), name)
        kept.append(docs)
        if name != "pack":
            assert docs.columns == columns
    before = spark.read.parquet(f"{SF}/documents.parquet")

    model = language.fit(before, corpus_pipeline.queries.learns_language())
    ids = {r[0] for r in language.predicted(before, model).where("not rejected").select(
        "doc.doc_id").collect()}
    assert {r.doc_id for r in kept[0].collect()} == ids

    rows = {r.doc_id: plain_fingerprint(r.text) for r in kept[0].collect()}
    roots = plain_components(set(rows.values()), 4)
    least = {}
    for doc_id, fp in rows.items():
        least[roots[fp]] = min(doc_id, least.get(roots[fp], doc_id))
    assert sorted(r.doc_id for r in kept[1].collect()) == sorted(least.values())

    masked = {r.doc_id: r for r in kept[2].collect()}
    trees = pii.fit(kept[1])
    for row in kept[1].collect():
        text = pii.masked(row.text, pii.spans(row.text, trees))
        assert (masked[row.doc_id].text, masked[row.doc_id].n_chars) == (text, len(text))
        assert not pii.base_spans(text)

    copies = {r.doc.doc_id: r.copies for r in mixing.repetitions(kept[2]).collect()}
    taken = {r.doc_id: r.n for r in kept[3].groupBy("doc_id").agg(
        F.count("*").alias("n")).collect()}
    assert taken == {i: n for i, n in copies.items() if n}

    packed = kept[4].collect()
    firsts = [r.doc_id for r in packed if r.piece == 0]
    assert sorted(firsts) == sorted(r.doc_id for r in kept[3].collect())


def test_run(spark, tmp_path):
    odd = spark.createDataFrame(
        [(1, None, "en", "a", 0), (2, "", "en", "a", 0), (None, "one two three", "en", None, 13),
         (3, "one two three", "en", "b", 13), (3, "one two three", "en", "b", 13)],
        "doc_id long, text string, lang string, source string, n_chars long")
    odd.withColumn("hash", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() <= 2
    odd.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_one_of_each_keeps_unlike_texts_of_one_id(spark):
    rows = [(1, "first text of this id here"), (1, "another one entirely, unlike it"),
            (2, "first text of this id here")]
    got = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.text for r in got) == sorted({t for _, t in rows})


def test_one_of_each_of_repeated_rows(spark):
    rows = [(None, "the same text in very many rows", 1)] * 500 + [(5, "it has a row of its own", 2)]
    rows += [(5, "it has a row of its own", 3)] * 3 + [(8, None, 4), (9, None, 4), (8, "", 5)]
    rows += [(11, "a single text of other words", 6), (None, "without an id but once", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long").repartition(7)
    got = simhash.one_of_each(docs)
    assert got.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    assert len(kept) == 5 and kept.count((None, "the same text in very many rows")) == 1
    assert (11, "a single text of other words") in kept and (None, "without an id but once") in kept
    assert sum(k == (5, "it has a row of its own") for k in kept) == 1
    assert sum(not t for _, t in kept) == 1


def test_texts_are_shuffled_once(spark):
    docs = spark.range(50).selectExpr("id doc_id", "concat('text of row ', id) text")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = simhash.one_of_each(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the rows of both branches go by the same key; one exchange more for those that are there twice
    of_texts = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert sum("k_id" not in x for x in of_texts) <= 2, plan


def test_components_with_hubs(spark):
    edges = [(n, 1) for n in range(2, 3000)] + [(n + 5000, n + 5001) for n in range(40)] + [(2999, 5000)]
    table = spark.createDataFrame(edges, "u long, v long")
    got = {r.fp: r.root for r in simhash.components(table).collect()}
    assert got == {n: 1 for n in [*range(1, 3000), *range(5000, 5041)]}
