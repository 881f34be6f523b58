"""Each stage of the pipeline on its own input, and the whole of it on hard documents."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tideline.llm.common import materialise


@pytest.fixture(scope="module")
def folder(spark, corpus, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    corpus.selectExpr("doc_id", "text", "'en' as lang", "source", "cast(length(text) as bigint) as n_chars", "key", "label as __stats", "size as __row", "key as n_lines").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(100, 112)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, folder))
        seen[name] = docs
        assert name == "pack" or docs.columns == columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near", "mix", "pack"]
    ids = lambda n: {r.doc_id for r in seen[n].select("doc_id").collect()}
    assert ids("quality") >= ids("lines") >= ids("near") >= ids("mix") == ids("pack")
    # copies lose their repeated lines, so one of them stays; clean documents stay as they are
    assert len(ids("lines") & set(range(200, 206))) <= 2
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in seen["near"].where("doc_id between 301 and 330").collect():
        assert r.text == text[r.doc_id]
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, folder).collect()) == Counter(r.doc_id for r in seen["pack"].collect())


def test_stages_of_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.count() == 0 and (name == "pack" or out.columns == docs.columns)


def test_near_broadcasts_no_more_rows_than_its_documents_need(spark, folder):
    # at 0.6 GB of near copies the driver ran out of memory on entries of all bands, 20 for each document, that pass for a small table in Parquet
    n = 21_000
    text = F.concat(F.lit(" ".join(f"w{i}" for i in range(60)) + "\n"), F.col("id"))
    docs = materialise(spark.range(0, n, 1, 4).select(F.col("id").alias("doc_id"), text.alias("text")))
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsList().last().executionId() if store.executionsCount() else -1
    assert [r.doc_id for r in corpus_pipeline.stage_near(spark, docs, folder).select("doc_id").collect()] == [0]
    runs, sent = store.executionsList(), []
    for at in (x.executionId() for x in map(runs.apply, range(runs.size())) if x.executionId() > before):
        values, nodes = store.executionMetrics(at), store.planGraph(at).allNodes()
        for node in (x for x in map(nodes.apply, range(nodes.size())) if x.name() == "BroadcastExchange"):
            counted = [m.accumulatorId() for m in map(node.metrics().apply, range(node.metrics().size())) if m.name() == "number of output rows"]
            sent += [int(values.apply(k).replace(",", "")) for k in counted if values.contains(k)]
    assert sent and max(sent) <= 2 * n
