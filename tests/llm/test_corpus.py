"""Queries against their SQL, and the pipeline stage by stage."""

from __future__ import annotations

from collections import Counter

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from compare import connect
from corpus import SF, documents
from tidemark.llm import decontamination, ngram_join, pii, toxicity
from tidemark.llm.queries import LLM_QUERIES, LLM_SQL


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_query_equals_sql(spark, name):
    found, wanted = LLM_QUERIES[name](spark, SF), connect(SF).sql(LLM_SQL[name])
    columns = sorted(wanted.columns)
    assert sorted(found.columns) == columns
    left = Counter(tuple(r) for r in found.select(*columns).collect())
    order = ", ".join(f'"{c}"' for c in columns)
    right = Counter(connect(SF).sql(f"SELECT {order} FROM ({LLM_SQL[name]}) q").fetchall())
    assert left == right and left


def test_registered():
    names = driver.queries()
    assert {n.split("_")[0] for n in LLM_QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(LLM_QUERIES) | {"pipeline"} <= set(names)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, labels, bench = docs.columns, spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    ids = lambda frame: {r["doc_id"] for r in frame.select("doc_id").collect()}
    toxic = ids(toxicity.score(docs, toxicity.fit(docs, labels)).where("predicted = 1"))
    held = docs
    for (name, stage), wanted in zip(
        corpus_pipeline.STAGES[:4],
        (
            lambda d: ids(d) - toxic,
            lambda d: {r["component_id"] for r in ngram_join.join(d, words=5, share=(80, 100)).collect()},
            lambda d: ids(d) - ids(decontamination.found_items(d, bench)),
            ids,
        ),
        strict=True,
    ):
        out = corpus_pipeline.stored(stage(spark, held, SF), "stage")
        assert out.columns == columns, name
        assert ids(out) == wanted(held), name
        before, held = held, out
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    for r in held.collect():
        assert not [s for s in pii.base_spans(r["text"]) if s in pii.base_spans(texts[r["doc_id"]])] and r["n_chars"] == len(r["text"])
    packed = corpus_pipeline.STAGES[4][1](spark, held, SF)
    assert ids(packed) == ids(held)


def test_pipeline_on_an_empty_table(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
