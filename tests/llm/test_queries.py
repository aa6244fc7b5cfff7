"""The registered queries over the small tables, and the pipeline."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from ordwave.llm import scratch
from ordwave.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n", [3, 6, 7, 8])
def test_one_row_per_document(spark, n):
    q = next(f for k, f in entry.queries().items() if k.startswith(f"op{n}_"))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = q(spark, SMALL)
    assert sorted(r[0] for r in got.select("doc_id").collect()) == sorted(r[0] for r in docs.select("doc_id").collect())


def test_all_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert [k.split("_")[0] for k in names if k.startswith("op")] == [f"op{n}" for n in range(1, len(QUERIES) + 1)]
    assert len(pipeline.STAGES) == 5


def test_pipeline(spark, docs):
    columns = docs.columns
    made = docs.withColumn("n_chars", docs["doc_id"])
    step = made
    for name, stage in pipeline.STAGES[:-1]:
        before = step.count()
        step = scratch.table(stage(spark, step, SMALL), f"test-{name}")
        assert step.columns == [*columns, "n_chars"], name
        assert step.count() <= before
    last = pipeline.STAGES[-1][1](spark, step, SMALL)
    assert last.count() == step.count() > 0
    # of the exact and near copies one stays, and the passage stays in one document
    ids = {r.doc_id for r in step.collect()}
    assert not ids & set(range(200, 209, 2)) and len(ids & set(range(201, 209, 2))) == 1 and -7 in ids
    assert 400 in ids and 0 in ids


def test_run_is_the_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = scratch.table(stage(spark, docs, SMALL), "again")
    assert sorted(map(tuple, pipeline.run(spark, SMALL).collect())) == sorted(map(tuple, docs.collect()))


def test_pipeline_on_no_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        docs = scratch.table(stage(spark, docs, SMALL), "none")
    assert docs.count() == 0
