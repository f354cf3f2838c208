"""Registered queries against their SQL twins, and the pipeline as a whole."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import check
import corpus_pipeline
from tallyport.llm.queries import QUERIES
from tallyport.llm.twins import twins

from ..conftest import SMALL
from .test_operators import contaminated


@pytest.mark.parametrize("name", sorted(twins()))
def test_query_equals_its_sql(spark, name):
    assert check.compare(spark, check.connect(SMALL), SMALL, name, QUERIES[name], twins()[name]) == ""


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(twins()) <= set(contract.oracle_sql())


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        ids = {r["doc_id"] for r in before.select("doc_id").collect()}
        assert {r["doc_id"] for r in docs.select("doc_id").collect()} <= ids
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        if name == "decontamination":
            rows = before.select("doc_id", "text").collect()
            bad = contaminated([r["text"] for r in rows], items)
            kept = [r["doc_id"] for r, b in zip(rows, bad, strict=True) if not b[-1]]
            assert sorted(kept) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())
        if name == "quality":
            bad = spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 0").join(docs, "doc_id", "left_semi")
            good = spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1")
            assert bad.count() <= 5 and good.join(docs, "doc_id", "left_anti").count() <= 0.1 * good.count()
    assert docs.count() == before.count()
    counts = [r["count"] for r in docs.groupBy("shard").count().collect()]
    assert max(counts) - min(counts) <= 1


def test_pipeline_of_no_documents(spark, tmp_path):
    folder = f"{tmp_path}/none"
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{table}.parquet").where(F.lit(False)).write.parquet(f"{folder}/{table}.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
