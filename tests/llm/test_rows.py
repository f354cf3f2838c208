"""Numbers of rows that do not depend on how files are split among tasks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyport.llm import decontam, jaccard, langid, linededup, mixing, topk
from tallyport.llm.order import with_rows
from tallyport.llm.queries import op8_line_neighbours


@pytest.fixture
def split(spark):
    """Sets into how many parts scans are cut from now on."""

    def into(parts):
        spark.conf.set("spark.sql.files.minPartitionNum", str(parts))
        spark.conf.set("spark.sql.files.openCostInBytes", "1" if parts > 1 else str(1 << 30))

    yield into
    spark.conf.unset("spark.sql.files.minPartitionNum")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.fixture
def many_files(spark, tmp_path):
    """1,000 documents in six files of different sizes."""
    text = F.concat_ws("\n", F.concat(F.lit("line "), F.col("id") % 7), F.concat(F.lit("own "), F.col("id")))
    rows = spark.range(1000).select(
        F.col("id").alias("doc_id"),
        F.repeat(text, F.when(F.col("id") < 300, 5).otherwise(1)).alias("text"),
        F.when(F.col("id") % 3 > 0, F.lit("en")).alias("lang"),
        F.concat(F.lit("s"), F.col("id") % 2).alias("source"),
        F.lit(1).alias("row"),
        F.lit("x").alias("file"),
    )
    path = f"{tmp_path}/documents.parquet"
    rows.repartitionByRange(6, "doc_id").write.parquet(path)
    return spark.read.parquet(path)


def test_numbers_stay_when_files_are_split_anew(many_files, split):
    found = []
    for parts in (1, 7):
        split(parts)
        found.append({r["row"]: r["doc"].asDict() for r in with_rows(many_files).collect()})
    assert found[0] == found[1] and len(found[0]) == 1000
    filtered = with_rows(many_files.where("doc_id % 10 = 0").select("doc_id")).collect()
    assert {(r["row"], r["doc"]["doc_id"]) for r in filtered} <= {(k, v["doc_id"]) for k, v in found[0].items()}
    made = with_rows(many_files.groupBy("source").count())
    assert made.count() == 2 and with_rows(many_files.limit(0)).count() == 0


def test_lines_and_ids_of_other_splits_meet(spark, many_files, split, tmp_path):
    split(1)
    ids = {r["row"]: r["doc"]["doc_id"] for r in with_rows(many_files).collect()}
    whole = sorted(tuple(r) for r in op8_line_neighbours(spark, str(tmp_path)).collect())
    split(7)
    found = linededup.repeated_lines(many_files).collect()
    assert sorted((ids[r["row"]], r["n_lines"], ",".join(map(str, r["dropped"]))) for r in found) == [
        (r[0], r[1], r[3]) for r in whole
    ]
    assert whole == sorted(tuple(r) for r in op8_line_neighbours(spark, str(tmp_path)).collect())


def test_no_query_finds_itself_under_another_split(spark, split, tmp_path):
    path = f"{tmp_path}/vectors"
    vectors = spark.range(600).select(F.col("id").alias("vec_id"), F.array(F.col("id") % 97, F.col("id") % 11).cast("array<float>").alias("embedding"))
    vectors.repartitionByRange(5, "vec_id").write.parquet(path)
    vectors = spark.read.parquet(path)
    split(1)
    index = topk.build_index(vectors)
    split(7)
    got = topk.search(index, vectors, F.col("vec_id") % 50 == 0, k=600).collect()
    assert not [r for r in got if r["query_id"] == r["vec_id"]]
    assert len(got) == 12 * 599


def test_operators_that_give_rows_back_agree(spark, many_files, split):
    found = []
    benchmark = spark.createDataFrame([(1, "own 17"), (2, "own 400")], "item_id long, text string")
    for parts in (1, 7):
        split(parts)
        found.append([
            sorted(r["doc_id"] for r in jaccard.deduplicate(many_files, 1, 80).collect()),
            sorted(r["doc_id"] for r in decontam.clean(many_files, benchmark, 2).collect()),
            sorted(r["doc_id"] for r in mixing.mixed_documents(many_files).collect()),
            sorted((r["lang"], tuple(r["buckets"])) for r in langid.examples(many_files, 50).collect()),
        ])
    assert found[0] == found[1]
    assert len(found[0][1]) < 1000


def test_large_components_keep_their_order(spark, tmp_path):
    """Whole numbers beyond 31 bits; a product that no long holds raises."""
    path = f"{tmp_path}/vectors"
    rows = [(0, [1.0, 0.0]), (1, [3e6, 0.0]), (2, [4e6, 0.0]), (3, [2e6, 5.0])]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(path)
    vectors = spark.read.parquet(path)
    got = topk.search(topk.build_index(vectors), vectors, F.col("vec_id") == 0, k=3).collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(2, 4096000000 * 1024), (1, 3072000000 * 1024), (3, 2048000000 * 1024)]
    with pytest.raises(Exception, match="cannot be a long"):
        topk.search(topk.build_index(vectors), vectors, F.col("vec_id") == 2, k=3).collect()
