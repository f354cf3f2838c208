"""Chunk plans: bounds, ranges, row numbers, row positions, balance and row caps."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyport import runtime
from tallyport.operators import chunks, ledger
from tallyport.sources.tables import path_exists


def keyed(spark, values, kind="bigint"):
    return spark.createDataFrame([(v,) for v in values], f"k {kind}")


def test_bounds(spark):
    assert tuple(chunks.key_bounds(keyed(spark, [5, -3, None]), "k").first()) == (-3, 5)
    assert tuple(chunks.key_bounds(keyed(spark, []), "k").first()) == (1, 0)
    assert tuple(chunks.row_bounds(keyed(spark, [7, 7, 7])).first()) == (1, 3)


def test_two_ranges_of_five_thousand(spark, rows):
    plan = chunks.plan_key_ranges(spark.range(1, 10_001).toDF("ID"), "ACCOUNT", "ID", 5000)
    assert rows(plan, "chunk_id", "where_clause", "row_count") == [
        ("ACCOUNT-000001", "ID >= 1 and ID <= 5000", 5000),
        ("ACCOUNT-000002", "ID >= 5001 and ID <= 10000", 5000),
    ]


def test_chunk_id_keeps_seven_digits(spark):
    assert spark.range(1).select(chunks.chunk_id("T", F.lit(1234567))).first()[0] == "T-1234567"


@pytest.mark.parametrize("size", [0, -1])
def test_size_must_be_positive(spark, size):
    df = keyed(spark, [1])
    for plan in (
        lambda: chunks.plan_key_ranges(df, "T", "k", size),
        lambda: chunks.plan_row_numbers(df, "T", ["k"], size),
        lambda: chunks.assign_chunks(df, ["k"], size),
    ):
        with pytest.raises(ValueError, match="greater than zero"):
            plan()


def test_ranges_cover_every_row_once(spark):
    values = [-7, -7, 0, 3, 12, 13, 99, None, None]
    df = keyed(spark, values)
    plan = chunks.plan_key_ranges(df, "T", "k", 10).collect()
    assert sum(r["row_count"] for r in plan) == len(values)
    assert sum(df.where(r["where_clause"]).count() for r in plan) == len(values)
    for r in plan:
        assert df.where(r["where_clause"]).count() == r["row_count"]


def test_only_filled_ranges_unless_dense(spark, rows):
    df = keyed(spark, [0, 1, 95])
    assert [r[0] for r in rows(chunks.plan_key_ranges(df, "T", "k", 10), "chunk_no")] == [1, 10]
    dense = chunks.plan_key_ranges(df, "T", "k", 10, dense=True)
    assert sorted(r["row_count"] for r in dense.collect()) == [0] * 8 + [1, 2]
    assert chunks.plan_key_ranges(keyed(spark, []), "T", "k", 10, dense=True).count() == 0


def test_fractional_ranges_leave_no_gap(spark):
    df = keyed(spark, [1.0, 10.5, 10.99, 11.0, 20.999, 21.0], "double")
    plan = chunks.plan_key_ranges(df, "T", "k", 10).collect()
    assert sum(df.where(r["where_clause"]).count() for r in plan) == 6
    assert any("<" not in r["where_clause"] for r in plan)


def test_strategy_choice():
    schema = T.StructType.fromDDL("id bigint, n decimal(19,0), f decimal(10,2), s string")
    assert chunks.choose_strategy(schema, ["id"]) == chunks.KEY_RANGE
    assert chunks.choose_strategy(schema, ["n"]) == chunks.KEY_RANGE
    assert chunks.choose_strategy(schema, ["f"]) == chunks.ROW_NUMBER
    assert chunks.choose_strategy(schema, ["s"]) == chunks.ROW_NUMBER
    assert chunks.choose_strategy(schema, ["id", "s"]) == chunks.ROW_NUMBER
    assert chunks.choose_strategy(schema, []) == chunks.ROW_POSITION


def test_row_numbers_equal_a_global_window(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("a"), (F.col("id") % 13).cast("string").alias("b"))
    numbered = chunks.number_rows(df, ["b", "a"], 5)
    got = [(r["b"], r["a"]) for r in numbered.orderBy("row_no").collect()]
    assert got == sorted(got)
    assert [r[0] for r in numbered.select("row_no").orderBy("row_no").collect()] == list(range(1, 1001))


def test_row_numbers_with_nulls_and_shuffled_input(spark):
    df = keyed(spark, [3, None, 1, None, 2]).repartition(3)
    numbered = chunks.number_rows(df, ["k"], 3, stable_input=False)
    assert [r["k"] for r in numbered.orderBy("row_no").collect()] == [None, None, 1, 2, 3]


def test_row_number_plan_for_character_key(spark, rows):
    df = spark.range(10_000).select(F.format_string("C%05d", "id").alias("CITY_ID"))
    plan = chunks.plan_row_numbers(df, "CITY", ["CITY_ID"], 5000)
    got = rows(plan, "chunk_id", "first_row", "last_row", "row_count", "first_key.CITY_ID", "last_key.CITY_ID")
    assert got == [
        ("CITY-000001", 1, 5000, 5000, "C00000", "C04999"),
        ("CITY-000002", 5001, 10000, 5000, "C05000", "C09999"),
    ]


@pytest.mark.parametrize(("count", "size"), [(10, 3), (10, 10), (10, 1), (1, 5), (9, 3), (0, 4)])
def test_row_number_plan_sizes(spark, count, size):
    plan = chunks.plan_row_numbers(spark.range(count), "T", ["id"], size).orderBy("chunk_no").collect()
    wanted = [min(size, count - start) for start in range(0, count, size)]
    assert [r["row_count"] for r in plan] == wanted


def test_chunk_can_be_read_again_by_its_keys(spark):
    df = spark.range(300).select((F.col("id") % 3).alias("a"), F.col("id").cast("string").alias("b"))
    total = 0
    for chunk in chunks.plan_row_numbers(df, "T", ["a", "b"], 70).collect():
        part = df.where(chunks.between_keys(["a", "b"], chunk["first_key"], chunk["last_key"]))
        assert part.count() == chunk["row_count"]
        total += chunk["row_count"]
    assert total == 300


def test_equal_rows_spread_over_partitions(spark):
    """A third of the rows and more share one key; no partition holds them all."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 < 2, 5).otherwise(F.col("id")).alias("k"))
    numbered = chunks.number_rows(df, ["k"], 8)
    sizes = [r["count"] for r in numbered.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 12_000
    assert numbered.agg(F.count_distinct("row_no"), F.max("row_no")).first() == (30_000, 30_000)
    plan = chunks.plan_row_numbers(df, "T", ["k"], 1000)
    assert {r["row_count"] for r in plan.collect()} == {1000}


def test_work_is_kept_in_the_shared_folder_and_can_be_cleared(spark):
    numbered = chunks.number_rows(spark.range(10), ["id"], 2)
    folder = runtime.work_folder(spark)
    assert folder.startswith(runtime.shared_folder(spark))
    assert all(folder in file for file in numbered.inputFiles()) and numbered.inputFiles()
    runtime.clear_work(spark)
    assert not path_exists(spark, folder)


def test_row_positions_over_several_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 1000, 1, 7).select((F.col("id") % 5).alias("v")).write.parquet(path)
    df = spark.read.parquet(path)
    assert chunks.has_row_positions(df)
    plan = chunks.plan_row_positions(df, "LOG", 300).orderBy("chunk_no").collect()
    assert [(r["first_row"], r["last_row"], r["row_count"]) for r in plan] == [
        (1, 300, 300), (301, 600, 300), (601, 900, 300), (901, 1000, 100),
    ]
    assert sum(len(r["pieces"]) for r in plan) == 7 + 3
    sizes = chunks.assign_chunks(df, [], 300).groupBy("chunk_no").count().orderBy("chunk_no")
    assert [tuple(r) for r in sizes.collect()] == [(1, 300), (2, 300), (3, 300), (4, 100)]


def test_row_positions_refuse_a_filtered_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 100, 1, 2).write.parquet(path)
    with pytest.raises(Exception, match="whole files"):
        chunks.plan_row_positions(spark.read.parquet(path).where("id > 3"), "T", 10).collect()


def test_keyless_frame_without_files_is_numbered(spark):
    df = keyed(spark, [1, 1, 1, 2, 2, 9, 9])
    assert not chunks.has_row_positions(df)
    sizes = chunks.assign_chunks(df, [], 3).groupBy("chunk_no").count().orderBy("chunk_no")
    assert [tuple(r) for r in sizes.collect()] == [(1, 3), (2, 3), (3, 1)]
    assert chunks.plan_chunks(df, "T", [], 3).count() == 3


def test_explode_span_in_blocks(spark):
    df = spark.createDataFrame([(3, 27), (100, 100)], "lo bigint, hi bigint")
    out = chunks.explode_span(df, F.col("lo"), F.col("hi"), "n", block=4)
    assert sorted(r["n"] for r in out.collect()) == [*range(3, 28), 100]


def test_running_total_across_blocks(spark):
    data = [(t, n, (n * 7) % 5) for t in ("a", "b") for n in range(1, 60)]
    df = spark.createDataFrame(data, "t string, n bigint, v bigint")
    got = {(r["t"], r["n"]): r["s"] for r in chunks.running_total(df, "v", "n", ["t"], "s", block=8).collect()}
    for t, n, _ in data:
        assert got[t, n] == sum(v for u, m, v in data if u == t and m < n)


def test_row_cap_overshoots_by_one_chunk(spark, rows):
    data = [("T", n, 10) for n in range(1, 6)] + [("U", 1, 4)]
    plan = spark.createDataFrame(data, "table_name string, chunk_no bigint, row_count bigint")
    got = rows(ledger.row_capped_chunks(plan, 25), "table_name", "chunk_no", "status")
    assert [r[2] for r in got] == ["PENDING"] * 3 + ["SKIPPED"] * 2 + ["PENDING"]


def test_balance_shows_a_lopsided_key(spark):
    values = [*range(100), *[5] * 300, 999]
    got = {r["split"]: r for r in chunks.chunk_balance(keyed(spark, values), "T", "k", 100).collect()}
    assert got["RANGE"]["chunks"] == got["HASH"]["chunks"] == 10
    assert got["RANGE"]["filled_chunks"] == 2
    assert got["RANGE"]["largest_chunk"] == 400
    assert got["RANGE"]["skew_percent"] == 400 * 100 * 10 // 401
    empty = chunks.chunk_balance(keyed(spark, []), "T", "k", 100).collect()
    assert [r["row_count"] for r in empty] == [0, 0]


def test_predicates_in_order_and_suggested_size(spark):
    plan = chunks.plan_key_ranges(spark.range(0, 30), "T", "id", 10)
    assert chunks.predicates(plan) == [
        "id >= 0 and id <= 9", "id >= 10 and id <= 19", "id >= 20 and id <= 29",
    ]
    assert chunks.suggest_size(10**12) == 10**8
    assert chunks.suggest_size(0) == 1


@pytest.mark.parametrize(
    "kind, low, high, size",
    [
        ("int", -2_000_000_000, 2_147_483_647, 1000),
        ("smallint", -32768, 32767, 500),
        ("bigint", -9_223_372_036_854_775_808, 9_223_372_036_854_775_807, 10**15),
        ("decimal(38,0)", -(10**38) + 1, 10**38 - 1, 10**17),
    ],
)
def test_ranges_over_a_whole_type(spark, kind, low, high, size):
    values = [low, low + 1, -1, 0, 1, high - size, high - 1, high]
    if kind.startswith("decimal"):
        values = [-(10**34), -1, 0, 10**34]
    df = spark.createDataFrame([(str(v),) for v in values], "k string").select(F.col("k").cast(kind))
    plan = chunks.plan_key_ranges(df, "T", "k", size).collect()
    assert sum(r["row_count"] for r in plan) == len(values)
    numbers = {int(r["k"]): r["n"] for r in df.select("k", chunks.range_number(df, "k", size).alias("n")).collect()}
    assert numbers == {v: (v - min(values)) // size + 1 for v in values}
    for r in plan:
        inside = [v for v in values if r["low_key"] <= v <= r["high_key"]]
        assert len(inside) == r["row_count"]
        assert df.where(r["where_clause"]).count() == r["row_count"]


def test_quoted_key_names(spark):
    df = spark.range(10).withColumnRenamed("id", "order by")
    plan = chunks.plan_key_ranges(df, "T", "order by", 4, quote="`").collect()
    assert [df.where(r["where_clause"]).count() for r in sorted(plan, key=lambda r: r["chunk_no"])] == [4, 4, 2]


# --- ranges of equal depth -------------------------------------------------------------


def plain_quantiles(keys, size):
    """Rows by chunk: cuts at every ``size``-th key; a key at two cuts is a chunk of its own."""
    known = sorted(k for k in keys if k is not None)
    cuts = [known[i - 1] for i in range(size, len(known), size)]
    ends = sorted({(c, 0) for c in cuts} | {(c, -1) for c in cuts if cuts.count(c) > 1})
    found = {}
    for k in keys:
        found.setdefault(0 if k is None else 1 + sum(e < (k, 0) for e in ends), []).append(k)
    return {no: (min(v), max(v), len(v)) if no else (None, None, len(v)) for no, v in found.items()}


@pytest.mark.parametrize("size", [1, 7, 50, 1000])
def test_quantiles_equal_brute_force(spark, size):
    """Far apart, negative, null and very frequent keys."""
    keys = [None] * 9 + [-(10**15), 10**15, *range(1000, 1100), *range(40), *[5] * 120, *[7] * 60, -3, -3]
    plan = chunks.plan_quantiles(keyed(spark, keys).repartition(4), "t", "k", size)
    got = {r["chunk_no"]: (r["low_key"], r["high_key"], r["row_count"]) for r in plan.collect()}
    assert got == plain_quantiles(keys, size)
    df = keyed(spark, keys)
    for r in plan.limit(12).collect():
        assert df.where(r["where_clause"]).count() == r["row_count"]


@pytest.mark.parametrize("size", [1, 7, 50, 60, 1000])
def test_more_cuts_than_a_summary_holds_are_exact(spark, monkeypatch, size):
    """The same keys and two whole blocks, by counts; blocks of the running total are small."""
    monkeypatch.setattr(chunks, "MOST_CUTS", 0)
    monkeypatch.setattr(chunks.running_total, "__defaults__", (3,))
    keys = [None] * 9 + [-(10**15), 10**15, *range(1000, 1100), *range(40), *[5] * 120, *[6] * 60, *[7] * 60, -3, -3]
    for some in (keys, keys[9:], [4] * 8, [4] * 8 + [5] * 8):
        plan = chunks.plan_quantiles(keyed(spark, some).repartition(4), "t", "k", size)
        got = {r["chunk_no"]: (r["low_key"], r["high_key"], r["row_count"]) for r in plan.collect()}
        assert got == plain_quantiles(some, size)


def test_more_chunks_than_cuts_of_one_pass(spark):
    plan = chunks.plan_quantiles(spark.range(25_000).withColumnRenamed("id", "k"), "t", "k", 2)
    assert plan.agg(F.count("*"), F.min("row_count"), F.max("chunk_no")).first() == (12_500, 2, 12_500)


@pytest.mark.parametrize("kind", ["double", "decimal(12,3)", "date", "timestamp_ntz", "smallint"])
def test_quantiles_of_other_keys(spark, kind):
    value = F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")) if kind in ("date", "timestamp_ntz") else F.col("id") / 4 if kind in ("double", "decimal(12,3)") else F.col("id")
    df = spark.range(200).select(value.cast(kind).alias("k"))
    plan = chunks.plan_quantiles(df, "t", "k", 30, quote="`").orderBy("chunk_no").collect()
    assert [r["row_count"] for r in plan] == [30] * 6 + [20]
    assert [df.where(r["where_clause"]).count() for r in plan] == [30] * 6 + [20]


def test_quantile_plans_of_little_or_too_much(spark):
    df = keyed(spark, [])
    assert chunks.plan_quantiles(df, "t", "k", 10).count() == 0
    nulls = chunks.plan_quantiles(keyed(spark, [None, None]), "t", "k", 10).collect()
    assert [(r["chunk_no"], r["where_clause"], r["row_count"]) for r in nulls] == [(0, "k is null", 2)]
    assert chunks.plan_quantiles(keyed(spark, [4, 4, 4]), "t", "k", 1).count() == 1
    with pytest.raises(ValueError, match="too many chunks"):
        chunks.quantile_cuts(spark.range(100_000).withColumnRenamed("id", "k"), "k", 2)
    with pytest.raises(ValueError):
        chunks.plan_quantiles(df, "t", "k", 0)


def test_a_summary_is_nearly_even_and_frequent_keys_stand_alone(spark):
    """Cubes of numbers, a third of them one key, and a summary much smaller than the table."""
    key = F.when(F.col("id") % 3 == 0, 10**6).otherwise(F.col("id") * F.col("id") * F.col("id"))
    df = spark.range(300_000).select(key.alias("k"))
    plan = chunks.plan_quantiles(df, "t", "k", 3000, accuracy=2000)
    alone = plan.where("low_key = high_key").collect()
    assert [(r["low_key"], r["row_count"]) for r in alone if r["row_count"] > 1] == [(10**6, 100_001)]
    even = chunks.plan_balance(plan).first()
    assert even["row_count"] == 300_000 and even["largest_chunk"] == 100_001
    assert 2700 <= even["largest_of_several_keys"] <= 3300 and 66 <= even["chunks"] <= 72
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Sort " not in text and "Join" not in text and "Window" not in text and text.count("Exchange") == 1
