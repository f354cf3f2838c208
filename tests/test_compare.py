"""Counts, checksums, drift, samples and row differences."""

from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyport.catalogue.inputs import ORDERS, altered_orders, read
from tallyport.functions.canon import SOURCE_TYPE
from tallyport.operators import compare

from .conftest import MEDIUM, SMALL


def accounts(spark, *values):
    return spark.createDataFrame([(i, n) for i, n in values], "ID long, NAME string").select(
        F.col("ID").cast("decimal(19,0)").alias("ID"), "NAME"
    )


def result(df):
    row = df.first()
    return row["name"], row["status"], row["object_name"], row["message"]


def test_row_count(spark):
    two, one = accounts(spark, (1, "a"), (2, "b")), accounts(spark, (1, "a"))
    assert result(compare.row_count_check(two, one, "ACCOUNT")) == (
        "row-count", "FAIL", "ACCOUNT", "source=2 target=1",
    )
    assert result(compare.row_count_check(two, two, "ACCOUNT"))[1] == "PASS"


def test_checksum_equal_and_different(spark):
    left = accounts(spark, (1, "Account 1"))
    assert result(compare.checksum_check(left, accounts(spark, (1, "Account 1")), "ACCOUNT"))[1] == "PASS"
    assert result(compare.checksum_check(left, accounts(spark, (2, "Account 1")), "ACCOUNT"))[1] == "FAIL"
    assert result(compare.checksum_check(left, left.limit(0), "ACCOUNT"))[1] == "FAIL"


def test_checksum_sees_pairs_that_cancel_in_xor(spark):
    left = accounts(spark, (1, "a"), (2, "b"), (2, "b"))
    right = accounts(spark, (1, "a"), (3, "c"), (3, "c"))
    first, second = compare.table_digest(left).first(), compare.table_digest(right).first()
    assert first["hash_xor"] == second["hash_xor"]
    assert first["hash_sum"] != second["hash_sum"]


def test_checksum_leaves_out_large_columns(spark):
    schema = "ID long, DOC binary"
    left = spark.createDataFrame([(1, bytearray(b"a"))], schema)
    right = spark.createDataFrame([(1, bytearray(b"b"))], schema)
    name, status, _, message = result(compare.checksum_check(left, right, "ACCOUNT"))
    assert (name, status) == ("checksum", "WARNING")
    assert message.endswith("(Skipped LOB columns: [DOC])")
    with pytest.raises(ValueError, match="no column to compare"):
        compare.checksum_check(left.select("DOC"), right.select("DOC"), "ACCOUNT")


def test_marked_text_is_left_out(spark):
    left = accounts(spark, (1, "x")).withMetadata("NAME", {SOURCE_TYPE: "CLOB"})
    assert result(compare.checksum_check(left, accounts(spark, (1, "y")), "ACCOUNT"))[1] == "WARNING"


def test_digest_is_the_same_in_any_order_and_partitioning(spark):
    events = read(spark, SMALL, "events")
    scales = {"value": 2}
    digests = {
        tuple(compare.table_digest(df, scales=scales).first())
        for df in (events, events.repartition(7), events.orderBy(F.desc("ts")), events.coalesce(1))
    }
    assert len(digests) == 1


def test_exact_sum_equals_a_decimal_sum(spark):
    hashes = spark.range(1000).select((F.lit((1 << 60) - 1) - F.col("id")).alias("h"))
    got = hashes.agg(*compare.digest_aggregates(F.col("h"))).first()["hash_sum"]
    assert got == str(sum((1 << 60) - 1 - i for i in range(1000)))


def test_known_checksums(spark):
    """Values that the survey found equal in two engines."""
    columns = ["o_orderkey", "o_totalprice"]
    left = compare.table_digest(read(spark, MEDIUM, "orders"), columns, ORDERS.scales).first()
    right = compare.table_digest(altered_orders(spark, MEDIUM), columns, ORDERS.scales).first()
    assert (left["hash_xor"], left["hash_sum"]) == (1126923987723815816, "8625649269190920643916")
    assert (right["hash_xor"], right["hash_sum"]) == (391088627311848551, "8641081631018067707839")
    assert (left["row_count"], right["row_count"]) == (15000, 14992)


def test_chunk_checksums_point_at_the_difference(spark, rows):
    left = accounts(spark, *[(i, "x") for i in range(1, 31)])
    right = left.where("ID <> 12").unionByName(accounts(spark, (-4, "below")))
    got = rows(compare.checksum_by_chunk(left, right, "T", "ID", 10), "chunk_id", "source_rows", "target_rows", "status")
    assert got == [
        ("T-000000", 0, 1, "FAIL"), ("T-000001", 10, 10, "PASS"),
        ("T-000002", 10, 9, "FAIL"), ("T-000003", 10, 10, "PASS"),
    ]


def test_chunk_checksums_of_an_empty_source(spark, rows):
    right = accounts(spark, (1, "a"), (2, "b"))
    got = rows(compare.checksum_by_chunk(right.limit(0), right, "T", "ID", 10), "source_rows", "target_rows", "status")
    assert got == [(0, 2, "FAIL")]


def test_samples(spark):
    many = accounts(spark, *[(i, "x") for i in range(1, 151)])
    late = many.where("ID <> 120")
    early = many.where("ID <> 7")
    message = "Compared up to 100 rows. sourceRows=100 targetRows=100"
    assert result(compare.sample_result(many, late, "ACCOUNT", ["ID"]))[1:] == ("PASS", "ACCOUNT", message)
    assert result(compare.sample_result(many, early, "ACCOUNT", ["ID"]))[1:] == (
        "FAIL", "ACCOUNT", message + " - mismatch found!",
    )
    # values count, not the class that holds them
    assert result(compare.sample_result(many, many.withColumn("ID", F.col("ID").cast("int")), "A", ["ID"]))[1] == "PASS"
    # no key: all columns order the rows
    assert result(compare.sample_result(many.orderBy(F.desc("ID")), many, "ACCOUNT"))[1] == "PASS"
    assert result(compare.sample_result(many.limit(0), many.limit(0), "A"))[3].endswith("sourceRows=0 targetRows=0")


def test_sample_with_null_and_repeated_keys(spark):
    df = spark.createDataFrame([(None, "b"), (None, "a"), (1, "d"), (1, "c"), (2, "e")], "k long, v string")
    got = [tuple(r) for r in compare.sample_rows(df, ["k"], 4).collect()]
    assert got == [(None, "a"), (None, "b"), (1, "c"), (1, "d")]
    assert [tuple(r) for r in compare.sample_rows(df, ["k"], 1).collect()] == [(None, "a")]


def test_multiset_difference_counts_copies(spark, rows):
    left = accounts(spark, (1, "a"), (1, "a"), (1, "a"), (2, None), (3, "c"))
    right = accounts(spark, (1, "a"), (2, None), (3, "d"), (3, "d"))
    difference = compare.row_diff_multiset(left, right).withColumn("ID", F.col("ID").cast("int"))
    assert rows(difference) == [(1, "a", "source", 2), (3, "c", "source", 1), (3, "d", "target", 2)]


def test_keyed_difference(spark):
    schema = "k long, a string, b double"
    left = spark.createDataFrame(
        [(1, "x", 1.0), (2, "x", None), (3, "x", 3.0), (4, "x", 4.0), (5, "p", 1.0), (5, "q", 1.0), (None, "n", 0.0)],
        schema,
    )
    right = spark.createDataFrame(
        [(1, "x", 1.0), (2, "y", 2.0), (4, "x", 4.0), (4, "x", 4.0), (5, "p", 1.0), (5, "r", 1.0), (6, "x", 6.0), (None, "n", 0.0)],
        schema,
    )
    got = {r["k"]: tuple(r)[1:] for r in compare.row_diff_keyed(left, right, ["k"]).collect()}
    assert got == {
        2: ("CHANGED", 0, 0, 1, "a, b"),
        3: ("ONLY_SOURCE", 1, 0, 0, None),
        4: ("ONLY_TARGET", 0, 1, 0, None),
        5: ("CHANGED", 0, 0, 1, "a"),
        6: ("ONLY_TARGET", 0, 1, 0, None),
    }
    assert compare.row_diff_keyed(left, left.repartition(3), ["k"]).isEmpty()
    only_keys = compare.row_diff_keyed(left.select("k"), right.select("k"), ["k"])
    assert {r["k"] for r in only_keys.collect()} == {3, 4, 6}


def test_drill_down_equals_the_full_difference(spark, rows):
    orders, altered = read(spark, SMALL, "orders"), altered_orders(spark, SMALL)
    full = rows(compare.row_diff_keyed(orders, altered, ["o_orderkey"]))
    part = rows(compare.row_diff_drill_down(orders, altered, "o_orderkey", 20, scales=ORDERS.scales))
    assert full == part
    assert full


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(0, 4), st.sampled_from(["a", "b", None])), max_size=12),
    st.lists(st.tuples(st.integers(0, 4), st.sampled_from(["a", "b", None])), max_size=12),
)
def test_differences_against_brute_force(spark, left, right):
    schema = "k long, v string"
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    net = Counter(left)
    net.subtract(Counter(right))
    wanted = {(*row, "source" if n > 0 else "target", abs(n)) for row, n in net.items() if n}
    assert {tuple(r) for r in compare.row_diff_multiset(a, b).collect()} == wanted
    keyed = {r["k"]: r for r in compare.row_diff_keyed(a, b, ["k"]).collect()}
    for key in range(5):
        ours = sum(n for (k, _), n in net.items() if k == key and n > 0)
        theirs = -sum(n for (k, _), n in net.items() if k == key and n < 0)
        if ours or theirs:
            row = keyed[key]
            assert row["changed_rows"] == min(ours, theirs)
            assert row["only_source_rows"] == max(ours - theirs, 0)
            assert row["only_target_rows"] == max(theirs - ours, 0)
        else:
            assert key not in keyed


def noisy(spark):
    left = spark.createDataFrame([(1, 1.0), (2, 2.0), (11, 3.0)], "k int, v double")
    right = spark.createDataFrame([(1, 1.5), (2, 2.001), (11, 3.001)], "k int, v double")
    return left, right


@pytest.mark.parametrize("key", ["k", ["k"], ["k", "t"]])
@pytest.mark.parametrize("most", [0, 100])
def test_noise_below_the_scale_counts_on_no_path(spark, rows, key, most):
    left, right = (df.withColumn("t", F.lit("x")) for df in noisy(spark))
    keys = [key] if isinstance(key, str) else key
    full = rows(compare.row_diff_keyed(left, right, keys, scales={"v": 2}))
    part = rows(compare.row_diff_drill_down(left, right, key, 10, scales={"v": 2}, most_sent=most))
    assert full == part and [r[0] for r in full] == [1]
    both = compare.row_diff_multiset(left, right, ["k", "v"], {"v": 2})
    assert rows(both) == sorted([(1, 1.0, "source", 1), (1, 1.5, "target", 1)], key=repr)


def test_sides_of_other_types(spark):
    left = spark.range(20).select(F.col("id").cast("decimal(38,18)").alias("k"), F.lit("a").alias("s"))
    right = spark.range(20).select(F.col("id").alias("k"), F.lit("a").alias("s"))
    for source, target in ((left, right), (right, left)):
        assert compare.checksum_check(source, target, "t").first()["status"] == "PASS"
        assert compare.sample_result(source, target, "t", ["k"]).first()["status"] == "PASS"
        assert compare.row_diff_keyed(source, target, ["k"]).isEmpty()
    wrong = right.select(F.when(F.col("k") == 3, "three").otherwise(F.col("k").cast("string")).alias("k"), "s")
    nulls = right.withColumn("k", F.when(F.col("k") != 3, F.col("k")))
    assert compare.checksum_check(nulls, wrong, "t").first()["status"] == "FAIL"
    assert compare.sample_result(nulls, wrong, "t").first()["status"] == "FAIL"
    part = left.withColumn("k", F.col("k") + F.lit(0.5).cast("decimal(2,1)"))
    assert compare.checksum_check(right, part, "t").first()["status"] == "FAIL"


@pytest.mark.parametrize(
    "given, wanted, same, other",
    [
        ("timestamp", "date", ["2024-03-01 00:00:00"], ["2024-03-01 10:30:00"]),
        ("timestamp_ntz", "date", ["2024-03-01 00:00:00"], ["2024-03-01 10:30:00"]),
        ("date", "timestamp", ["2024-03-01"], []),
        ("timestamp", "bigint", ["2024-03-01 10:30:00"], ["2024-03-01 10:30:00.5"]),
        ("timestamp", "string", ["2024-03-01 10:30:00.5"], []),
        ("string", "date", ["2024-03-01", "2024-03-01 00:00:00"], ["2024-03-01 10:30", "2024-03-01 noon"]),
        ("string", "timestamp", ["2024-03-01 10:30", "2024-03-01T10:30:00.1234560Z"], ["2024-03-01 10:30:00.1234567"]),
        ("string", "timestamp_ntz", ["2024-03-01 10:30"], ["2024-03-01 10:30:00+02:00"]),
        ("string", "decimal(10,2)", ["1.2", " +01.200 ", "12e-1", "-0", "0.00", "1E2"], ["1.239", "1.2000001", "-1239e-3", "1e-9"]),
        ("string", "decimal(38,18)", ["0.000000000000000001"], ["0." + "0" * 40 + "1", "1." + "0" * 18 + "4"]),
        ("string", "int", ["7", "007", " 7 "], ["7.5"]),
        ("string", "double", ["1.50", "0.10000000000000001", "1e3", "NaN", "-Infinity"], ["9007199254740993", "1e400", "1e-400", "0.1000000000000000000001"]),
        ("boolean", "string", ["true"], []),
        ("int", "boolean", ["1"], ["2"]),
        ("double", "decimal(10,2)", ["1.25"], ["1.239"]),
    ],
)
def test_what_a_cast_loses(spark, given, wanted, same, other):
    for value in [*same, *other]:
        target = spark.createDataFrame([(1, value)], "k int, v string").withColumn("v", F.col("v").cast(given))
        source = target.withColumn("v", F.col("v").try_cast(wanted))
        good = value in same
        assert compare.checksum_check(source, target, "t").first()["status"] == ("PASS" if good else "FAIL"), value
        assert compare.row_diff_multiset(source, target).isEmpty() == good, value


def test_lost_times_and_decimals_differ_on_every_path(spark):
    kinds = "k long, d string, n string"
    text = spark.createDataFrame([(i, "2024-03-01 00:00:00", "1.24") for i in range(20)], kinds)
    source = text.select("k", F.col("d").cast("date").alias("d"), F.col("n").cast("decimal(10,2)").alias("n"))
    day = F.when(F.col("k") == 3, "2024-03-01 10:30:00").otherwise(F.col("d")).cast("timestamp")
    number = F.when(F.col("k") == 5, "1.239").otherwise(F.col("n"))
    target = text.select("k", day.alias("d"), number.alias("n"))
    assert compare.sample_result(source, target, "t", ["k"]).first()["status"] == "FAIL"
    chunks = compare.checksum_by_chunk(source, target, "t", "k", 5).orderBy("chunk_id").collect()
    assert [r["status"] for r in chunks] == ["FAIL", "FAIL", "PASS", "PASS"]
    for found in (
        compare.row_diff_keyed(source, target, ["k"]),
        compare.row_diff_drill_down(source, target, "k", 5),
    ):
        assert sorted(r["k"] for r in found.collect()) == [3, 5]


def test_stored_digests_keep_their_ranges(spark):
    df = spark.range(100, 300).toDF("k")
    low = F.lit(100)
    old = compare.chunk_digests(df, "t", "k", 50, low=low)
    new = compare.chunk_digests(df.where("k > 100").union(spark.range(40, 45)), "t", "k", 50, low=low)
    drift = {r["chunk_id"]: r["drift"] for r in compare.fingerprint_drift(old, new).collect()}
    assert drift == {
        "t-000000": "NEW", "t-000001": "CHANGED", "t-000002": "SAME", "t-000003": "SAME", "t-000004": "SAME",
    }
