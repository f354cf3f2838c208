"""Duplicates, orphans, exclusion and closed subsets."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyport.operators import keys
from tallyport.specs import ForeignKey, Key, Table


def frame(spark, data, *names, kind="string"):
    return spark.createDataFrame(data, ", ".join(f"{n} {kind}" for n in names))


def test_duplicate_groups_ignore_nulls(spark, rows):
    data = [("1", "a"), ("1", "a"), ("1", None), ("1", None), (None, None), (None, None), ("2", "a")]
    df = frame(spark, data, "BRANCH_ID", "ACCOUNT_NO")
    assert rows(keys.duplicate_groups(df, ["BRANCH_ID", "ACCOUNT_NO"])) == [("1", "a", 2)]
    assert keys.duplicate_keys(df, ["BRANCH_ID", "ACCOUNT_NO"]).first()[0] == 1


def test_empty_keys_are_refused(spark):
    df = frame(spark, [("1",)], "a")
    with pytest.raises(ValueError):
        keys.duplicate_keys(df, [])
    with pytest.raises(ValueError):
        Key("pk", ())
    with pytest.raises(ValueError):
        ForeignKey("fk", "A", ("x", "y"), "B", ("z",))
    with pytest.raises(ValueError):
        keys.fk_orphans(df, df, ["a"], ["a", "b"])


def test_single_orphan(spark, rows):
    child = frame(spark, [(1,), (9,), (None,)], "CUSTOMER_ID", kind="long")
    parent = frame(spark, [(1,), (1,)], "ID", kind="long")
    assert keys.fk_orphans(child, parent, ["CUSTOMER_ID"], ["ID"]).first()[0] == 1
    assert rows(keys.orphan_keys(child, parent, ["CUSTOMER_ID"], ["ID"])) == [(9, 1)]
    assert keys.fk_orphans(child.limit(0), parent, ["CUSTOMER_ID"], ["ID"]).first()[0] == 0


COMPOSITE = [(1, 1), (1, None), (None, None), (9, 9)]


def test_match_simple_and_full(spark):
    child = frame(spark, COMPOSITE, "CUSTOMER_ID", "BRANCH_ID", kind="long")
    parent = frame(spark, [(1, 1), (2, 2)], "ID", "BRANCH_ID", kind="long")
    both = keys.fk_orphans_full(child, parent, ["CUSTOMER_ID", "BRANCH_ID"], ["ID", "BRANCH_ID"])
    assert tuple(both.first()) == (1, 2)
    for match, orphans in (("simple", 1), ("full", 2)):
        key = ForeignKey("fk", "A", ("CUSTOMER_ID", "BRANCH_ID"), "C", ("ID", "BRANCH_ID"), match)
        assert keys.orphans_by_rule(child, parent, key).first()[0] == orphans


def test_match_full_on_one_column_is_simple(spark):
    child = frame(spark, [(1,), (9,), (None,)], "a", kind="long")
    parent = frame(spark, [(1,)], "b", kind="long")
    key = ForeignKey("fk", "A", ("a",), "B", ("b",), "full")
    assert keys.orphans_by_rule(child, parent, key).first()[0] == 1
    assert tuple(keys.fk_orphans_full(child, parent, ["a"], ["b"]).first()) == (1, 1)


def test_hot_key_values(spark):
    """Most child rows share one orphan value."""
    child = spark.range(9000).select(F.when(F.col("id") % 3 < 2, -1).otherwise(F.col("id")).alias("fk"))
    parent = spark.range(9000).withColumnRenamed("id", "pk")
    assert keys.fk_orphans(child, parent, ["fk"], ["pk"]).first()[0] == 6000


def test_candidates(spark, rows):
    df = frame(spark, [("1", "x"), ("1", "y"), (None, "z")], "a", "b")
    got = rows(keys.key_candidates(df, "T", [["a"], ["b"], ["a", "b"]]))
    assert got == [
        ("T", "a", 3, 1, 1, 2, False), ("T", "a, b", 3, 1, 2, 1, False), ("T", "b", 3, 0, 3, 1, True),
    ]


def test_excluded_parents(spark, rows):
    child = frame(spark, [(100,), (100,), (1,), (None,)], "parent_id", kind="long")
    gone = frame(spark, [(100,), (200,)], "id", kind="long")
    assert rows(keys.excluded_parent_impact(child, gone, ["parent_id"], ["id"])) == [(100, 2)]


def test_dependents_of_excluded_items(spark, rows):
    data = [("V1", 2, "ATM"), ("V1", 1, "Log"), ("V1", 3, "ATM"), ("V2", 1, "CUSTOMERS")]
    edges = spark.createDataFrame(data, "item string, pos int, dep string")
    got = keys.excluded_dependents(edges, "item", "dep", ["atm", "LOG"], "pos")
    assert rows(got) == [("V1", "NEEDS_REVIEW", "References excluded table(s): Log, ATM")]
    with pytest.raises(ValueError):
        keys.excluded_dependents(edges, "item", "dep", [])


def fk(child, column, parent):
    return ForeignKey(f"{child}_{column}", child, (column,), parent, ("id",))


def test_parent_first():
    edges = [fk("ACCOUNT", "c", "CUSTOMER"), fk("account", "c2", "customer"), fk("EMPLOYEE", "boss", "EMPLOYEE")]
    assert keys.parent_first(["ACCOUNT", "EMPLOYEE", "CUSTOMER"], edges) == ["EMPLOYEE", "CUSTOMER", "ACCOUNT"]
    assert keys.parent_first(["ACCOUNT"], edges) == ["ACCOUNT"]
    with pytest.raises(ValueError, match="circular"):
        keys.parent_first(["A", "B"], [fk("A", "b", "B"), fk("B", "a", "A")])


def test_closed_subset_follows_all_edges(spark, rows):
    tables = {
        "line": frame(spark, [(1, 10, 7), (2, 11, 7), (3, None, 7), (4, 10, 8), (5, 10, None)], "id", "o", "p", kind="long"),
        "orders": frame(spark, [(10, 1), (11, 2), (12, None)], "id", "c", kind="long"),
        "customer": frame(spark, [(1,), (1,)], "id", kind="long"),
        "part": frame(spark, [(7,)], "id", kind="long"),
    }
    edges = [fk("line", "o", "orders"), fk("line", "p", "part"), fk("orders", "c", "customer")]
    cut = keys.fk_closed_subset(tables, edges)
    assert rows(cut["orders"], "id") == [(10,), (12,)]
    assert rows(cut["line"], "id") == [(1,), (3,), (5,)]
    assert list(cut) == list(tables)
    assert cut["line"].columns == ["id", "o", "p"]


def test_closed_subset_on_composite_keys(spark, rows):
    child = frame(spark, [(1, 1, 1), (2, 1, None), (3, 9, 9), (4, None, None)], "id", "a", "b", kind="long")
    parent = frame(spark, [(1, 1), (None, None)], "x", "y", kind="long")
    key = ForeignKey("fk", "c", ("a", "b"), "p", ("x", "y"))
    cut = keys.fk_closed_subset({"c": child, "p": parent}, [key])
    assert rows(cut["c"], "id") == [(1,), (2,), (4,)]


def test_table_spec():
    table = Table("T", keys=(Key("u", ("x",), "UNIQUE"), Key("p", ("a", "b"))))
    assert table.primary_key == ("a", "b")
    assert Table("T").primary_key == ()
    with pytest.raises(ValueError):
        Key("k", ("a",), "FOREIGN_KEY")


def test_closed_subset_of_a_table_that_refers_to_itself(spark):
    staff = spark.createDataFrame([(2, 1), (3, None), (4, 9), (5, 3), (6, 4), (7, 5)], "id int, boss int")
    key = ForeignKey("fk", "staff", ("boss",), "staff", ("id",))
    kept = keys.fk_closed_subset({"staff": staff}, [key])["staff"]
    assert sorted(r["id"] for r in kept.collect()) == [3, 5, 7]


def test_child_and_parent_keys_meet_in_one_aggregation(spark):
    """Each key value is held once; there is no join and no sort. Other types are joined."""
    child = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (2, None), (None, None), (9, 9), (9, 9)], "a long, b int")
    parent = spark.createDataFrame([(1, 1), (1, 1), (2, None), (5, 5)], "x long, y int")
    pair = (["a", "b"], ["x", "y"])
    full = keys.fk_orphans_full(child, parent, *pair)
    plan = full._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Sort" not in plan
    for other in (parent, parent.select(F.col("x").cast("int"), F.col("y").cast("long"))):
        assert tuple(keys.fk_orphans_full(child, other, *pair).first()) == (3, 4)
    assert tuple(keys.fk_orphans_full(child, parent, *pair, joined=True).first()) == (3, 4)
    texts = spark.createDataFrame([("01",), ("2",), ("3",)], "a string")
    assert tuple(keys.fk_orphans_full(texts, spark.range(1, 3).withColumnRenamed("id", "x"), ["a"], ["x"]).first()) == (1, 1)
