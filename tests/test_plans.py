"""What the physical plans must and must not hold."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tallyport.catalogue.inputs import ORDERS, altered_orders, read
from tallyport.catalogue.queries import QUERIES
from tallyport.operators import chunks, compare, keys, ledger
from tallyport.plans import validate
from tallyport.specs import ForeignKey

from .conftest import SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are where no side is small enough to broadcast."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def shuffles(plan: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin", plan))


def test_scan_reads_only_its_columns_and_pushes_its_range(spark):
    plan = plan_of(QUERIES["scan_chunk"](spark, SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    assert "GreaterThanOrEqual(o_orderkey" in plan and "LessThanOrEqual(o_orderkey" in plan


def test_orphans_count_keys_before_an_anti_join(spark, no_broadcast):
    child, parent = read(spark, SMALL, "orders"), read(spark, SMALL, "customer")
    plan = plan_of(keys.fk_orphans(child, parent, ["o_custkey"], ["c_custkey"]))
    assert "LeftAnti" in plan and "LeftOuter" not in plan
    assert plan.index("LeftAnti") < plan.index("partial_count(1)")
    assert shuffles(plan) == 2
    assert "PushedFilters: [IsNotNull(o_custkey)]" in plan


def test_closed_subset_semi_joins_plain_shuffles(spark, no_broadcast):
    """Both join sides are sorts right above their exchange, which AQE can split."""
    tables = {"orders": read(spark, SMALL, "orders"), "customer": read(spark, SMALL, "customer")}
    plan = plan_of(keys.fk_closed_subset(tables, list(ORDERS.foreign_keys))["orders"])
    lines = [line.strip(" :+-*()0123456789") for line in plan.splitlines()]
    at = next(i for i, line in enumerate(lines) if line.startswith("SortMergeJoin"))
    assert "LeftSemi" in lines[at]
    sorts = [i for i, line in enumerate(lines) if line.startswith("Sort ") and i > at]
    assert all(lines[i + 1].startswith("Exchange hashpartitioning") for i in sorts) and len(sorts) == 2


def test_table_checksum_shuffles_no_rows(spark):
    plan = plan_of(compare.both_digests(read(spark, SMALL, "orders"), altered_orders(spark, SMALL)))
    assert shuffles(plan) == 0
    assert plan.count("partial_bit_xor") == 2


@pytest.mark.parametrize("name", ["checksum_by_chunk", "chunk_ledger", "row_diff_multiset"])
def test_two_sided_checks_are_one_aggregation(spark, no_broadcast, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert shuffles(plan) == 1
    assert "Join" not in plan


def test_keyed_difference_needs_no_join(spark, no_broadcast):
    plan = plan_of(QUERIES["row_diff_keyed"](spark, SMALL))
    assert "Join" not in plan
    assert shuffles(plan) == 2


def test_row_positions_shuffle_no_rows(spark):
    """Only one count per file moves; the window over files is the one single task."""
    plan = plan_of(chunks.plan_row_positions(read(spark, SMALL, "lineitem"), "lineitem", 100))
    assert "rangepartitioning" not in plan
    # nothing of the table itself, only the metadata of its rows
    assert "ReadSchema: struct<>" in plan or "ReadSchema: struct<_tmp_metadata_row_index:bigint>" in plan


def test_numbering_has_no_window_over_all_rows(spark):
    numbered = chunks.number_rows(read(spark, SMALL, "orders"), ["o_orderkey"], 4)
    plan = plan_of(numbered)
    window_input = plan[plan.index("Window") :]
    assert "Exchange SinglePartition" in window_input
    assert "count(1)" in window_input, "the window must see one row per partition"
    assert "BroadcastHashJoin" in plan


def test_latest_state_combines_before_the_shuffle(spark):
    plan = plan_of(QUERIES["latest_chunk_state"](spark, SMALL))
    assert "Window" not in plan and "partial_max" in plan


def test_no_python_workers_and_no_cross_joins(spark):
    for name, query in QUERIES.items():
        if name in ("full_load", "copy_counts", "copy_restart", "load_existing", "report_files"):
            continue
        plan = plan_of(query(spark, SMALL))
        for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas"):
            assert word not in plan, f"{word} in {name}"


def test_running_total_window_is_per_block(spark):
    plan = spark.range(100).select(
        F.lit("T").alias("table_name"), F.col("id").alias("chunk_no"), F.lit(1).alias("row_count")
    )
    text = plan_of(ledger.row_capped_chunks(plan, 50))
    assert re.search(r"hashpartitioning\(.*_block", text)


def test_orphans_on_a_composite_key_share_the_aggregation_shuffle(spark, no_broadcast):
    lines = read(spark, SMALL, "lineitem")
    key = ForeignKey("fk", "l", ("l_orderkey", "l_linenumber"), "l", ("l_orderkey", "l_linenumber"), "full")
    assert shuffles(plan_of(keys.orphans_by_rule(lines, lines, key))) == 2


def test_orphans_of_a_load_are_one_aggregation_without_a_join(spark, no_broadcast):
    lines = read(spark, SMALL, "lineitem")
    some = lines.where("l_orderkey % 3 != 0")
    key = ForeignKey("fk", "l", ("l_orderkey", "l_linenumber"), "l", ("l_orderkey", "l_linenumber"), "full")
    found = validate.orphan_result(lines, some, key)
    plan = plan_of(found)
    assert shuffles(plan) == 1 and "Join" not in plan
    missing = lines.where("l_orderkey % 3 = 0").count()
    assert missing and found.first()["message"] == f"orphans={missing}"
