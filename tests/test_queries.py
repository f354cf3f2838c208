"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
import check

from .conftest import MEDIUM, SMALL

NAMES = sorted(contract.QUERIES)
TWINS = {name: sql for name, sql in contract.oracle_sql().items() if name in contract.QUERIES}


@pytest.fixture(scope="module")
def database():
    return check.connect(SMALL)


def test_every_query_has_a_twin():
    assert sorted(TWINS) == NAMES


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, database, name):
    assert check.compare(spark, database, SMALL, name, contract.queries()[name], TWINS[name]) == ""


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["name", "status", "object_name", "message"]
    assert {r["status"] for r in result.collect()} == {"PASS"}


def test_known_counts(spark):
    """Values of the survey at scale 0.01, found equal in two engines."""
    queries = contract.queries()
    first = {name: queries[name](spark, MEDIUM).first() for name in (
        "row_count_check", "fk_orphans", "fk_orphans_composite", "fk_orphans_full",
    )}
    assert first["row_count_check"]["message"] == "source=15000 target=14992"
    assert first["fk_orphans"]["orphans"] == 131
    assert first["fk_orphans_composite"]["orphans"] == 783
    assert tuple(first["fk_orphans_full"]) == (783, 2000)
    duplicates = {r["table_name"]: r["duplicate_groups"] for r in queries["duplicate_keys"](spark, MEDIUM).collect()}
    assert duplicates["orders_altered"] == 147
    assert queries["duplicate_groups"](spark, MEDIUM).count() == 11785
    sides = {}
    for row in queries["row_diff_multiset"](spark, MEDIUM).collect():
        sides[row["side"]] = sides.get(row["side"], 0) + row["copies"]
    assert sides == {"source": 323, "target": 315}
