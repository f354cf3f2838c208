"""The checks of one table, and what they add up to."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyport.functions.canon import split_columns
from tallyport.operators import compare, keys
from tallyport.operators.compare import (
    DUPLICATE_KEY,
    DUPLICATE_TEXT,
    FAIL,
    ORPHAN_TEXT,
    ORPHANS,
    PASS,
    WARNING,
    result_row,
    verdict,
)
from tallyport.operators.ledger import status_rank
from tallyport.specs import ForeignKey, Table


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    if not frames:
        raise ValueError("nothing to unite")
    return reduce(DataFrame.unionByName, frames)


def duplicate_result(target: DataFrame, table: Table) -> list[DataFrame]:
    """One result per primary or unique key."""
    results = []
    for key in table.keys:
        count = keys.duplicate_keys(target, key.columns)
        message = F.format_string(DUPLICATE_TEXT, "duplicate_groups")
        good = verdict(F.col("duplicate_groups") == 0)
        results.append(count.select(*result_row(DUPLICATE_KEY, good, f"{table.name}.{key.name}", message)))
    return results


def orphan_result(child: DataFrame, parent: DataFrame, key: ForeignKey, name: str = ORPHANS) -> DataFrame:
    message = F.format_string(ORPHAN_TEXT, "orphans")
    return keys.orphans_by_rule(child, parent, key, joined=False).select(
        *result_row(name, verdict(F.col("orphans") == 0), f"{key.child}.{key.name}", message)
    )


def validate_table(
    source: DataFrame,
    target: DataFrame,
    table: Table,
    parents: Mapping[str, DataFrame] | None = None,
    sample_size: int = 100,
    orphan_check: str = ORPHANS,
) -> DataFrame:
    """Row count, duplicate keys, orphans, checksum and sample of one table.

    ``parents`` holds the target's parent tables by name; one outside the copied set, or
    of another schema, is passed like any other.  Row count and checksum share one scan
    of each side.
    """
    parents = parents or {}
    scalar, large = split_columns(source.schema)
    results = []
    if scalar:
        digests = compare.both_digests(source, target, scalar, table.scales, table.fingerprint)
        results.append(
            digests.select(
                F.inline(
                    F.array(
                        F.struct(
                            *compare.row_count_columns(table.name, "source_row_count", "target_row_count")
                        ),
                        F.struct(*compare.checksum_columns(table.name, large)),
                    )
                )
            )
        )
        results.append(compare.sample_result(source, target, table.name, table.primary_key, sample_size))
    else:
        results.append(compare.row_count_check(source, target, table.name))
    results += duplicate_result(target, table)
    for key in table.foreign_keys:
        if key.parent not in parents:
            raise ValueError(f"foreign key {key.name}: no parent table {key.parent} given")
        results.append(orphan_result(target, parents[key.parent], key, orphan_check))
    return union_all(results)


def final_status(validations: DataFrame, needs_review: DataFrame | None = None) -> DataFrame:
    """FAIL if any check failed, else WARNING if anything needs review, else PASS.

    ``needs_review`` is any table with a ``status``; its NEEDS_REVIEW rows count.
    """
    ranks = validations.agg(
        F.max(status_rank()).alias("rank"),
        F.count(F.lit(1)).alias("checks"),
        F.count_if(F.col("status") == FAIL).alias("failed"),
    )
    if needs_review is not None:
        found = needs_review.agg(
            F.max(F.when(F.col("status") == "NEEDS_REVIEW", 1).otherwise(0)).alias("rank"),
            F.lit(0).cast("bigint").alias("checks"),
            F.lit(0).cast("bigint").alias("failed"),
        )
        ranks = ranks.unionByName(found).agg(
            F.max("rank").alias("rank"), F.sum("checks").alias("checks"), F.sum("failed").alias("failed")
        )
    status = F.when(F.col("rank") == 2, FAIL).when(F.col("rank") == 1, WARNING).otherwise(PASS)
    return ranks.select(status.alias("status"), "checks", "failed")


def stop_flag(findings: DataFrame) -> DataFrame:
    """Whether any finding asks to stop, in one row."""
    return findings.agg(F.coalesce(F.bool_or("should_stop"), F.lit(False)).alias("should_stop"))
