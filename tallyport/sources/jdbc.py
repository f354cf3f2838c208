"""JDBC tables, through Spark's own JDBC source.

Bounds of Spark's range read only set the stride: rows outside fall into the first and
last partition.  Where chunks must be exact, pass their predicates instead.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

# Default rows per fetch and per batch insert.
BATCH_ROWS = 5000


def read_key_ranges(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    low: int,
    high: int,
    partitions: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Range-partitioned read on a numeric key."""
    return spark.read.jdbc(
        url,
        table,
        column=key,
        lowerBound=low,
        upperBound=max(high, low) + 1,
        numPartitions=partitions,
        properties=_with_fetch_size(properties),
    )


def read_chunks(
    spark: SparkSession,
    url: str,
    table: str,
    predicates: Sequence[str],
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """One partition per chunk predicate; each predicate runs in the source."""
    if not predicates:
        raise ValueError("no chunk predicates given")
    return spark.read.jdbc(
        url, table, predicates=list(predicates), properties=_with_fetch_size(properties)
    )


def append_batches(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None
) -> None:
    """Batched append.  Each task commits on its own, so after a failed append the target
    can hold part of the rows: load an empty table or use :func:`truncate_and_load`."""
    _writer(df, properties).mode("append").jdbc(url, table)


def truncate_and_load(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None
) -> None:
    """Truncate the table, keeping its definition, and load it; safe to repeat."""
    _writer(df, properties).option("truncate", True).mode("overwrite").jdbc(url, table)


def _writer(df: DataFrame, properties: Mapping[str, str] | None):
    return df.write.options(**{"batchsize": str(BATCH_ROWS), **(properties or {})})


def _with_fetch_size(properties: Mapping[str, str] | None) -> dict[str, str]:
    return {"fetchsize": str(BATCH_ROWS), **(properties or {})}
