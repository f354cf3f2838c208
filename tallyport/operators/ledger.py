"""The ledger of chunk states and the error log: append-only tables by run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyport.operators.chunks import running_total

# States of a chunk.
PENDING, RUNNING, SUCCESS, FAILED, SKIPPED = "PENDING", "RUNNING", "SUCCESS", "FAILED", "SKIPPED"

CHUNK_KEY = ("run_id", "table_name", "chunk_id")

# Columns of the ledger and of the error log.
LEDGER_SCHEMA = (
    "run_id string, schema_name string, table_name string, chunk_id string, chunk_range string, "
    "rows_read bigint, rows_written bigint, status string, retry_count int, "
    "started_at timestamp, completed_at timestamp, last_error_id string"
)
ERROR_SCHEMA = (
    "error_id string, run_id string, phase string, object_type string, object_name string, "
    "chunk_id string, sql_text string, database_code string, message string, "
    "action_category string, created_at timestamp"
)

# Columns that a later record of a chunk leaves as the first one set them.
_FIRST_COLUMNS = ("schema_name", "chunk_range", "started_at")


def append_ledger(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").partitionBy("run_id").parquet(path)


def read_ledger(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    stored = spark.read.schema(LEDGER_SCHEMA).parquet(path)
    # the partition column comes last when read back
    ledger = stored.select(*T.StructType.fromDDL(LEDGER_SCHEMA).names)
    return ledger if run_id is None else ledger.where(F.col("run_id") == run_id)


def latest_state(
    ledger: DataFrame, keys: Sequence[str] = CHUNK_KEY, order_by: Sequence[str] = ("completed_at",)
) -> DataFrame:
    """The state of each chunk after all its records: counts, status and error of the
    last one, and what the first one set for good.

    An aggregation, so that many records of one chunk are combined before the shuffle.
    Records that tie in ``order_by`` are told apart by their other columns.
    """
    keys = list(keys)
    others = [c for c in ledger.columns if c not in keys]
    updated = [c for c in others if c not in _FIRST_COLUMNS]
    first = [c for c in others if c in _FIRST_COLUMNS]
    moment = [*order_by, *[c for c in others if c not in order_by]]
    aggregates = [F.max(F.struct(*moment)).alias("_last")]
    if first:
        aggregates.append(F.min(F.struct(*moment)).alias("_first"))
    state = ledger.groupBy(*keys).agg(*aggregates)
    picked = {c: F.col(f"_last.{c}") for c in updated} | {c: F.col(f"_first.{c}") for c in first}
    return state.select(*keys, *[picked[c].alias(c) for c in others])


def pending_chunks(
    plan: DataFrame, ledger: DataFrame, keys: Sequence[str] = ("table_name", "chunk_id")
) -> DataFrame:
    """Planned chunks without a SUCCESS record: what a restart has to copy."""
    done = ledger.where(F.col("status") == SUCCESS).select(*keys)
    return plan.join(done, list(keys), "left_anti")


def chunk_ledger(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str] = ("table_name", "chunk_no", "chunk_id"),
) -> DataFrame:
    """Rows read and written per chunk.  Both inputs carry ``keys`` on every row.

    SUCCESS where both counts agree, FAILED otherwise; one aggregation over both sides.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    united = source.select(*keys, one.alias("_r"), none.alias("_w")).unionByName(
        target.select(*keys, none.alias("_r"), one.alias("_w"))
    )
    return (
        united.groupBy(*keys)
        .agg(F.sum("_r").alias("rows_read"), F.sum("_w").alias("rows_written"))
        .withColumn(
            "status", F.when(F.col("rows_read") == F.col("rows_written"), SUCCESS).otherwise(FAILED)
        )
    )


def row_capped_chunks(plan: DataFrame, cap: int, table: str = "table_name") -> DataFrame:
    """Chunks that a copy still starts when it stops at ``cap`` rows read.

    A chunk runs as long as the chunks before it read fewer rows than the cap, so the
    last one may overshoot.  Chunks behind it are SKIPPED, the others PENDING.
    """
    planned = running_total(plan, "row_count", "chunk_no", [table], "rows_before")
    runs = F.col("rows_before") < F.lit(cap)
    return planned.withColumn("status", F.when(runs, PENDING).otherwise(SKIPPED))


def status_rank(status: str = "status"):
    """Order of result states: PASS below WARNING below FAIL."""
    return F.when(F.col(status) == "FAIL", 2).when(F.col(status) == "WARNING", 1).otherwise(0)
