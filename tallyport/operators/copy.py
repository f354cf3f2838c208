"""Copying a table in chunks, with a ledger that allows a restart."""

from __future__ import annotations

import uuid
from bisect import bisect_left
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyport.functions.convert import DEFAULT_CONVERTERS, Converter, convert_values
from tallyport.functions.names import rename_reserved
from tallyport.operators import ledger as L
from tallyport.operators.chunks import (
    BROADCAST_CHUNKS,
    KEY_RANGE,
    ROW_NUMBER,
    ROW_POSITION,
    Numbering,
    assign_chunks,
    check_size,
    choose_strategy,
    chunk_id,
    has_row_positions,
    plan_chunks,
    plan_numbered_chunks,
    range_number,
    running_total,
    whole_div,
    whole_order,
)
from tallyport.runtime import settle
from tallyport.sources.tables import path_exists, read_partitions, replace_partitions
from tallyport.specs import Table

CHUNK_COLUMN = "chunk_no"

# Phase and action of a copy error.
LOAD_PHASE = "data-load"
RETRY = "RETRY_OR_MANUAL_REVIEW"


@dataclass(frozen=True)
class CopyPaths:
    """Where the rows, the ledger and the errors go."""

    target: str
    ledger: str
    errors: str


class CopyFailed(RuntimeError):
    """A chunk of a table copy failed; it is on record with its error."""

    def __init__(self, error_id: str, table: str, chunk: str | None = None):
        super().__init__(f"copy of {table} failed in chunk {chunk}, see error {error_id}")
        self.error_id, self.chunk = error_id, chunk


def prepare_rows(
    df: DataFrame,
    policy: str = "RENAME",
    converters: Mapping[type, Converter] = DEFAULT_CONVERTERS,
) -> DataFrame:
    """Rows as the target takes them: converted values under target names."""
    return rename_reserved(convert_values(df, converters), policy)


def chunked_rows(df: DataFrame, table: Table, chunk_size: int) -> DataFrame:
    """Rows with the number and id of the chunk that the copy puts them in."""
    placed = assign_chunks(df, table.primary_key, chunk_size)
    return placed.select(
        F.lit(table.name).alias("table_name"), chunk_id(table.name, F.col(CHUNK_COLUMN)).alias("chunk_id"), "*"
    )


def copy_table(
    source: DataFrame,
    table: Table,
    paths: CopyPaths,
    run_id: str,
    chunk_size: int,
    row_cap: int | None = None,
    waves: int = 1,
    policy: str = "RENAME",
    converters: Mapping[type, Converter] = DEFAULT_CONVERTERS,
    most_failures: int = 1,
) -> DataFrame:
    """Copy the chunks that the run's ledger does not have as SUCCESS; returns the ledger.

    The target is partitioned by chunk, and a rerun overwrites whole partitions, so
    neither a restart nor a lost executor doubles rows.  ``waves`` splits the copy into
    that many jobs of about equal rows, each recorded when it is done.

    If a wave fails because rows cannot be made, its first broken chunk is searched by halves, by
    rows, that are only read; the chunks before and behind it are copied in one job each.  A
    wave that fails otherwise is halved in the same way, and the halves are copied, until the chunk
    that fails is alone.  That chunk is recorded as FAILED with its error, and
    after ``most_failures`` such chunks the copy stops; chunks it has not come to have no
    record.
    """
    if CHUNK_COLUMN in [c.lower() for c in source.columns]:
        raise ValueError(f"table {table.name} already has a column {CHUNK_COLUMN}")
    placed = _Placed(source, table, chunk_size)
    try:
        return _copy_placed(
            placed, table, paths, run_id, row_cap, waves, lambda df: prepare_rows(df, policy, converters), most_failures
        )
    finally:
        placed.close()


def _copy_placed(placed, table, paths, run_id, row_cap, waves, prepare, most_failures) -> DataFrame:
    spark, plan = placed.source.sparkSession, placed.plan
    if row_cap is None:
        plan = plan.withColumn("status", F.lit(L.PENDING))
    else:
        plan = L.row_capped_chunks(plan, row_cap)
    if path_exists(spark, paths.ledger):
        plan = _without_done(plan, L.read_ledger(spark, paths.ledger, run_id), table)
    plan = settle(plan)
    skipped = plan.where(F.col("status") == L.SKIPPED)
    if not skipped.limit(1).isEmpty():
        L.append_ledger(_records(skipped, table, run_id, L.SKIPPED, datetime.now(UTC)), paths.ledger)
    todo = _in_waves(plan.where(F.col("status") == L.PENDING), max(1, waves))
    failures: list[CopyFailed] = []
    # One row per wave reaches the driver.
    for wave in todo.groupBy("_wave").agg(*_bounds()).orderBy("_wave").collect():
        parts = [(wave["low"], wave["high"], wave["chunks"])]
        while parts:
            low, high, many = parts.pop(0)
            part, rows = _part_of(placed, plan, todo, low, high, many)
            started = datetime.now(UTC)
            try:
                _copy_part(prepare(rows), part, (low, high), table, paths, run_id, started)
            except Exception as problem:
                if many > 1:
                    alone = _around_broken(
                        part, lambda *run: prepare(_part_of(placed, plan, todo, *run)[1]), low, high
                    )
                    parts = [*(alone or _halves(part, low, high)), *parts]
                    continue
                failures.append(_record_failure(spark, problem, part, table, paths, run_id, started))
                if len(failures) >= most_failures:
                    raise failures[0] from problem
    if failures:
        raise failures[0]
    if not path_exists(spark, paths.ledger):  # an empty table has no chunk to record
        L.append_ledger(spark.createDataFrame([], L.LEDGER_SCHEMA), paths.ledger)
    return L.read_ledger(spark, paths.ledger, run_id)


def _bounds() -> list[Column]:
    number = F.col(CHUNK_COLUMN)
    return [F.min(number).alias("low"), F.max(number).alias("high"), F.count(F.lit(1)).alias("chunks")]


def _in_waves(todo: DataFrame, waves: int) -> DataFrame:
    """Chunks with ``_rows_before``, the rows of the chunks before them, and the ``_wave`` they go in."""
    total = todo.agg(F.sum("row_count")).first()[0] or 0
    counted = running_total(todo, "row_count", CHUNK_COLUMN, ["table_name"], "_rows_before")
    number = F.least(whole_div(F.col("_rows_before") * waves, max(1, total)), F.lit(waves - 1))
    return settle(counted.withColumn("_wave", number))


def _part_of(placed, plan: DataFrame, todo: DataFrame, low: int, high: int, many: int) -> tuple[DataFrame, DataFrame]:
    """The chunks to copy from ``low`` to ``high``, ``many`` of them, and their rows."""
    span = F.col(CHUNK_COLUMN).between(low, high)
    part, rows = todo.where(span), placed.rows(low, high)
    if many < plan.where(span).count():
        rows = _rows_of(rows, part.select(CHUNK_COLUMN), many)
    return part, rows


def _around_broken(part: DataFrame, rows_of, low: int, high: int) -> list[tuple[int, int, int]]:
    """Runs before, of and behind the first chunk whose rows cannot be made; none if all can.

    Rows are read and thrown away, twice those of the run in all; no folder is written.  The
    driver holds the chunk numbers of the run.
    """
    chunks = [tuple(r) for r in part.select(CHUNK_COLUMN, "_rows_before").orderBy(CHUNK_COLUMN).collect()]

    def run(first: int, end: int) -> tuple[int, int, int]:
        return (low if first == 0 else chunks[first][0], high if end == len(chunks) else chunks[end - 1][0], end - first)

    def broken(first: int, end: int) -> bool:
        try:
            rows_of(*run(first, end)).write.format("noop").mode("overwrite").save()
        except Exception:
            return True
        return False

    first, end = 0, len(chunks)
    if not broken(first, end):
        return []
    while end - first > 1:
        middle = (chunks[first][1] + chunks[end - 1][1]) / 2
        cut = min(max(bisect_left(chunks, middle, first, end, key=lambda c: c[1]), first + 1), end - 1)
        first, end = (first, cut) if broken(first, cut) else (cut, end)
    return [run(a, b) for a, b in ((0, first), (first, end), (end, len(chunks))) if a < b]


def _halves(part: DataFrame, low: int, high: int) -> list[tuple[int, int, int]]:
    """Bounds and numbers of chunks of two runs of about equal rows."""
    first, total = part.agg(F.min("_rows_before"), F.sum("row_count")).first()
    behind = (F.col(CHUNK_COLUMN) > low) & (2 * (F.col("_rows_before") - first) >= total)
    cut = part.agg(F.min(F.when(behind, F.col(CHUNK_COLUMN)))).first()[0] or high
    sides = part.groupBy((F.col(CHUNK_COLUMN) >= cut).alias("right")).agg(*_bounds()).orderBy("right").collect()
    return [(r["low"], r["high"], r["chunks"]) for r in sides]


def _without_done(plan: DataFrame, ledger: DataFrame, table: Table) -> DataFrame:
    """The plan with copied chunks marked SUCCESS; their ranges must be those of the plan."""
    state = L.latest_state(ledger.where(F.col("table_name") == table.name))
    done = state.where(F.col("status") == L.SUCCESS).select(
        "chunk_id", F.col("chunk_range").alias("where_clause"), F.lit(L.SUCCESS).alias("_done")
    )
    if not done.join(plan, ["chunk_id", "where_clause"], "left_anti").limit(1).isEmpty():
        raise ValueError(f"the chunks of {table.name} are not those that this run has copied; use a new run")
    marked = plan.join(done, ["chunk_id", "where_clause"], "left")
    return marked.withColumn("status", F.coalesce("_done", "status"))


def _rows_of(rows: DataFrame, chunks: DataFrame, how_many: int) -> DataFrame:
    """Rows of some chunks only, as a restart needs them."""
    chunks = F.broadcast(chunks) if how_many <= BROADCAST_CHUNKS else chunks
    return rows.join(chunks, CHUNK_COLUMN, "left_semi")


class _Placed:
    """The chunk plan of a table, and its rows by chunk.

    A key range goes down to the files as a filter.  Row numbers come from one numbering, which
    the plan and all waves read; its parts without rows of a wave are not read.
    """

    def __init__(self, source: DataFrame, table: Table, size: int):
        self.source, self.size, self.keys = source, size, table.primary_key
        strategy = choose_strategy(source.schema, self.keys)
        self.numbering, self.base = None, None
        if strategy == ROW_NUMBER or strategy == ROW_POSITION and not has_row_positions(source):
            check_size(size)
            self.numbering = Numbering(source, whole_order(source, self.keys)).settle()
            self.plan = plan_numbered_chunks(self.numbering, source, table.name, self.keys, size)
            return
        self.plan = plan_chunks(source, table.name, self.keys, size)
        if strategy == KEY_RANGE:
            key = self.keys[0]
            self.base = source.agg(F.min(key)).first()[0]
            start = F.lit(self.base).cast(source.schema[key].dataType)
            self.numbered = source.withColumn(CHUNK_COLUMN, range_number(source, key, size, start))
        else:
            self.numbered = assign_chunks(source, self.keys, size)

    def rows(self, first: int, last: int) -> DataFrame:
        """Rows of the chunks ``first`` to ``last`` with their number."""
        if self.numbering:
            return self.numbering.chunks(first, last, self.size)
        wanted = F.col(CHUNK_COLUMN).between(first, last)
        if self.base is not None and first > 0:
            key = F.col(self.keys[0])
            low, high = int(self.base) + (first - 1) * self.size, int(self.base) + last * self.size - 1
            # The last range may end beyond the key's type.
            wanted = (key >= F.lit(low)) & (key <= F.lit(high) if high < 1 << 63 else F.lit(True)) & wanted
        return self.numbered.where(wanted)

    def close(self) -> None:
        if self.numbering:
            self.numbering.delete()


def _copy_part(rows, part: DataFrame, bounds: tuple[int, int], table: Table, paths: CopyPaths, run_id: str, started) -> None:
    """Copy some chunks in one job and record them.

    The rows of a chunk are counted where they now are, in the folders of these chunks only; their
    sum must be what the write has seen.
    """
    seen = replace_partitions(rows, paths.target, CHUNK_COLUMN)
    numbers = [r[0] for r in part.select(CHUNK_COLUMN).collect()]
    stored = read_partitions(rows.sparkSession, paths.target, rows.schema, CHUNK_COLUMN, numbers)
    written = stored.where(F.col(CHUNK_COLUMN).between(*bounds)).groupBy(CHUNK_COLUMN).agg(F.count(F.lit(1)).alias("_written"))
    counted = settle(part.join(written, CHUNK_COLUMN, "left").fillna(0, "_written"))
    found = counted.agg(F.sum("_written")).first()[0]
    if found != seen:
        raise RuntimeError(f"the write of {table.name} has seen {seen} rows, the target holds {found} of them")
    status = F.when(F.col("row_count") == F.col("_written"), L.SUCCESS).otherwise(L.FAILED)
    L.append_ledger(_records(counted, table, run_id, status, started), paths.ledger)


def _record_failure(spark, problem, part, table, paths, run_id, started) -> CopyFailed:
    """Put a chunk that failed alone on record, with its error."""
    error_id, failing = f"err-{uuid.uuid4()}", part.select("chunk_id").first()[0]
    _record_error(spark, problem, error_id, table, failing, paths, run_id)
    failed = _records(part, table, run_id, L.FAILED, started, error_id, retries=1)
    L.append_ledger(failed, paths.ledger)
    return CopyFailed(error_id, table.name, failing)


def _records(chunks, table, run_id, status, started, error_id=None, retries=0) -> DataFrame:
    """Ledger records; only chunks with a written count have read and written rows."""
    none = F.lit(0).cast("bigint")
    copied = "_written" in chunks.columns
    return chunks.select(
        F.lit(run_id).alias("run_id"),
        F.lit(table.schema).alias("schema_name"),
        F.lit(table.name).alias("table_name"),
        "chunk_id",
        F.col("where_clause").alias("chunk_range"),
        (F.col("row_count") if copied else none).alias("rows_read"),
        (F.col("_written") if copied else none).alias("rows_written"),
        (F.lit(status) if isinstance(status, str) else status).alias("status"),
        F.lit(retries).alias("retry_count"),
        F.lit(started).alias("started_at"),
        F.current_timestamp().alias("completed_at"),
        F.lit(error_id).cast("string").alias("last_error_id"),
    )


def _record_error(spark, problem, error_id, table, chunk, paths, run_id) -> None:
    row = {
        "error_id": error_id,
        "run_id": run_id,
        "phase": LOAD_PHASE,
        "object_type": "TABLE",
        "object_name": table.name,
        "chunk_id": chunk,
        "sql_text": None,
        "database_code": None,
        "message": f"{type(problem).__name__}: {problem}",
        "action_category": RETRY,
        "created_at": datetime.now(UTC),
    }
    spark.createDataFrame([row], L.ERROR_SCHEMA).write.mode("append").parquet(paths.errors)
