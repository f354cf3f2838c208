"""Whole migrations: copy every table, then prove it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyport.functions.convert import DEFAULT_CONVERTERS, Converter
from tallyport.functions.names import target_name
from tallyport.operators.compare import FAIL, ORPHANS, TARGET_ORPHANS
from tallyport.operators.chunks import choose_strategy
from tallyport.operators.copy import CHUNK_COLUMN, CopyPaths, copy_table, prepare_rows
from tallyport.operators.keys import parent_first
from tallyport.operators.ledger import read_ledger
from tallyport.operators.quality import EXCLUDED_PARENT, excluded_parent_findings
from tallyport.plans.report import FINDING_SCHEMA, STRATEGY_COLUMNS, findings_frame, write_report
from tallyport.plans.validate import final_status, stop_flag, union_all, validate_table
from tallyport.runtime import settle
from tallyport.sources.tables import few_listers, path_exists, remove_rows
from tallyport.specs import Table

REQUIRE_EMPTY, TRUNCATE = "REQUIRE_EMPTY", "TRUNCATE_EXISTING"
#: Rows of another run are leftovers of this library's own and go.
REPLACE = TRUNCATE


@dataclass(frozen=True)
class Outcome:
    """``status`` is PASS, WARNING or FAIL; the frames are findings-sized."""

    status: str
    validations: DataFrame
    ledger: DataFrame


class StopBeforeCopy(RuntimeError):
    """A finding asks to stop; nothing was copied."""


class TargetNotEmpty(ValueError):
    """Target tables that must be empty hold rows; nothing was copied."""


def paths_for(root: str, name: str) -> CopyPaths:
    """Target folder of a table below ``root``; all tables share ledger and errors."""
    return CopyPaths(f"{root}/data/{name}", f"{root}/ledger", f"{root}/errors")


def read_target(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """The copied rows; a table of which no chunk was written is empty."""
    path = paths_for(root, name).target
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    stored = T.StructType([*schema.fields, T.StructField(CHUNK_COLUMN, T.LongType())])
    with few_listers(spark):
        return spark.read.schema(stored).parquet(path).drop(CHUNK_COLUMN)


def full_load(
    sources: Mapping[str, DataFrame],
    tables: Mapping[str, Table],
    root: str,
    run_id: str,
    chunk_size: int,
    outside_parents: Mapping[str, DataFrame] | None = None,
    findings: DataFrame | None = None,
    needs_review: DataFrame | None = None,
    row_cap: int | None = None,
    policy: str = "RENAME",
    orphan_check: str = ORPHANS,
    waves: int = 1,
    converters: Mapping[type, Converter] = DEFAULT_CONVERTERS,
    chunk_sizes: Mapping[str, int] | None = None,
    decisions: DataFrame | None = None,
    target_policy: str = REPLACE,
) -> Outcome:
    """Copy parents before children, validate each table, and write the report.

    Excluded tables are left out; ``outside_parents`` are target tables that are not
    copied but referred to.  Before any row is copied, a finding that asks to stop does so, as does a
    foreign key whose parent is excluded or not given.  The report is written whatever
    the result, with the findings, exclusions, errors and chunk strategies there are.
    By ``target_policy``, rows that another run left in a table's folder are removed first or
    forbid the run; a restart keeps its own.  ``chunk_sizes`` gives single tables a size of their own, ``waves`` and ``converters``
    go to each copy.
    """
    spark = next(iter(sources.values())).sparkSession
    included = _included(tables)
    decisions = _table_decisions(spark, tables) if decisions is None else decisions
    ledger = paths_for(root, "").ledger
    validations = None
    try:
        findings = _with_parent_findings(spark, included, sources, tables, outside_parents or {}, findings)
        if findings is not None and stop_flag(findings).first()["should_stop"]:
            raise StopBeforeCopy("a finding asks to stop; see the findings")
        edges = [key for table in included.values() for key in table.foreign_keys]
        order = parent_first(list(included), edges)
        if not _is_restart(spark, ledger, run_id):
            _clear_targets(spark, root, included, target_policy)
        for name in order:
            size = (chunk_sizes or {}).get(name, chunk_size)
            copy_table(
                sources[name], included[name], paths_for(root, name), run_id, size, row_cap, waves, policy, converters
            )

        expected = {name: prepare_rows(sources[name], policy, converters) for name in included}
        copied = {name: read_target(spark, root, name, df.schema) for name, df in expected.items()}
        parents = {**(outside_parents or {}), **copied}
        results = [
            # one table at a time: the results are a few rows, the plans are not
            settle(
                validate_table(
                    expected[name],
                    copied[name],
                    _under_target_names(table, set(included), policy),
                    parents,
                    orphan_check=orphan_check,
                )
            )
            for name, table in included.items()
        ]
        validations = union_all(results)
    except Exception as problem:
        validations = spark.createDataFrame([("run", FAIL, run_id, f"{type(problem).__name__}: {problem}")], _RESULT)
        _report(spark, root, run_id, validations, findings, decisions, sources, included)
        raise
    _report(spark, root, run_id, validations, findings, decisions, sources, included)
    status = final_status(validations, needs_review).first()["status"]
    return Outcome(status, validations, read_ledger(spark, ledger, run_id))


def _clear_targets(spark: SparkSession, root: str, included: Mapping[str, Table], policy: str) -> None:
    """Remove the rows of all targets, or refuse the run if any has some: all of them are named
    before anything is removed."""
    if policy == REQUIRE_EMPTY:
        with few_listers(spark):
            held = {n: spark.read.parquet(p) for n in included if path_exists(spark, p := paths_for(root, n).target)}
        filled = [(n, df.count()) for n, df in held.items() if not df.limit(1).isEmpty()]
        if filled:
            raise TargetNotEmpty("; ".join(f"target {n} contains {rows} rows" for n, rows in filled))
    for name in included:
        remove_rows(spark, paths_for(root, name).target)


_RESULT = "name string, status string, object_name string, message string"


def _report(spark, root, run_id, validations, findings, decisions, sources, included) -> None:
    """Write the report of a run, however far it came."""
    paths = paths_for(root, "")
    errors = None
    if path_exists(spark, paths.errors):
        errors = spark.read.parquet(paths.errors).where(F.col("run_id") == run_id)
    plans = None
    if path_exists(spark, paths.ledger):
        held = read_ledger(spark, paths.ledger, run_id)
        chosen = [
            (n, choose_strategy(sources[n].schema, t.primary_key), ", ".join(t.primary_key)) for n, t in included.items()
        ]
        known = spark.createDataFrame(chosen, "table_name string, strategy string, column_name string")
        plans = held.join(known, "table_name").withColumnRenamed("chunk_range", "where_clause")
        plans = plans.select(*STRATEGY_COLUMNS).distinct()
    write_report(f"{root}/report", run_id, validations, errors, findings, decisions, plans)


def _table_decisions(spark: SparkSession, tables: Mapping[str, Table]) -> DataFrame | None:
    """Tables that are left out, as exclusion records."""
    rows = [("TABLE", name, "EXCLUDED", "excluded by its description") for name, t in tables.items() if t.excluded]
    return spark.createDataFrame(rows, "object_type string, object_name string, status string, reason string") if rows else None


def _with_parent_findings(spark, included, sources, tables, outside, findings) -> DataFrame | None:
    """The findings, and one for each foreign key whose parent is excluded or missing.

    An excluded parent stops the run if child rows refer to it; a parent that is not given
    stops it in any case, since the key could not be checked.
    """
    fields = spark.createDataFrame([], FINDING_SCHEMA).schema.fields
    parts = []
    if findings is not None:
        given = {f.name: F.col(f.name) for f in findings.schema}
        parts.append(
            findings.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
        )
    for table in included.values():
        for key in table.foreign_keys:
            if key.parent in included or key.parent in outside:
                continue
            if key.parent in tables and key.parent in sources:
                parts.append(excluded_parent_findings(sources[table.name], sources[key.parent], key))
            else:
                record = {
                    "code": EXCLUDED_PARENT, "severity": "BLOCKER", "object_name": key.child,
                    "column_name": ", ".join(key.columns), "bad_rows": None, "should_stop": True,
                    "description": f"{key.name}: no parent table {key.parent} given",
                }
                parts.append(findings_frame(spark, [record]))
    if not parts:
        return None
    return settle(union_all([p.select(*[f.name for f in fields]) for p in parts]))


def load_existing(
    sources: Mapping[str, DataFrame],
    tables: Mapping[str, Table],
    root: str,
    run_id: str,
    chunk_size: int,
    target_policy: str = REQUIRE_EMPTY,
    **options,
) -> Outcome:
    """Load into tables that exist: they must be empty, or are truncated first.

    A run that is refused leaves its report.  A run that its ledger already knows is a restart and
    keeps what it has copied.  Foreign keys are checked by the target's own rules, MATCH FULL
    included.
    """
    if target_policy not in (REQUIRE_EMPTY, TRUNCATE):
        raise ValueError(f"unknown target policy {target_policy}")
    return full_load(
        sources, tables, root, run_id, chunk_size, orphan_check=TARGET_ORPHANS, target_policy=target_policy, **options
    )


def _included(tables: Mapping[str, Table]) -> dict[str, Table]:
    return {name: table for name, table in tables.items() if not table.excluded}


def _is_restart(spark: SparkSession, ledger: str, run_id: str) -> bool:
    return path_exists(spark, ledger) and not read_ledger(spark, ledger, run_id).limit(1).isEmpty()


def _under_target_names(table: Table, copied: set[str], policy: str) -> Table:
    def new(columns):
        return tuple(target_name(c, policy) for c in columns)

    def renamed(key):
        parent_columns = new(key.parent_columns) if key.parent in copied else key.parent_columns
        return replace(key, columns=new(key.columns), parent_columns=parent_columns)

    return replace(
        table,
        keys=tuple(replace(k, columns=new(k.columns)) for k in table.keys),
        foreign_keys=tuple(renamed(k) for k in table.foreign_keys),
        scales={target_name(c, policy): s for c, s in table.scales.items()},
    )
