"""Data-quality findings, measured on rows.

Every check emits the same columns: ``code, severity, object_name, column_name,
bad_rows, should_stop``.  All rules over a table share one scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyport.functions.canon import split_columns
from tallyport.functions.convert import exact_integer
from tallyport.functions.text import pattern_tests, whole_value_matches
from tallyport.functions.types import BLOCKED, REVIEW, TypeChoice
from tallyport.operators.keys import excluded_parent_impact
from tallyport.specs import ForeignKey, Rule

# Severities, most severe first, and the finding codes used here.
SEVERITIES = ("BLOCKER", "HIGH", "MEDIUM", "LOW")
CHARACTER_KEY = "RDN-002"
RESERVED_NAME = "RDN-003"
LARGE_VALUE = "RDN-004"
NO_KEY = "RDN-005"
TEXT_PATTERN = "RDN-007"
EXCLUDED_PARENT = "RDN-008"
BLOCKED_TYPE = "RDN-009"
RISKY_TYPE = "RDN-010"
REQUIRED_COLUMN = "REQUIRED-COLUMN"

# Status texts of rows and items.
READY, NEEDS_REVIEW, EXCLUDED = "READY", "NEEDS_REVIEW", "EXCLUDED"
EXCLUDED_REASON = "Excluded by configuration"

TEXT_LIMIT = 4000
LENGTH_STEPS = (0, 100, 1_000, 4_000, 10_000, 100_000, 1_000_000)


def run_rules(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break each rule, one finding row per rule, from a single aggregation."""
    if not rules:
        raise ValueError("no rules given")
    counts = df.agg(*[F.count_if(F.coalesce(r.bad, F.lit(False))).alias(f"_{i}") for i, r in enumerate(rules)])
    rows = [
        F.struct(
            F.lit(rule.code).alias("code"),
            F.lit(rule.severity).alias("severity"),
            F.lit(table).alias("object_name"),
            F.lit(rule.column).alias("column_name"),
            F.lit(rule.description).alias("description"),
            F.col(f"_{i}").alias("bad_rows"),
            (F.lit(rule.should_stop) & (F.col(f"_{i}") > 0)).alias("should_stop"),
        )
        for i, rule in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*rows)))


# --- type fit ----------------------------------------------------------------------


def misfit(value: Column, source: T.DataType, target: T.DataType, max_length: int | None = None) -> Column:
    """True where a value of the source type is lost or changed by the target type."""
    if isinstance(target, T.StringType):
        return F.length(value.cast("string")) > max_length if max_length is not None else F.lit(False)
    if isinstance(target, T.IntegralType):
        return value.isNotNull() & exact_integer(value, source, target).isNull()
    fitted = value.try_cast(target)
    lost = value.isNotNull() & fitted.isNull()
    if isinstance(target, T.DecimalType):
        # A cast rounds silently; digits behind the scale count as a misfit.
        if isinstance(source, (T.DecimalType, T.IntegralType)):
            return lost | ~value.eqNullSafe(fitted)
        if isinstance(source, (T.FloatType, T.DoubleType)):
            return lost | ~value.eqNullSafe(fitted.cast(source))
        full = F.trim(value.cast("string")).try_cast("decimal(38,18)")
        return lost | (full.isNotNull() & ~full.eqNullSafe(fitted.cast("decimal(38,18)")))
    return lost


def type_fit(
    df: DataFrame, table: str, choices: Mapping[str, TypeChoice], columns: Mapping[str, Column] | None = None
) -> DataFrame:
    """Rows that the type chosen for each column cannot hold.  ``columns`` gives the value
    to test where it is not the column of that name."""
    values = df.select(*[(columns or {}).get(name, F.col(name)).alias(name) for name in choices])
    rules = []
    for name, choice in choices.items():
        value = F.col(name)
        if choice.risk == BLOCKED:
            rules.append(Rule(BLOCKED_TYPE, "BLOCKER", name, value.isNotNull(), True, choice.note))
            continue
        severity = "HIGH" if choice.risk == REVIEW and isinstance(choice.type, T.StringType) else "MEDIUM"
        what = choice.type.simpleString() if choice.max_length is None else f"varchar({choice.max_length})"
        bad = misfit(value, values.schema[name].dataType, choice.type, choice.max_length)
        rules.append(Rule(RISKY_TYPE, severity, name, bad, False, what))
    return run_rules(values, table, rules)


# --- large values ------------------------------------------------------------------


def lob_profile(df: DataFrame, table: str, columns: Sequence[str], limit: int = TEXT_LIMIT) -> DataFrame:
    """Per column: rows, nulls, longest value and values above the limit, in one scan.

    Text is measured in characters and bytes in bytes.
    """
    aggregates = [F.count(F.lit(1)).alias("_rows")]
    for i, name in enumerate(columns):
        size = F.length(name)
        aggregates += [
            F.count(name).alias(f"_set{i}"),
            F.max(size).cast("bigint").alias(f"_max{i}"),
            F.sum(size.cast("bigint")).alias(f"_sum{i}"),
            F.count_if(size > limit).alias(f"_over{i}"),
        ]
    rows = [
        F.struct(
            F.lit(LARGE_VALUE).alias("code"),
            F.lit("MEDIUM").alias("severity"),
            F.lit(table).alias("object_name"),
            F.lit(name).alias("column_name"),
            F.col("_rows").alias("row_count"),
            (F.col("_rows") - F.col(f"_set{i}")).alias("null_rows"),
            F.col(f"_max{i}").alias("longest"),
            F.col(f"_sum{i}").alias("total_length"),
            F.col(f"_over{i}").alias("bad_rows"),
            F.lit(False).alias("should_stop"),
        )
        for i, name in enumerate(columns)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def lob_histogram(
    df: DataFrame, table: str, columns: Sequence[str], steps: Sequence[int] = LENGTH_STEPS
) -> DataFrame:
    """Values per size class; a class runs from ``from_length`` to below the next step."""
    sizes = F.array(*[F.struct(F.lit(c).alias("column_name"), F.length(c).alias("_size")) for c in columns])
    low = F.lit(steps[-1])
    for lower, upper in reversed(list(pairwise(steps))):
        low = F.when(F.col("_size") < upper, F.lit(lower)).otherwise(low)
    return (
        df.select(F.inline(sizes))
        .where(F.col("_size").isNotNull())
        .groupBy("column_name", low.cast("bigint").alias("from_length"))
        .agg(F.count(F.lit(1)).alias("value_count"))
        .select(F.lit(table).alias("object_name"), "*")
    )


# --- required columns --------------------------------------------------------------


@dataclass(frozen=True)
class RequiredColumn:
    """A column of the target; ``may_be_omitted`` if it is nullable or fills itself."""

    name: str
    type: T.DataType
    may_be_omitted: bool = False


def column_gaps(df: DataFrame, required: Sequence[RequiredColumn]) -> tuple[list[str], list[str]]:
    """Columns of the source that the target lacks, and columns that the target requires
    and the source lacks.  Names are compared in any letter case."""
    have = {c.lower() for c in df.columns}
    want = {c.name.lower() for c in required}
    missing = [c for c in df.columns if c.lower() not in want]
    extra = [c.name for c in required if c.name.lower() not in have and not c.may_be_omitted]
    return missing, extra


def conform(df: DataFrame, required: Sequence[RequiredColumn]) -> DataFrame:
    """The rows in the target's columns and types; absent columns are null."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(have[c.name.lower()]) if c.name.lower() in have else F.lit(None))
            .try_cast(c.type)
            .alias(c.name)
            for c in required
        ]
    )


def required_column_nulls(df: DataFrame, table: str, required: Sequence[RequiredColumn]) -> DataFrame:
    """Rows that would break each NOT NULL column of the target."""
    rules = [
        Rule(REQUIRED_COLUMN, "BLOCKER", c.name, F.col(c.name).isNull(), True, "null in a required column")
        for c in required
        if not c.may_be_omitted
    ]
    return run_rules(conform(df, required), table, rules)


# --- text patterns -----------------------------------------------------------------


def pattern_flags(
    df: DataFrame, keys: Sequence[str], text: str, patterns: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Per row the names of the patterns found, after lower-casing and collapsing white
    space, and NEEDS_REVIEW where there is any."""
    tests = pattern_tests(F.col("_lower"), patterns)
    found = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests.items()]))
    return (
        df.select(*keys, F.lower(text).alias("_lower"))
        .select(*keys, found.alias("_hits"))
        .select(
            *keys,
            F.size("_hits").cast("bigint").alias("hit_count"),
            F.array_join("_hits", ", ").alias("hits"),
            F.when(F.size("_hits") > 0, NEEDS_REVIEW).otherwise(READY).alias("status"),
        )
    )


def pattern_findings(df: DataFrame, table: str, text: str, patterns: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows per pattern, as findings; one scan, and each text is lower-cased once."""
    tests = pattern_tests(F.col("_lower"), patterns)
    rules = [Rule(TEXT_PATTERN, "HIGH", text, test, False, name) for name, test in tests.items()]
    return run_rules(df.select(F.lower(text).alias("_lower")), table, rules)


def whole_value_findings(
    df: DataFrame, table: str, patterns: Mapping[str, str], severity: str = "LOW"
) -> DataFrame:
    """Rows whose trimmed value as a whole matches a regular expression, per column."""
    rules = [
        Rule(TEXT_PATTERN, severity, column, whole_value_matches(F.col(column), regex), False, regex)
        for column, regex in patterns.items()
    ]
    return run_rules(df, table, rules)


# --- exclusion flags ---------------------------------------------------------------


def exclusion_flags(df: DataFrame, name: str, excluded: Sequence[str], ready: str = READY) -> DataFrame:
    """Keep every row and add ``status`` and ``reason``; names match in any letter case.

    ``excluded`` is the caller's configured list.  For a list that is itself a table, use
    :func:`exclusion_flags_by_table`.
    """
    hit = F.lower(name).isin(sorted({e.lower() for e in excluded})) if excluded else F.lit(False)
    return _flagged(df, F.coalesce(hit, F.lit(False)), ready)


def exclusion_flags_by_table(
    df: DataFrame, name: str, excluded: DataFrame, excluded_name: str, ready: str = READY
) -> DataFrame:
    """As :func:`exclusion_flags`, by a join with a table of names of any size."""
    names = excluded.select(F.lower(excluded_name).alias("_name")).distinct().withColumn("_hit", F.lit(True))
    joined = df.withColumn("_name", F.lower(name)).join(names, "_name", "left")
    return _flagged(joined, F.col("_hit").isNotNull(), ready).drop("_name", "_hit")


def _flagged(df: DataFrame, hit: Column, ready: str) -> DataFrame:
    return df.withColumn("status", F.when(hit, EXCLUDED).otherwise(ready)).withColumn(
        "reason", F.when(hit, EXCLUDED_REASON)
    )


def excluded_parent_findings(child: DataFrame, excluded_parents: DataFrame, key: ForeignKey) -> DataFrame:
    """Child rows that refer to an excluded parent, as a finding that stops the run."""
    impact = excluded_parent_impact(child, excluded_parents, key.columns, key.parent_columns)
    return impact.agg(F.coalesce(F.sum("child_rows"), F.lit(0)).alias("bad_rows")).select(
        F.lit(EXCLUDED_PARENT).alias("code"),
        F.lit("BLOCKER").alias("severity"),
        F.lit(key.child).alias("object_name"),
        F.lit(", ".join(key.columns)).alias("column_name"),
        F.lit(f"{key.name} refers to excluded rows of {key.parent}").alias("description"),
        "bad_rows",
        (F.col("bad_rows") > 0).alias("should_stop"),
    )


# --- findings from the shape of a table --------------------------------------------


def shape_findings(df: DataFrame, table: str, keys: Sequence[str], reserved: Sequence[str] = ()) -> list[dict]:
    """Findings that need no rows: no key, character key columns, reserved names and large
    columns.  A handful of plain records for :func:`tallyport.plans.report.findings_frame`."""
    found = []

    def add(code, severity, column, text):
        found.append(
            {"code": code, "severity": severity, "object_name": table, "column_name": column,
             "description": text, "bad_rows": None, "should_stop": False}
        )

    if not keys:
        add(NO_KEY, "MEDIUM", None, "no primary key")
    for key in keys:
        if isinstance(df.schema[key].dataType, T.StringType):
            add(CHARACTER_KEY, "HIGH", key, "character key column")
    for name in df.columns:
        if name.upper() in {w.upper() for w in reserved}:
            add(RESERVED_NAME, "HIGH", name, "reserved word as column name")
    for name in split_columns(df.schema)[1]:
        add(LARGE_VALUE, "MEDIUM", name, "large column")
    return found
