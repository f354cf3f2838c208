"""Report rows of all kinds under one header, and the files they go to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.plans.validate import union_all

# The headers of the report files.
REPORT_COLUMNS = (
    "record_type", "name", "status", "object", "chunk", "database_code", "sql_text", "message",
)
READINESS_COLUMNS = (
    "code", "severity", "object_type", "object_name", "column_name",
    "description", "detection_method", "mitigation", "should_stop",
)
EXCLUSION_COLUMNS = ("object_type", "object_name", "status", "reason")
STRATEGY_COLUMNS = ("table_name", "chunk_id", "strategy", "column_name", "where_clause")

FINDING_SCHEMA = (
    "code string, severity string, object_name string, column_name string, "
    "description string, bad_rows bigint, should_stop boolean"
)


def findings_frame(spark: SparkSession, records: Sequence[dict]) -> DataFrame:
    return spark.createDataFrame(list(records), FINDING_SCHEMA)


def _report(df: DataFrame, record_type: str, **columns: Column) -> DataFrame:
    absent = F.lit("")
    return df.select(
        F.lit(record_type).alias("record_type"),
        *[
            F.coalesce(columns.get(c, absent).cast("string"), absent).alias(c)
            for c in REPORT_COLUMNS
            if c != "record_type"
        ],
    )


def validation_records(validations: DataFrame) -> DataFrame:
    return _report(
        validations, "VALIDATION", name=F.col("name"), status=F.col("status"),
        object=F.col("object_name"), message=F.col("message"),
    )


def error_records(errors: DataFrame) -> DataFrame:
    return _report(
        errors, "ERROR", name=F.col("phase"), status=F.col("action_category"),
        object=F.col("object_name"), chunk=F.col("chunk_id"),
        database_code=F.col("database_code"), sql_text=F.col("sql_text"), message=F.col("message"),
    )


def finding_records(findings: DataFrame) -> DataFrame:
    message = F.concat_ws(
        " | ",
        F.coalesce("description", F.lit("")),
        F.concat(F.lit("Column: "), F.coalesce("column_name", F.lit("null"))),
        F.concat(F.lit("Rows: "), F.coalesce(F.col("bad_rows").cast("string"), F.lit("null"))),
    )
    return _report(
        findings, "READINESS", name=F.col("code"), status=F.col("severity"),
        object=F.col("object_name"), message=message,
    )


def exclusion_records(decisions: DataFrame) -> DataFrame:
    return _report(
        decisions, "EXCLUSION", name=F.col("object_name"), status=F.col("status"),
        object=F.col("object_type"), message=F.col("reason"),
    )


def report_rows(
    validations: DataFrame | None = None,
    errors: DataFrame | None = None,
    findings: DataFrame | None = None,
    decisions: DataFrame | None = None,
) -> DataFrame:
    """All records under the report header; absent values are empty text."""
    parts = []
    for df, records in (
        (validations, validation_records),
        (errors, error_records),
        (findings, finding_records),
        (decisions, exclusion_records),
    ):
        if df is not None:
            parts.append(records(df))
    return union_all(parts)


def readiness_rows(findings: DataFrame) -> DataFrame:
    """Findings under the readiness header."""
    has_column = F.col("column_name").isNotNull()
    return findings.select(
        "code",
        "severity",
        F.when(has_column, "COLUMN").otherwise("TABLE").alias("object_type"),
        "object_name",
        "column_name",
        "description",
        F.concat(
            F.lit("Count rows that break the rule: "),
            F.coalesce(F.col("bad_rows").cast("string"), F.lit("none needed")),
        ).alias("detection_method"),
        F.when(F.col("should_stop"), "Correct or exclude these rows before the copy.")
        .otherwise("Review these rows.")
        .alias("mitigation"),
        "should_stop",
    )


# Quotes are doubled, and blanks around a value belong to it.
_CSV = {"header": True, "quote": '"', "escape": '"', "emptyValue": ""}
_KEEP_BLANKS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; a cell is quoted only if it must be."""
    df.write.mode("overwrite").csv(path, nullValue="", **_CSV, **_KEEP_BLANKS)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, schema=schema, multiLine=True, **_CSV, **_KEEP_BLANKS)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_report(
    folder: str,
    run_id: str,
    validations: DataFrame,
    errors: DataFrame | None = None,
    findings: DataFrame | None = None,
    decisions: DataFrame | None = None,
    plans: DataFrame | None = None,
) -> None:
    """Write the report as JSON and CSV, and readiness, exclusions and chunk strategies
    each as CSV, to folders named after the run."""
    rows = report_rows(validations, errors, findings, decisions)
    write_json(rows, f"{folder}/{run_id}-report-json")
    write_csv(rows, f"{folder}/{run_id}-report-csv")
    if findings is not None:
        write_csv(readiness_rows(findings).select(*READINESS_COLUMNS), f"{folder}/{run_id}-readiness-csv")
    if decisions is not None:
        write_csv(decisions.select(*EXCLUSION_COLUMNS), f"{folder}/{run_id}-exclusions-csv")
    if plans is not None:
        write_csv(plans.select(*STRATEGY_COLUMNS), f"{folder}/{run_id}-strategies-csv")
