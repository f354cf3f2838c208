"""Findings, exclusion flags, reports and roll-ups."""

from __future__ import annotations

import csv
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyport.catalogue.inputs import read
from tallyport.functions.text import VENDOR_SQL_PATTERNS
from tallyport.functions.types import choose_type
from tallyport.operators import quality
from tallyport.operators.quality import RequiredColumn
from tallyport.plans import report, validate
from tallyport.specs import ForeignKey, Key, Rule, Table

from .conftest import MEDIUM


def bad_rows(df):
    return {r["column_name"]: r["bad_rows"] for r in df.collect()}


def test_rules_share_one_scan_and_count_nulls_as_good(spark):
    df = spark.createDataFrame([(1,), (None,), (5,)], "a long")
    rules = [Rule("X-1", "HIGH", "a", F.col("a") > 3, True), Rule("X-2", "LOW", "a", F.col("a") > 9, True)]
    got = {r["code"]: r for r in quality.run_rules(df, "T", rules).collect()}
    assert (got["X-1"]["bad_rows"], got["X-1"]["should_stop"]) == (1, True)
    assert (got["X-2"]["bad_rows"], got["X-2"]["should_stop"]) == (0, False)
    with pytest.raises(ValueError):
        quality.run_rules(df, "T", [])


def test_type_fit_at_the_edges(spark):
    values = [(0,), (32767,), (32768,), (-32768,), (-32769,), (None,)]
    df = spark.createDataFrame(values, "n long")
    assert bad_rows(quality.type_fit(df, "T", {"n": choose_type("NUMBER", 4, 0)})) == {"n": 2}
    text = spark.createDataFrame([("12.0",), ("x",), ("1.25",), ("99999",), (None,), ("1e1",)], "t string")
    assert bad_rows(quality.type_fit(text, "T", {"t": choose_type("NUMBER", 4, 0)})) == {"t": 3}
    assert bad_rows(quality.type_fit(text, "T", {"t": choose_type("NUMBER", 4, 1)})) == {"t": 3}
    assert bad_rows(quality.type_fit(text, "T", {"t": choose_type("VARCHAR2", 4)})) == {"t": 1}


def test_decimal_fit_of_numbers(spark):
    df = spark.sql(
        "select * from values (1.25d, 1.25BD), (1.2d, 1.20BD), (12345.6d, 12345.60BD), (double('NaN'), null) as t(d, e)"
    )
    kind = choose_type("NUMBER", 4, 1)
    assert bad_rows(quality.type_fit(df, "T", {"d": kind, "e": kind})) == {"d": 3, "e": 2}


def test_blocked_type_stops(spark):
    row = quality.type_fit(spark.range(3), "T", {"id": choose_type("BFILE")}).first()
    assert (row["code"], row["severity"], row["bad_rows"], row["should_stop"]) == ("RDN-009", "BLOCKER", 3, True)


def test_survey_values(spark):
    orders = read(spark, MEDIUM, "orders")
    fit = quality.type_fit(
        orders, "orders", {"o_orderkey": choose_type("NUMBER", 4)}, {"o_orderkey": F.col("o_orderkey") * 10}
    )
    assert bad_rows(fit) == {"o_orderkey": 11723}
    documents = read(spark, MEDIUM, "documents")
    profile = quality.lob_profile(documents, "documents", ["text"]).first()
    assert (profile["longest"], profile["bad_rows"]) == (33047, 149)
    found = quality.pattern_findings(documents, "documents", "text", {"license": ["license"]}).first()
    assert found["bad_rows"] == 39


def test_profile_of_bytes_and_nulls(spark):
    df = spark.createDataFrame([(bytearray(b"abc"), "é"), (None, None), (bytearray(b""), "ab")], "b binary, s string")
    got = {r["column_name"]: r for r in quality.lob_profile(df, "T", ["b", "s"], limit=1).collect()}
    assert (got["b"]["longest"], got["b"]["null_rows"], got["b"]["bad_rows"]) == (3, 1, 1)
    assert (got["s"]["longest"], got["s"]["total_length"]) == (2, 3)
    classes = quality.lob_histogram(df, "T", ["b", "s"], (0, 2, 10))
    assert sorted(tuple(r)[1:] for r in classes.collect()) == [("b", 0, 1), ("b", 2, 1), ("s", 0, 1), ("s", 2, 1)]


REQUIRED = [
    RequiredColumn("ID", T.LongType()),
    RequiredColumn("CODE", T.StringType()),
    RequiredColumn("NOTE", T.StringType(), may_be_omitted=True),
]


def test_required_columns(spark):
    df = spark.createDataFrame([(1, "x"), (None, "y")], "id long, other string")
    assert quality.column_gaps(df, REQUIRED) == (["other"], ["CODE"])
    assert quality.conform(df, REQUIRED).columns == ["ID", "CODE", "NOTE"]
    got = quality.required_column_nulls(df, "T", REQUIRED)
    assert bad_rows(got) == {"ID": 1, "CODE": 2}
    assert validate.stop_flag(got).first()[0] is True


def test_pattern_flags(spark, rows):
    texts = [
        (1, "select * FROM\n\n  dual"), (2, "a = b(+)"), (3, "START WITH x CONNECT\tBY y"),
        (4, "sys_context('a') join   dual"), (5, "using NCHAR_CS"), (6, "select 1"), (7, None),
    ]
    df = spark.createDataFrame(texts, "id long, t string")
    got = rows(quality.pattern_flags(df, ["id"], "t", VENDOR_SQL_PATTERNS), "id", "hits", "status")
    assert got == [
        (1, "from dual", "NEEDS_REVIEW"), (2, "(+)", "NEEDS_REVIEW"), (3, "connect by", "NEEDS_REVIEW"),
        (4, "sys_context, from dual", "NEEDS_REVIEW"), (5, "nchar_cs", "NEEDS_REVIEW"),
        (6, "", "READY"), (7, "", "READY"),
    ]
    counts = {r["description"]: r["bad_rows"] for r in quality.pattern_findings(df, "v", "t", VENDOR_SQL_PATTERNS).collect()}
    assert counts == {"sys_context": 1, "connect by": 1, "from dual": 2, "(+)": 1, "nchar_cs": 1}


def test_whole_value_match(spark):
    df = spark.createDataFrame([(' "A" IS NOT NULL ',), ("x is not null and y",), ("b Is Not Null",)], "c string")
    got = quality.whole_value_findings(df, "T", {"c": r'"?\w+"? IS NOT NULL'}).first()
    assert got["bad_rows"] == 2


def test_exclusion_flags(spark, rows):
    df = spark.createDataFrame([("ATM",), ("CUSTOMERS",), (None,)], "name string")
    wanted = [("ATM", "EXCLUDED", "Excluded by configuration"), ("CUSTOMERS", "READY", None), (None, "READY", None)]
    assert rows(quality.exclusion_flags(df, "name", ["aTm"])) == wanted
    names = spark.createDataFrame([("atm",), ("ATM",)], "n string")
    assert rows(quality.exclusion_flags_by_table(df, "name", names, "n")) == wanted
    assert {r["status"] for r in quality.exclusion_flags(df, "name", []).collect()} == {"READY"}


def test_shape_findings(spark):
    df = spark.createDataFrame([("a", 1, bytearray())], "ID string, LIMIT int, DOC binary")
    found = quality.shape_findings(df, "T", ["ID"], ["LIMIT"])
    assert [(f["code"], f["column_name"]) for f in found] == [
        ("RDN-002", "ID"), ("RDN-003", "LIMIT"), ("RDN-004", "DOC"),
    ]
    assert quality.shape_findings(df.select("LIMIT"), "T", [])[0]["code"] == "RDN-005"
    frame = report.findings_frame(spark, found)
    assert report.readiness_rows(frame).columns == list(report.READINESS_COLUMNS)


# --- suites and reports ------------------------------------------------------------


def test_suite_lists_every_check(spark):
    parent = spark.range(5).withColumnRenamed("id", "pid")
    source = spark.range(10).select("id", (F.col("id") % 5).alias("fk"))
    table = Table(
        "T", keys=(Key("PK", ("id",)), Key("UK", ("fk",), "UNIQUE")),
        foreign_keys=(ForeignKey("FK", "T", ("fk",), "P", ("pid",)),),
    )
    got = {r["object_name"] + "/" + r["name"]: (r["status"], r["message"]) for r in
           validate.validate_table(source, source, table, {"P": parent}).collect()}
    assert set(got) == {
        "T/row-count", "T/checksum", "T/sample-row", "T.PK/duplicate-key", "T.UK/duplicate-key",
        "T.FK/foreign-key-orphans",
    }
    assert got["T.UK/duplicate-key"] == ("FAIL", "duplicateGroups=5")
    assert got["T.FK/foreign-key-orphans"] == ("PASS", "orphans=0")
    with pytest.raises(ValueError, match="no parent table"):
        validate.validate_table(source, source, table)


def test_suite_of_a_table_with_large_columns_only(spark):
    df = spark.createDataFrame([(bytearray(b"x"),)], "doc binary")
    got = validate.validate_table(df, df, Table("T")).collect()
    assert [(r["name"], r["status"]) for r in got] == [("row-count", "PASS")]


@pytest.mark.parametrize(
    ("statuses", "review", "wanted"),
    [
        (["PASS", "FAIL"], ["NEEDS_REVIEW"], "FAIL"),
        (["PASS", "WARNING"], [], "WARNING"),
        (["PASS"], ["NEEDS_REVIEW", "READY"], "WARNING"),
        (["PASS"], ["READY"], "PASS"),
        ([], [], "PASS"),
    ],
)
def test_final_status(spark, statuses, review, wanted):
    checks = spark.createDataFrame([(s,) for s in statuses], "status string")
    views = spark.createDataFrame([(s,) for s in review], "status string")
    assert validate.final_status(checks, views).first()["status"] == wanted


def test_no_findings_do_not_stop(spark):
    assert validate.stop_flag(spark.createDataFrame([], "should_stop boolean")).first()[0] is False


NASTY = ['plain', 'a,b', 'say "hi"', "two\nlines", "back\\slash", "cr\rhere", " padded "]


def test_report_csv_round_trip(spark, tmp_path):
    checks = spark.createDataFrame(
        [("row-count", "PASS", f"T{i}", text) for i, text in enumerate(NASTY)],
        "name string, status string, object_name string, message string",
    )
    errors = spark.createDataFrame(
        [("data-load", "RETRY_OR_MANUAL_REVIEW", "T", "T-000001", None, "select 1, 2", "boom")],
        "phase string, action_category string, object_name string, chunk_id string, database_code string, "
        "sql_text string, message string",
    )
    decisions = spark.createDataFrame(
        [("TABLE", "ATM", "EXCLUDED", "Excluded by configuration")],
        "object_type string, object_name string, status string, reason string",
    )
    findings = report.findings_frame(spark, quality.shape_findings(spark.range(1), "T", []))
    plans = spark.createDataFrame(
        [("T", "T-000001", "ROWID", "ROWID", "row_no >= 1 and row_no <= 5")],
        "table_name string, chunk_id string, strategy string, column_name string, where_clause string",
    )
    report.write_report(str(tmp_path), "run-1", checks, errors, findings, decisions, plans)
    lines = []
    for part in sorted((tmp_path / "run-1-report-csv").glob("*.csv")):
        with open(part, newline="") as handle:
            content = list(csv.reader(handle))
        if content:
            assert tuple(content[0]) == report.REPORT_COLUMNS
            lines += content[1:]
    by_type = {}
    for line in lines:
        by_type.setdefault(line[0], []).append(line)
    assert sorted(line[-1] for line in by_type["VALIDATION"]) == sorted(NASTY)
    assert by_type["ERROR"] == [
        ["ERROR", "data-load", "RETRY_OR_MANUAL_REVIEW", "T", "T-000001", "", "select 1, 2", "boom"]
    ]
    assert by_type["EXCLUSION"][0][1:4] == ["ATM", "EXCLUDED", "TABLE"]
    assert by_type["READINESS"][0][1:3] == ["RDN-005", "MEDIUM"]
    records = [
        json.loads(line)
        for part in (tmp_path / "run-1-report-json").glob("*.json")
        for line in part.read_text().splitlines()
    ]
    assert sorted(r["message"] for r in records if r["record_type"] == "VALIDATION") == sorted(NASTY)
    schema = ", ".join(f"{c} string" for c in report.STRATEGY_COLUMNS)
    back = report.read_csv(spark, str(tmp_path / "run-1-strategies-csv"), schema)
    assert tuple(back.first()) == tuple(plans.first())
    for kind in ("readiness", "exclusions"):
        assert list((tmp_path / f"run-1-{kind}-csv").glob("*.csv"))
