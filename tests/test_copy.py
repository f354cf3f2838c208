"""Copies, ledger, restarts, and whole migrations."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tallyport.operators import copy as copying
from tallyport.operators import ledger as L
from tallyport.operators.copy import CopyFailed, CopyPaths, copy_table, prepare_rows
from tallyport.plans import migrate
from tallyport.sources import jdbc
from tallyport.sources.tables import (
    append_rows,
    path_exists,
    read_partitions,
    replace_partitions,
    replace_rows,
    require_empty,
    table_row_counts,
)
from tallyport.specs import ForeignKey, Key, Table

ACCOUNT = Table("ACCOUNT", "SALES", (Key("PK_ACCOUNT", ("ID",)),))


@pytest.fixture
def paths(tmp_path):
    return CopyPaths(*(str(tmp_path / part) for part in ("data", "ledger", "errors")))


def accounts(spark, n=100):
    return spark.range(1, n + 1).select(F.col("id").alias("ID"), F.format_string("A%03d", "id").alias("LIMIT"))


def states(ledger):
    state = L.latest_state(ledger)
    return sorted((r["chunk_id"], r["rows_read"], r["rows_written"], r["status"]) for r in state.collect())


def test_copy_renames_and_records(spark, rows, paths):
    ledger = copy_table(accounts(spark), ACCOUNT, paths, "run-1", 40)
    assert states(ledger) == [
        ("ACCOUNT-000001", 40, 40, "SUCCESS"), ("ACCOUNT-000002", 40, 40, "SUCCESS"),
        ("ACCOUNT-000003", 20, 20, "SUCCESS"),
    ]
    row = ledger.orderBy("chunk_id").first()
    assert (row["run_id"], row["schema_name"], row["chunk_range"]) == ("run-1", "SALES", "ID >= 1 and ID <= 40")
    assert row["retry_count"] == 0 and row["last_error_id"] is None and row["started_at"] <= row["completed_at"]
    copied = spark.read.parquet(paths.target)
    assert set(copied.columns) == {"id", "limit_", "chunk_no"}
    assert rows(copied, "id", "limit_") == rows(accounts(spark))


def test_second_run_copies_nothing_and_doubles_nothing(spark, paths):
    copy_table(accounts(spark), ACCOUNT, paths, "run-1", 40)
    again = copy_table(accounts(spark), ACCOUNT, paths, "run-1", 40)
    assert again.count() == 3
    assert spark.read.parquet(paths.target).count() == 100


def test_restart_copies_what_is_missing(spark, paths):
    """One chunk has failed and another was never tried; the rest stays as it is."""
    first = copy_table(accounts(spark), ACCOUNT, paths, "run-1", 10)
    kept = first.where("chunk_id not in ('ACCOUNT-000004', 'ACCOUNT-000007')").collect()
    other = CopyPaths(paths.target + "2", paths.ledger + "2", paths.errors)
    L.append_ledger(spark.createDataFrame(kept, L.LEDGER_SCHEMA), other.ledger)
    failed = first.where("chunk_id = 'ACCOUNT-000004'").withColumn("status", F.lit("FAILED")).collect()
    L.append_ledger(spark.createDataFrame(failed, L.LEDGER_SCHEMA), other.ledger)
    ledger = copy_table(accounts(spark), ACCOUNT, other, "run-1", 10)
    assert {s for *_, s in states(ledger)} == {"SUCCESS"}
    assert spark.read.parquet(other.target).select("chunk_no").distinct().count() == 2
    assert spark.read.parquet(other.target).count() == 20


def test_restart_with_other_chunks_is_refused(spark, paths):
    copy_table(accounts(spark), ACCOUNT, paths, "run-1", 40)
    with pytest.raises(ValueError, match="use a new run"):
        copy_table(accounts(spark), ACCOUNT, paths, "run-1", 25)
    more = accounts(spark).unionByName(spark.sql("select -5L as ID, 'x' as LIMIT"))
    with pytest.raises(ValueError, match="use a new run"):
        copy_table(more, ACCOUNT, paths, "run-1", 40)
    assert spark.read.parquet(paths.target).count() == 100


def test_equal_keys_are_cut_at_the_same_rows_in_any_order(spark):
    df = spark.range(60).select((F.col("id") % 2).cast("string").alias("k"), "id", (F.col("id") % 5).alias("v"))
    table = Table("T", keys=(Key("pk", ("k",)),))
    cuts = [
        {(r["id"], r["chunk_no"]) for r in copying.chunked_rows(part, table, 13).collect()}
        for part in (df, df.orderBy(F.desc("id")).coalesce(1))
    ]
    assert cuts[0] == cuts[1]


@pytest.mark.parametrize("waves", [1, 3, 50])
def test_waves_copy_every_row_once(spark, paths, waves):
    ledger = copy_table(accounts(spark), ACCOUNT, paths, "run-1", 15, waves=waves)
    assert sum(r["rows_written"] for r in ledger.collect()) == 100
    assert spark.read.parquet(paths.target).agg(F.count_distinct("id"), F.count("id")).first() == (100, 100)


def test_row_cap_skips_and_a_later_run_goes_on(spark, paths):
    ledger = copy_table(accounts(spark), ACCOUNT, paths, "run-1", 10, row_cap=35)
    assert [s for *_, s in states(ledger)] == ["SUCCESS"] * 4 + ["SKIPPED"] * 6
    assert spark.read.parquet(paths.target).count() == 40
    ledger = copy_table(accounts(spark), ACCOUNT, paths, "run-1", 10)
    assert {s for *_, s in states(ledger)} == {"SUCCESS"}
    assert spark.read.parquet(paths.target).count() == 100


def test_failure_is_recorded_and_raised(spark, paths):
    bad = accounts(spark).withColumn("LIMIT", F.when(F.col("ID") == 77, F.raise_error(F.lit("broken row"))))
    with pytest.raises(CopyFailed):
        copy_table(bad, ACCOUNT, paths, "run-1", 10, waves=5)
    got = states(L.read_ledger(spark, paths.ledger, "run-1"))
    assert [s for *_, s in got] == ["SUCCESS"] * 7 + ["FAILED"]
    assert got[-1][1:3] == (0, 0)
    error = spark.read.parquet(paths.errors).first()
    assert (error["phase"], error["object_name"], error["chunk_id"]) == ("data-load", "ACCOUNT", "ACCOUNT-000008")
    assert "broken row" in error["message"]
    assert error["action_category"] == "RETRY_OR_MANUAL_REVIEW"
    failed = L.read_ledger(spark, paths.ledger, "run-1").where("status = 'FAILED'").first()
    assert failed["last_error_id"] == error["error_id"] and failed["retry_count"] == 1
    copy_table(accounts(spark), ACCOUNT, paths, "run-1", 10, waves=5)
    assert spark.read.parquet(paths.target).count() == 100


@pytest.mark.parametrize("bad", [[1], [55, 71, 93]])
def test_bad_rows_cost_their_own_chunks_only(spark, paths, bad):
    """One wave; the copy goes on behind bad chunks as long as it may."""
    broken = F.when(F.col("ID").isin(bad), F.raise_error(F.lit("broken row")))
    source = accounts(spark).withColumn("LIMIT", F.coalesce(broken.cast("string"), "LIMIT"))
    with pytest.raises(CopyFailed, match=f"chunk ACCOUNT-{(bad[0] - 1) // 10 + 1:06d}"):
        copy_table(source, ACCOUNT, paths, "run-1", 10, most_failures=9)
    ledger = L.read_ledger(spark, paths.ledger, "run-1")
    failed = [f"ACCOUNT-{(b - 1) // 10 + 1:06d}" for b in bad]
    assert [c for c, *_, s in states(ledger) if s == "FAILED"] == failed and ledger.count() == 10
    assert sorted(r["chunk_id"] for r in spark.read.parquet(paths.errors).collect()) == failed
    copy_table(accounts(spark), ACCOUNT, paths, "run-1", 10)
    records = L.read_ledger(spark, paths.ledger, "run-1").where("status = 'SUCCESS'")
    assert records.count() == 10 and spark.read.parquet(paths.target).count() == 100


def test_a_broken_chunk_is_found_without_writing(spark, paths, monkeypatch):
    """One wave of 20 chunks: it, the chunks before, the broken one and those behind are written, and
    each reads back its own folders only."""
    written, listed = [], []
    write, read = copying.replace_partitions, copying.read_partitions

    def seen(spark, path, schema, partition, values):
        found = read(spark, path, schema, partition, values)
        listed.append((len(values), len(found.inputFiles())))
        return found

    monkeypatch.setattr(copying, "replace_partitions", lambda *a: written.append(1) or write(*a))
    monkeypatch.setattr(copying, "read_partitions", seen)
    broken = F.when(F.col("ID") == 77, F.raise_error(F.lit("broken row")))
    with pytest.raises(CopyFailed):
        copy_table(accounts(spark).withColumn("LIMIT", broken), ACCOUNT, paths, "run-1", 5, most_failures=2)
    got = states(L.read_ledger(spark, paths.ledger, "run-1"))
    assert [s for *_, s in got] == ["SUCCESS"] * 15 + ["FAILED"] + ["SUCCESS"] * 4
    assert len(written) == 4 and [n for n, _ in listed] == [15, 4]
    assert all(files == folders for folders, files in listed)


def test_a_failing_write_is_halved(spark, paths, monkeypatch):
    """All rows can be made, but the write of one chunk fails."""
    write = copying.replace_partitions

    def refuse(rows, *a):
        if not rows.where("ID = 77").isEmpty():
            raise OSError("disk is full")
        return write(rows, *a)

    monkeypatch.setattr(copying, "replace_partitions", refuse)
    with pytest.raises(CopyFailed):
        copy_table(accounts(spark), ACCOUNT, paths, "run-1", 5, most_failures=2)
    got = states(L.read_ledger(spark, paths.ledger, "run-1"))
    assert [s for *_, s in got] == ["SUCCESS"] * 15 + ["FAILED"] + ["SUCCESS"] * 4


def test_a_missing_folder_has_no_rows(spark, tmp_path):
    path = f"{tmp_path}/parts"
    df = spark.range(6).withColumn("p", F.col("id") % 3)
    replace_partitions(df, path, "p")
    found = read_partitions(spark, path, df.schema, "p", [1, 7]).where(F.col("p").isin(1, 7))
    assert sorted(tuple(r) for r in found.collect()) == [(1, 1), (4, 1)]


def test_waves_hold_equal_rows_of_a_sparse_key(spark, paths):
    """Nearly all keys lie at the end of their span; three waves take a third of the rows each."""
    keys = [1, *range(1_000_000, 1_000_090)]
    df = spark.createDataFrame([(k,) for k in keys], "ID long")
    ledger = copy_table(df, ACCOUNT, paths, "run-1", 10, waves=3)
    waves = [r["n"] for r in ledger.groupBy("started_at").agg(F.sum("rows_written").alias("n")).collect()]
    assert len(waves) == 3 and sum(waves) == 91 and max(waves) - min(waves) <= 10


def test_counts_of_the_write_and_of_the_target_must_agree(spark, paths, monkeypatch):
    write = copying.replace_partitions
    monkeypatch.setattr(copying, "replace_partitions", lambda *a: write(*a) + 1)
    with pytest.raises(CopyFailed):
        copy_table(accounts(spark, 20), ACCOUNT, paths, "run-1", 10)
    error = spark.read.parquet(paths.errors).first()
    assert "has seen 11 rows, the target holds 10" in error["message"]


def test_plan_and_waves_read_one_numbering(spark, paths, tmp_path, monkeypatch):
    made, read = [], []
    path = f"{tmp_path}/source"
    spark.range(200).select(F.format_string("K%03d", F.col("id") * 7 % 200).alias("NAME"), "id").write.parquet(path)
    init, rows = copying.Numbering.__init__, copying.Numbering.rows
    monkeypatch.setattr(copying.Numbering, "__init__", lambda self, *a, **k: made.append(self) or init(self, *a, **k))

    def counted(self, first=None, last=None):
        found = rows(self, first, last)
        plan = found._jdf.queryExecution().executedPlan().toString()
        pruned = re.search(r"PartitionFilters: \[[^]]*_part#\d+L (?:= \d+|IN \(([\d,]*)\))", plan)
        read.append((first, last, len((pruned[1] or "0").split(",")) if pruned else None))
        return found

    monkeypatch.setattr(copying.Numbering, "rows", counted)
    table = Table("T", keys=(Key("pk", ("NAME",)),))
    ledger = copy_table(spark.read.parquet(path), table, paths, "run-1", 25, waves=4)
    assert {s for *_, s in states(ledger)} == {"SUCCESS"} and spark.read.parquet(paths.target).count() == 200
    copied = spark.read.parquet(paths.target).groupBy("chunk_no").agg(F.min("name"), F.max("name")).orderBy("chunk_no").collect()
    assert [tuple(r) for r in copied] == [(i + 1, f"K{25 * i:03d}", f"K{25 * i + 24:03d}") for i in range(8)]
    assert len(made) == 1
    assert [r[:2] for r in read] == [(None, None), (1, 50), (51, 100), (101, 150), (151, 200)]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert all(n is not None and n < parts for *_, n in read[1:]), "a wave reads the parts that hold its rows"
    assert not path_exists(spark, made[0].folder)


def test_composite_and_missing_keys(spark, rows, paths, tmp_path):
    df = spark.range(50).select((F.col("id") % 7).cast("string").alias("TENANT"), "id")
    composite = Table("EDGE", keys=(Key("pk", ("TENANT", "id")),))
    ledger = copy_table(df, composite, paths, "run-1", 20)
    assert [r[1:] for r in states(ledger)] == [(20, 20, "SUCCESS"), (20, 20, "SUCCESS"), (10, 10, "SUCCESS")]
    source = str(tmp_path / "log")
    df.drop("id").write.parquet(source)
    other = CopyPaths(paths.target + "2", paths.ledger + "2", paths.errors)
    ledger = copy_table(spark.read.parquet(source), Table("LOG"), other, "run-1", 30, waves=2)
    assert [r[1:] for r in states(ledger)] == [(30, 30, "SUCCESS"), (20, 20, "SUCCESS")]
    assert rows(spark.read.parquet(other.target), "tenant") == rows(df, "TENANT")


def test_null_keys_have_their_own_chunk(spark, paths):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c")], "ID long, V string")
    ledger = copy_table(df, ACCOUNT, paths, "run-1", 10)
    assert states(ledger) == [("ACCOUNT-000000", 2, 2, "SUCCESS"), ("ACCOUNT-000001", 1, 1, "SUCCESS")]


def test_empty_table(spark, paths):
    assert copy_table(accounts(spark, 0), ACCOUNT, paths, "run-1", 10).count() == 0


def test_large_values_and_conversions(spark, paths):
    df = spark.sql(
        "select 1L as ID, repeat('é', 100000) as MY_CLOB, cast(repeat('x', 5000) as binary) as MY_BLOB, "
        "cast(null as binary) as NO_BLOB, interval '3' month as SPAN, date'2024-02-29' as DAY"
    )
    copy_table(df, ACCOUNT, paths, "run-1", 10)
    row = spark.read.parquet(paths.target).first()
    assert (len(row["my_clob"]), len(row["my_blob"]), row["no_blob"]) == (100000, 5000, None)
    assert row["span"] == "INTERVAL '3' MONTH"
    assert row["day"] == dt.datetime(2024, 2, 29)


def test_chunk_column_must_be_free(spark, paths):
    with pytest.raises(ValueError, match="chunk_no"):
        copy_table(accounts(spark).withColumnRenamed("LIMIT", "CHUNK_NO"), ACCOUNT, paths, "r", 10)


# --- ledger ------------------------------------------------------------------------


def record(chunk, status, minute, rows_read=0, error=None, chunk_range="first"):
    at = dt.datetime(2024, 1, 1, 0, minute, tzinfo=dt.UTC)
    return ("run-1", "SALES", "ACCOUNT", chunk, chunk_range, rows_read, rows_read, status, 0, at, at, error)


def test_latest_state_updates_but_keeps_what_was_first(spark):
    data = [
        record("C1", "FAILED", 1, 0, "err-1"),
        record("C1", "SUCCESS", 9, 40, None, "second"),
        record("C2", "FAILED", 3, 0, "err-2"),
    ]
    ledger = spark.createDataFrame(data, L.LEDGER_SCHEMA)
    got = {r["chunk_id"]: r for r in L.latest_state(ledger).collect()}
    assert (got["C1"]["status"], got["C1"]["rows_read"], got["C1"]["last_error_id"]) == ("SUCCESS", 40, None)
    assert got["C1"]["chunk_range"] == "first"
    assert got["C1"]["started_at"].minute == 1 and got["C1"]["completed_at"].minute == 9
    assert got["C2"]["last_error_id"] == "err-2"
    plan = spark.createDataFrame([("ACCOUNT", f"C{i}") for i in (1, 2, 3)], "table_name string, chunk_id string")
    pending = L.pending_chunks(plan, L.latest_state(ledger))
    assert sorted(r["chunk_id"] for r in pending.collect()) == ["C2", "C3"]


# --- sinks -------------------------------------------------------------------------


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    require_empty(spark, path)
    append_rows(spark.range(3), path)
    append_rows(spark.range(2), path)
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(ValueError, match="contains 5 rows"):
        require_empty(spark, path)
    replace_rows(spark.range(4), path)
    assert spark.read.parquet(path).count() == 4
    counts = table_row_counts({"full": spark.read.parquet(path), "none": spark.range(0)})
    assert sorted(tuple(r) for r in counts.collect()) == [("full", 4, False), ("none", 0, True)]


def test_jdbc_needs_predicates(spark):
    with pytest.raises(ValueError, match="no chunk predicates"):
        jdbc.read_chunks(spark, "jdbc:none", "t", [])


# --- migrations --------------------------------------------------------------------


def shop(spark):
    sources = {
        "CUSTOMER": spark.range(1, 21).select(F.col("id").alias("ID"), F.lit("x").alias("USER")),
        "ACCOUNT": spark.range(1, 51).select(
            F.col("id").alias("ID"), (F.col("id") % 20 + 1).alias("CUSTOMER_ID"), (F.col("id") / 4).alias("BALANCE")
        ),
    }
    key = ForeignKey("FK_CUSTOMER", "ACCOUNT", ("CUSTOMER_ID",), "CUSTOMER", ("ID",))
    tables = {
        "ACCOUNT": Table("ACCOUNT", "SALES", (Key("PK_ACCOUNT", ("ID",)),), (key,), {"BALANCE": 2}),
        "CUSTOMER": Table("CUSTOMER", "SALES", (Key("PK_CUSTOMER", ("ID",)),)),
    }
    return sources, tables


def test_full_load_passes_and_reports(spark, tmp_path):
    sources, tables = shop(spark)
    outcome = migrate.full_load(sources, tables, str(tmp_path), "run-1", 20)
    assert outcome.status == "PASS"
    got = sorted((r["name"], r["object_name"], r["status"]) for r in outcome.validations.collect())
    assert got == sorted(
        [(n, t, "PASS") for n in ("row-count", "checksum", "sample-row") for t in ("ACCOUNT", "CUSTOMER")]
        + [("duplicate-key", "ACCOUNT.PK_ACCOUNT", "PASS"), ("duplicate-key", "CUSTOMER.PK_CUSTOMER", "PASS")]
        + [("foreign-key-orphans", "ACCOUNT.FK_CUSTOMER", "PASS")]
    )
    assert outcome.ledger.count() == 4
    assert path_exists(spark, f"{tmp_path}/report/run-1-report-csv")


def test_full_load_with_a_cap_fails_validation(spark, tmp_path):
    sources, tables = shop(spark)
    assert migrate.full_load(sources, tables, str(tmp_path), "run-1", 20, row_cap=5).status == "FAIL"


def test_review_makes_a_warning_and_a_stop_prevents_the_copy(spark, tmp_path):
    sources, tables = shop(spark)
    review = spark.createDataFrame([("NEEDS_REVIEW",)], "status string")
    assert migrate.full_load(sources, tables, f"{tmp_path}/a", "r", 50, needs_review=review).status == "WARNING"
    stop = spark.createDataFrame([("RDN-008", True)], "code string, should_stop boolean")
    with pytest.raises(migrate.StopBeforeCopy):
        migrate.full_load(sources, tables, f"{tmp_path}/b", "r", 50, findings=stop)
    assert not path_exists(spark, f"{tmp_path}/b/data")


def test_load_into_existing_tables(spark, tmp_path):
    sources, tables = shop(spark)
    root = str(tmp_path)
    full = {**sources}
    full["ACCOUNT"] = sources["ACCOUNT"].withColumn(
        "CUSTOMER_ID", F.when(F.col("ID") < 3, 99).otherwise(F.col("CUSTOMER_ID"))
    )
    outcome = migrate.load_existing(full, tables, root, "run-1", 20)
    assert outcome.status == "FAIL"
    orphans = outcome.validations.where("name = 'target-foreign-key-orphans'").first()
    assert (orphans["status"], orphans["message"]) == ("FAIL", "orphans=2")
    before = spark.read.parquet(f"{root}/data/ACCOUNT").count()
    with pytest.raises(migrate.TargetNotEmpty, match="target CUSTOMER contains .*target ACCOUNT contains|target ACCOUNT contains .*target CUSTOMER contains"):
        migrate.load_existing(sources, tables, root, "run-2", 20)
    # the refusal is on record, and nothing was touched
    refused = spark.read.json(f"{root}/report/run-2-report-json").collect()
    assert [(r["name"], r["status"], r["object"]) for r in refused] == [("run", "FAIL", "run-2")]
    assert "contains" in refused[0]["message"] and "TargetNotEmpty" in refused[0]["message"]
    assert spark.read.parquet(f"{root}/data/ACCOUNT").count() == before
    # a run that the ledger knows goes on instead
    assert migrate.load_existing(full, tables, root, "run-1", 20).status == "FAIL"
    again = migrate.load_existing(sources, tables, root, "run-3", 20, migrate.TRUNCATE)
    assert again.status == "PASS"
    schema = prepare_rows(sources["ACCOUNT"]).schema
    assert migrate.read_target(spark, root, "ACCOUNT", schema).count() == 50
    with pytest.raises(ValueError, match="policy"):
        migrate.load_existing(sources, tables, root, "run-4", 20, "OTHER")


def test_a_parent_that_cannot_be_read_leaves_a_report(spark, tmp_path):
    from dataclasses import replace

    sources, tables = shop(spark)
    tables["CUSTOMER"] = replace(tables["CUSTOMER"], excluded=True)
    broken = sources["CUSTOMER"].columns[0]
    sources["CUSTOMER"] = sources["CUSTOMER"].withColumn(broken, F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        migrate.full_load(sources, tables, f"{tmp_path}/a", "r", 50)
    report = spark.read.json(f"{tmp_path}/a/report/r-report-json").collect()
    assert ("run", "FAIL") in [(r["name"], r["status"]) for r in report]


def test_excluded_tables_and_outside_parents(spark, tmp_path):
    from dataclasses import replace

    sources, tables = shop(spark)
    tables["CUSTOMER"] = replace(tables["CUSTOMER"], excluded=True)
    with pytest.raises(migrate.StopBeforeCopy):
        migrate.full_load(sources, tables, f"{tmp_path}/a", "r", 50)
    assert not path_exists(spark, f"{tmp_path}/a/data")
    report = spark.read.json(f"{tmp_path}/a/report/r-report-json")
    found = {(r["record_type"], r["name"], r["status"]) for r in report.collect()}
    assert ("READINESS", "RDN-008", "BLOCKER") in found
    assert ("VALIDATION", "run", "FAIL") in found
    assert ("EXCLUSION", "CUSTOMER", "EXCLUDED") in found
    outcome = migrate.full_load(
        sources, tables, f"{tmp_path}/b", "r", 50, outside_parents={"CUSTOMER": sources["CUSTOMER"]}
    )
    assert outcome.status == "PASS"
    assert {r["table_name"] for r in outcome.ledger.collect()} == {"ACCOUNT"}


def test_reserved_key_columns(spark, tmp_path):
    source = spark.range(1, 11).select(F.col("id").alias("ORDER"), F.col("id").alias("GROUP"))
    tables = {"T": Table("T", keys=(Key("PK", ("ORDER",)),))}
    assert migrate.full_load({"T": source}, tables, str(tmp_path), "r", 4).status == "PASS"


def test_a_failed_copy_is_reported_and_restarted(spark, tmp_path):
    source = spark.range(40).select("id", (F.lit(1) / F.when(F.col("id") == 35, 0).otherwise(1)).alias("v"))
    good = spark.range(40).select("id", F.lit(1.0).cast("double").alias("v"))
    tables = {"T": Table("T", keys=(Key("PK", ("id",)),))}
    root = str(tmp_path)
    with pytest.raises(CopyFailed):
        migrate.full_load({"T": source}, tables, root, "r", 10, waves=4)
    report = spark.read.json(f"{root}/report/r-report-json")
    assert {(r["record_type"], r["status"]) for r in report.collect()} >= {("VALIDATION", "FAIL")}
    assert report.where("record_type = 'ERROR'").count() == 1
    ledger = {r["chunk_id"]: r["status"] for r in L.read_ledger(spark, f"{root}/ledger", "r").collect()}
    assert ledger["T-000001"] == "SUCCESS" and ledger["T-000004"] == "FAILED"
    outcome = migrate.full_load({"T": good}, tables, root, "r", 10, waves=4)
    assert outcome.status == "PASS"
    assert outcome.ledger.where("status = 'SUCCESS'").count() == 4


def test_another_run_starts_from_an_empty_target(spark, tmp_path):
    sources, tables = shop(spark)
    root = str(tmp_path)
    assert migrate.full_load(sources, tables, root, "a", 20).status == "PASS"
    assert migrate.full_load(sources, tables, root, "b", 7, chunk_sizes={"CUSTOMER": 3}).status == "PASS"
