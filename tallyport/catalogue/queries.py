"""One registered query per operator.

Each takes a session and a data folder, reads whole tables, and returns a DataFrame.
Where an operator compares two tables, the second is the first with known defects (see
:mod:`tallyport.catalogue.inputs`).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyport.catalogue.inputs import (
    CUSTOMER,
    ORDERS,
    altered_orders,
    broken_line_numbers,
    broken_order_customers,
    read,
)
from tallyport.functions import canon
from tallyport.functions.canon import SOURCE_TYPE, bytes_as_text, row_fingerprint, row_text
from tallyport.functions.convert import convert_values, exact_integer
from tallyport.functions.names import rename_reserved
from tallyport.functions.text import VENDOR_SQL_PATTERNS, collapsed
from tallyport.functions.types import choose_type
from tallyport.operators import baseline, chunks, compare, keys, ledger, quality
from tallyport.operators.copy import CopyFailed, CopyPaths, chunked_rows, copy_table
from tallyport.operators.quality import RequiredColumn
from tallyport.plans import migrate, report, validate
from tallyport.runtime import work_path
from tallyport.sources.tables import scan, scan_key_range, table_row_counts
from tallyport.specs import ForeignKey, Table

TEXT_PATTERNS = {
    **VENDOR_SQL_PATTERNS,
    "license": ("license", "licence"),
    "contact": ("@example.com", "e-mail"),
}
LINE_KEY = ("l_orderkey", "l_linenumber")


def _named(df: DataFrame, table: str) -> DataFrame:
    return df.select(F.lit(table).alias("table_name"), "*")


# --- scans and projections ---------------------------------------------------------


def scan_projected(spark, folder):
    return scan(spark, f"{folder}/orders.parquet", ["o_orderkey", "o_custkey", "o_totalprice"])


def scan_chunk(spark, folder):
    """The second quarter of the key range, as one chunk."""
    orders = scan(spark, f"{folder}/orders.parquet", ["o_orderkey", "o_totalprice"])
    low, high = chunks.key_bounds(orders, "o_orderkey").first()
    quarter = (high - low + 1) // 4
    return scan_key_range(orders, "o_orderkey", low + quarter, low + 2 * quarter - 1)


def rename_reserved_columns(spark, folder):
    orders = read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("ORDER"),
        F.col("o_custkey").alias("USER"),
        F.col("o_totalprice").alias("LIMIT"),
        F.col("o_orderstatus").alias("Status"),
    )
    return rename_reserved(orders)


def convert_on_copy(spark, folder):
    """Intervals become text and days become timestamps."""
    orders = read(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("order_day"),
        (F.col("o_orderdate") - F.lit("1990-01-01").cast("timestamp_ntz")).alias("order_age"),
    )
    return convert_values(orders)


# --- chunks ------------------------------------------------------------------------


def key_bounds(spark, folder):
    return validate.union_all(
        [
            _named(chunks.key_bounds(read(spark, folder, "orders"), "o_orderkey"), "orders"),
            _named(chunks.key_bounds(read(spark, folder, "events"), "event_id"), "events"),
            _named(chunks.row_bounds(read(spark, folder, "conversations")), "conversations"),
            _named(chunks.row_bounds(read(spark, folder, "lineitem")), "lineitem"),
        ]
    )


def chunk_plan_range(spark, folder):
    return chunks.plan_key_ranges(read(spark, folder, "orders"), "orders", "o_orderkey", 1000)


def chunk_plan_dense(spark, folder):
    """Every range of a sparse key, empty ones too."""
    return chunks.plan_key_ranges(read(spark, folder, "documents"), "documents", "n_chars", 1000, dense=True)


def _quantile_plans(spark, folder):
    """A key of many values, one with gaps, and one whose values are all frequent."""
    wanted = (("orders", "o_custkey", 500), ("documents", "n_chars", 100), ("lineitem", "l_linenumber", 2000))
    for name, key, size in wanted:
        yield chunks.plan_quantiles(read(spark, folder, name), name, key, size, accuracy=10_000_000)


def chunk_plan_quantile(spark, folder):
    """Ranges of equal depth, whatever the spread of the keys."""
    plans = [p.withColumn("low_key", F.col("low_key").cast("bigint")).withColumn(
        "high_key", F.col("high_key").cast("bigint")) for p in _quantile_plans(spark, folder)]
    return validate.union_all(plans)


def quantile_balance(spark, folder):
    """How even those ranges are."""
    return validate.union_all([chunks.plan_balance(p) for p in _quantile_plans(spark, folder)])


def chunk_plan_rownum(spark, folder):
    plan = chunks.plan_row_numbers(
        read(spark, folder, "conversations"), "conversations", ["conv_id", "turn"], 50
    )
    return plan.select(
        "chunk_no",
        "chunk_id",
        "first_row",
        "last_row",
        F.col("first_key.conv_id").alias("first_conv"),
        F.col("first_key.turn").alias("first_turn"),
        F.col("last_key.conv_id").alias("last_conv"),
        F.col("last_key.turn").alias("last_turn"),
        "row_count",
    )


def chunk_plan_keyless(spark, folder):
    plan = chunks.plan_row_positions(read(spark, folder, "lineitem"), "lineitem", 5000)
    return plan.drop("pieces")


def chunk_plan_auto(spark, folder):
    chosen = {
        "orders": (["o_orderkey"], 5000),
        "conversations": (["conv_id", "turn"], 100),
        "lineitem": ([], 5000),
    }
    plans = [
        chunks.plan_chunks(read(spark, folder, name), name, key, size) for name, (key, size) in chosen.items()
    ]
    return validate.union_all(plans)


def chunk_balance(spark, folder):
    checked = {"orders": ("o_custkey", 100), "events": ("event_id", 1000), "documents": ("n_chars", 1000)}
    parts = []
    for name, (key, size) in checked.items():
        df = read(spark, folder, name)
        parts.append(chunks.chunk_balance(df, name, key, size, row_fingerprint(df, [key])))
    return validate.union_all(parts)


# --- copy and ledger ---------------------------------------------------------------


def copy_counts(spark, folder):
    """A real copy of the orders into a fresh folder, and its ledger."""
    target = work_path(spark, "copy-counts")
    paths = CopyPaths(f"{target}/data", f"{target}/ledger", f"{target}/errors")
    written = copy_table(read(spark, folder, "orders"), ORDERS, paths, "run-1", 1000)
    return written.select("table_name", "chunk_id", "chunk_range", "rows_read", "rows_written", "status")


def copy_restart(spark, folder):
    """A copy in three waves that one broken row stops, and its restart: the records of each
    chunk, and the chunk that the error names."""
    target = work_path(spark, "copy-restart")
    paths = CopyPaths(f"{target}/data", f"{target}/ledger", f"{target}/errors")
    orders = read(spark, folder, "orders")
    broken = orders.where("o_orderkey % 7 = 3").agg(F.max("o_orderkey")).first()[0]
    fault = F.when(F.col("o_orderkey") == broken, F.raise_error(F.lit("broken row")))
    bad = orders.withColumn("o_orderstatus", fault.otherwise(F.col("o_orderstatus")))
    try:
        copy_table(bad, ORDERS, paths, "run-1", 500, waves=3)
    except CopyFailed:
        pass
    written = copy_table(orders, ORDERS, paths, "run-1", 500, waves=3)
    errors = spark.read.parquet(paths.errors).select("error_id", F.col("chunk_id").alias("error_chunk"))
    named = written.join(errors, F.col("last_error_id") == F.col("error_id"), "left")
    return named.groupBy("table_name", "chunk_id").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("status") == ledger.SUCCESS).alias("copies"),
        F.count_if(F.col("status") == ledger.FAILED).alias("failures"),
        F.sum("rows_read").alias("rows_read"),
        F.sum("rows_written").alias("rows_written"),
        F.max("error_chunk").alias("error_chunk"),
    )


def _order_chunks(df: DataFrame, size: int) -> DataFrame:
    return chunked_rows(df, ORDERS, size)


def chunk_ledger(spark, folder):
    return ledger.chunk_ledger(
        _order_chunks(read(spark, folder, "orders"), 100), _order_chunks(altered_orders(spark, folder), 100)
    )


def row_capped_chunks(spark, folder):
    """Each table's copy stops before the first chunk that finds 4,000 rows read."""
    plans = [
        chunks.plan_chunks(read(spark, folder, name), name, [key], 500)
        for name, key in (("orders", "o_orderkey"), ("events", "event_id"), ("customer", "c_custkey"))
    ]
    capped = ledger.row_capped_chunks(validate.union_all(plans), 4000)
    return capped.select("table_name", "chunk_id", "row_count", "rows_before", "status")


def latest_chunk_state(spark, folder):
    """Orders read as a log of chunk records: many per customer and priority."""
    status = F.when(F.col("o_orderstatus") == "F", "FAILED").when(F.col("o_orderstatus") == "O", "RUNNING")
    records = read(spark, folder, "orders").select(
        F.lit("run-1").alias("run_id"),
        F.col("o_orderpriority").alias("table_name"),
        chunks.chunk_id("c", F.col("o_custkey")).alias("chunk_id"),
        F.col("o_orderkey").alias("rows_read"),
        F.col("o_orderkey").cast("string").alias("chunk_range"),
        status.otherwise("SUCCESS").alias("status"),
        F.col("o_orderdate").alias("started_at"),
        F.col("o_orderdate").alias("completed_at"),
    )
    return ledger.latest_state(records, order_by=("completed_at", "rows_read"))


def pending_chunks(spark, folder):
    plan = chunks.plan_chunks(read(spark, folder, "orders"), "orders", ["o_orderkey"], 25)
    done = ledger.chunk_ledger(
        _order_chunks(read(spark, folder, "orders"), 25), _order_chunks(altered_orders(spark, folder), 25)
    )
    return ledger.pending_chunks(plan, done).select("table_name", "chunk_id", "where_clause", "row_count")


def target_row_counts(spark, folder):
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    return table_row_counts({name: read(spark, folder, name) for name in names})


# --- comparison --------------------------------------------------------------------


def row_count_check(spark, folder):
    return compare.row_count_check(read(spark, folder, "orders"), altered_orders(spark, folder), "orders")


def checksum_table(spark, folder):
    tables = {
        "orders": (read(spark, folder, "orders"), {"o_totalprice": 2}),
        "orders_altered": (altered_orders(spark, folder), {"o_totalprice": 2}),
        "events": (read(spark, folder, "events"), {"value": 2}),
        "documents": (read(spark, folder, "documents"), {}),
    }
    parts = [_named(compare.table_digest(df, scales=scales), name) for name, (df, scales) in tables.items()]
    return validate.union_all(parts)


def checksum_check(spark, folder):
    """A differing table, an equal one, and one whose large text is left out."""
    orders, documents = read(spark, folder, "orders"), read(spark, folder, "documents")
    marked = documents.withMetadata("text", {SOURCE_TYPE: "CLOB"})
    return validate.union_all(
        [
            compare.checksum_check(orders, altered_orders(spark, folder), "orders", ORDERS.scales),
            compare.checksum_check(
                read(spark, folder, "customer"), read(spark, folder, "customer"), "customer", CUSTOMER.scales
            ),
            compare.checksum_check(marked, documents, "documents"),
        ]
    )


def checksum_native(spark, folder):
    """Checksums by Spark's own hash; their values mean nothing elsewhere, so only the
    status is shown."""
    orders, customer = read(spark, folder, "orders"), read(spark, folder, "customer")
    altered = altered_orders(spark, folder)
    return validate.union_all(
        [
            compare.checksum_check(orders, altered, "orders", ORDERS.scales, canon.NATIVE),
            compare.checksum_check(customer, customer, "customer", CUSTOMER.scales, canon.NATIVE),
        ]
    ).select("name", "status", "object_name")


def checksum_by_chunk(spark, folder):
    return compare.checksum_by_chunk(
        read(spark, folder, "orders"),
        altered_orders(spark, folder),
        "orders",
        "o_orderkey",
        50,
        scales=ORDERS.scales,
    )


def fingerprint_drift(spark, folder):
    """A baseline is stored, read back and compared with the altered table, range by range."""
    path = work_path(spark, "baseline")
    _save_orders(spark, folder, path, 50)
    return baseline.drift_against_baseline(
        altered_orders(spark, folder), path, "orders", "o_orderkey", 50, scales=ORDERS.scales, with_same=True
    )


def _save_orders(spark, folder, path, size, fanout=baseline.FANOUT):
    orders = read(spark, folder, "orders")
    wanted = baseline.describe(orders, "orders", "o_orderkey", size, scales=ORDERS.scales, fanout=fanout)
    baseline.save(baseline.digest_tree(orders, wanted), path)


def fingerprint_tree(spark, folder):
    """All levels of a stored tree of digests, as they are read back."""
    path = work_path(spark, "baseline")
    _save_orders(spark, folder, path, 20, 8)
    nodes = baseline.load(spark, path).nodes
    return nodes.select("level", "node", "row_count", "hash_xor", "hash_sum", "digest")


def baseline_drift(spark, folder):
    """Ranges that differ from a stored baseline: the first order is gone, others stand below
    the baseline's first key or have lost theirs, and a range's prices are changed."""
    path = work_path(spark, "baseline")
    _save_orders(spark, folder, path, 20, 8)
    key = F.col("o_orderkey")
    orders = read(spark, folder, "orders")
    first = orders.agg(F.min(key)).scalar()
    moved = F.when(key % 1009 == 7, -key).when(key % 1009 == 8, None).otherwise(key)
    price = F.col("o_totalprice") + F.when(key.between(200, 210), 1).otherwise(0)
    current = orders.where(key != first).withColumn("o_totalprice", price).withColumn("o_orderkey", moved)
    return baseline.drift_against_baseline(
        current, path, "orders", "o_orderkey", 20, scales=ORDERS.scales, fanout=8
    )


def sample_rows(spark, folder):
    return compare.sample_rows(read(spark, folder, "orders"), ["o_orderkey"])


def sample_diff(spark, folder):
    orders = read(spark, folder, "orders")
    lines = read(spark, folder, "lineitem")
    return validate.union_all(
        [
            compare.sample_result(orders, altered_orders(spark, folder), "orders", ["o_orderkey"]),
            compare.sample_result(lines, lines, "lineitem", size=250),
        ]
    )


def row_diff_keyed(spark, folder):
    return compare.row_diff_keyed(read(spark, folder, "orders"), altered_orders(spark, folder), ["o_orderkey"])


def row_diff_drill_down(spark, folder):
    return compare.row_diff_drill_down(
        read(spark, folder, "orders"),
        altered_orders(spark, folder),
        "o_orderkey",
        25,
        scales=ORDERS.scales,
    )


def row_diff_multiset(spark, folder):
    return compare.row_diff_multiset(
        read(spark, folder, "orders"), altered_orders(spark, folder), ["o_orderkey", "o_totalprice"]
    )


def row_diff_scaled(spark, folder):
    """Noise below the scale on top of the faulty copy, compared by hashed buckets."""
    noise = F.when(F.col("o_orderkey") % 83 == 11, 0.001).otherwise(0.0)
    altered = altered_orders(spark, folder).withColumn("o_totalprice", F.col("o_totalprice") + noise)
    orders = read(spark, folder, "orders")
    return compare.row_diff_drill_down(orders, altered, ["o_orderkey"], 25, scales=ORDERS.scales, most_sent=0)


def checksum_other_types(spark, folder):
    """Keys as decimals against the original, and a value that the source's type cannot hold."""
    orders = read(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    wide = orders.withColumn("o_orderkey", F.col("o_orderkey").cast("decimal(30,6)"))
    one = F.when(F.col("o_orderkey") % 97 == 1, "x").otherwise(F.col("o_custkey").cast("string"))
    checks = [
        compare.checksum_check(orders, wide, "orders_wide"),
        compare.checksum_check(orders, orders.withColumn("o_custkey", one), "orders_text"),
    ]
    return validate.union_all([c.select("name", "status", "object_name") for c in checks])


def chunk_plan_wide(spark, folder):
    """Ranges of a key that is spread over all of its type."""
    spread = (F.col("o_orderkey") % 18000).cast("decimal(20,0)") * F.lit(10**15).cast("decimal(16,0)")
    wide = (spread - F.lit(9 * 10**18).cast("decimal(19,0)")).cast("bigint")
    orders = read(spark, folder, "orders").select(wide.alias("wide_key"))
    return chunks.plan_key_ranges(orders, "orders", "wide_key", 10**17)


def fk_closed_self(spark, folder):
    """Customers under customers: rows whose chain of parents is broken go."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    parent = F.when(key % 10 == 0, None).when(nation == 3, key + 10**9).otherwise(F.floor(key / 10))
    customers = read(spark, folder, "customer").select("c_custkey", parent.cast("bigint").alias("parent"))
    own = ForeignKey("fk_parent", "customer", ("parent",), "customer", ("c_custkey",))
    return keys.fk_closed_subset({"customer": customers}, [own])["customer"]


# --- keys --------------------------------------------------------------------------


def duplicate_keys(spark, folder):
    return validate.union_all(
        [
            _named(keys.duplicate_keys(altered_orders(spark, folder), ["o_orderkey"]), "orders_altered"),
            _named(keys.duplicate_keys(broken_line_numbers(spark, folder), LINE_KEY), "lineitem_broken"),
        ]
    )


def duplicate_groups(spark, folder):
    return keys.duplicate_groups(read(spark, folder, "lineitem"), LINE_KEY)


def key_candidates(spark, folder):
    return validate.union_all(
        [
            keys.key_candidates(
                broken_line_numbers(spark, folder), "lineitem", [LINE_KEY, ("l_orderkey", "l_partkey")]
            ),
            keys.key_candidates(
                read(spark, folder, "orders"), "orders", [("o_orderkey",), ("o_custkey", "o_orderdate")]
            ),
        ]
    )


def fk_orphans(spark, folder):
    return keys.fk_orphans(
        broken_order_customers(spark, folder), read(spark, folder, "customer"), ["o_custkey"], ["c_custkey"]
    )


def orphan_keys(spark, folder):
    return keys.orphan_keys(
        broken_order_customers(spark, folder), read(spark, folder, "customer"), ["o_custkey"], ["c_custkey"]
    )


def fk_orphans_composite(spark, folder):
    return keys.fk_orphans(
        broken_line_numbers(spark, folder), read(spark, folder, "lineitem"), LINE_KEY, LINE_KEY
    )


def fk_orphans_full(spark, folder):
    return keys.fk_orphans_full(
        broken_line_numbers(spark, folder), read(spark, folder, "lineitem"), LINE_KEY, LINE_KEY
    )


def excluded_parent_impact(spark, folder):
    """Customers per nation of an excluded region."""
    asia = read(spark, folder, "region").where(F.col("r_name") == "ASIA")
    nations = read(spark, folder, "nation").join(
        asia, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi"
    )
    return keys.excluded_parent_impact(
        read(spark, folder, "customer"), nations, ["c_nationkey"], ["n_nationkey"]
    )


def excluded_parent_findings(spark, folder):
    """Orders of excluded customers, and customers of no excluded nation."""
    customer, nation = read(spark, folder, "customer"), read(spark, folder, "nation")
    to_nation = ForeignKey("fk_nation", "customer", ("c_nationkey",), "nation", ("n_nationkey",))
    return validate.union_all(
        [
            quality.excluded_parent_findings(
                broken_order_customers(spark, folder),
                customer.where(F.col("c_acctbal") < 0),
                ORDERS.foreign_keys[0],
            ),
            quality.excluded_parent_findings(customer, nation.where(F.col("n_name") == "NONE"), to_nation),
        ]
    )


def excluded_dependents(spark, folder):
    """Customers depend on their nation, its region and their segment, in this order."""
    placed = (
        read(spark, folder, "customer")
        .join(read(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(read(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    needs = F.array(
        *[
            F.struct(F.lit(i).alias("place"), F.col(c).alias("needs"))
            for i, c in enumerate(("n_name", "r_name", "c_mktsegment"))
        ]
    )
    edges = placed.select(F.col("c_name").alias("item"), F.inline(needs))
    return keys.excluded_dependents(edges, "item", "needs", ["Asia", "nation_3", "MACHINERY"], "place")


def exclusion_flags(spark, folder):
    customers = read(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return quality.exclusion_flags(customers, "c_mktsegment", ["building", "Machinery"])


def exclusion_flags_by_table(spark, folder):
    """Suppliers are excluded where a customer in debt has their nation's name."""
    customers, nations = read(spark, folder, "customer"), read(spark, folder, "nation")
    named = nations.select("n_nationkey", F.upper("n_name").alias("n_name"))
    debtors = customers.where(F.col("c_acctbal") < -900).join(
        named, F.col("c_nationkey") == F.col("n_nationkey")
    )
    suppliers = (
        read(spark, folder, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", F.lower("n_name").alias("nation"))
    )
    return quality.exclusion_flags_by_table(suppliers, "nation", debtors, "n_name")


def fk_closed_subset(spark, folder):
    """Customers of one segment, their orders, and the line items of those."""
    tables = {
        "lineitem": read(spark, folder, "lineitem"),
        "orders": broken_order_customers(spark, folder),
        "customer": read(spark, folder, "customer").where(F.col("c_mktsegment") == "BUILDING"),
    }
    edges = [
        ForeignKey("fk_order", "lineitem", ("l_orderkey",), "orders", ("o_orderkey",)),
        ORDERS.foreign_keys[0],
    ]
    subset = keys.fk_closed_subset(tables, edges)
    columns = {"lineitem": ["l_orderkey", "l_partkey"], "orders": ["o_orderkey"], "customer": ["c_custkey"]}
    parts = [_named(compare.table_digest(df, columns[name]), name) for name, df in subset.items()]
    return validate.union_all(parts)


# --- quality -----------------------------------------------------------------------


def pattern_flags(spark, folder):
    return quality.pattern_flags(read(spark, folder, "documents"), ["doc_id"], "text", TEXT_PATTERNS)


def pattern_findings(spark, folder):
    return validate.union_all(
        [
            quality.pattern_findings(read(spark, folder, name), name, column, TEXT_PATTERNS)
            for name, column in (("documents", "text"), ("pages", "html"))
        ]
    )


def whole_value_flags(spark, folder):
    return quality.whole_value_findings(
        read(spark, folder, "documents"),
        "documents",
        {"source": r"SRC1\d?", "lang": r"e[ns]", "text": r"[a-z ,.]+"},
    )


def type_fit(spark, folder):
    orders = quality.type_fit(
        read(spark, folder, "orders"),
        "orders",
        {
            "o_orderkey": choose_type("NUMBER", 4, 0),
            "o_totalprice": choose_type("NUMBER", 7, 1),
            "o_orderpriority": choose_type("VARCHAR2", 8),
            "o_orderdate": choose_type("BFILE"),
        },
        {"o_orderkey": F.col("o_orderkey") * 10},
    )
    props = F.get_json_object("props", "$.k")
    events = quality.type_fit(
        read(spark, folder, "events"),
        "events",
        {"props": choose_type("NUMBER", 4, 0), "value": choose_type("NUMBER", 9, 0)},
        {"props": F.when(F.col("event_type") == "error", F.concat(props, F.lit(".50"))).otherwise(props)},
    )
    documents = quality.type_fit(
        read(spark, folder, "documents"), "documents", {"text": choose_type("VARCHAR2")}
    )
    return validate.union_all([orders, events, documents])


def lob_profile(spark, folder):
    columns = {"documents": ["text", "source"], "pages": ["html", "url"], "conversations": ["text"]}
    return validate.union_all(
        [quality.lob_profile(read(spark, folder, name), name, cols) for name, cols in columns.items()]
    )


def lob_histogram(spark, folder):
    columns = {"documents": ["text"], "pages": ["html", "url"], "conversations": ["text"]}
    return validate.union_all(
        [quality.lob_histogram(read(spark, folder, name), name, cols) for name, cols in columns.items()]
    )


REQUIRED_ORDER_COLUMNS = (
    RequiredColumn("O_ORDERKEY", T.LongType()),
    RequiredColumn("O_CUSTKEY", T.LongType()),
    RequiredColumn("O_CLERK", T.StringType()),
    RequiredColumn("O_COMMENT", T.StringType(), may_be_omitted=True),
)


def required_column_nulls(spark, folder):
    return quality.required_column_nulls(
        broken_order_customers(spark, folder), "orders", REQUIRED_ORDER_COLUMNS
    )


# --- suites and reports ------------------------------------------------------------


def validation_suite(spark, folder):
    return validate.validate_table(
        read(spark, folder, "orders"),
        altered_orders(spark, folder),
        ORDERS,
        {"customer": read(spark, folder, "customer")},
    )


def status_rollup(spark, folder):
    """Two roll-ups, of a failing suite and of a clean one with text to review, and the
    stop flag of the findings."""
    customer = read(spark, folder, "customer")
    review = pattern_flags(spark, folder)
    failing = validate.final_status(validation_suite(spark, folder), review)
    clean = validate.final_status(compare.row_count_check(customer, customer, "customer"), review)
    stop = validate.stop_flag(required_column_nulls(spark, folder)).scalar()
    both = _named(failing, "orders").unionByName(_named(clean, "customer"))
    return both.withColumn("should_stop", stop)


def report_rows(spark, folder):
    """Results, chunk errors, findings and exclusions of one run under one header."""
    failed = ledger.chunk_ledger(
        _order_chunks(read(spark, folder, "orders"), 500), _order_chunks(altered_orders(spark, folder), 500)
    ).where(F.col("status") == ledger.FAILED)
    errors = failed.select(
        F.lit("data-load").alias("phase"),
        F.lit("RETRY_OR_MANUAL_REVIEW").alias("action_category"),
        F.col("table_name").alias("object_name"),
        "chunk_id",
        F.lit(None).cast("string").alias("database_code"),
        F.lit(None).cast("string").alias("sql_text"),
        F.concat(F.lit("read="), "rows_read", F.lit(", written="), "rows_written").alias("message"),
    )
    decisions = (
        excluded_dependents(spark, folder)
        .select(F.lit("ROW").alias("object_type"), F.col("item").alias("object_name"), "status", "reason")
    )
    return report.report_rows(
        validation_suite(spark, folder), errors, required_column_nulls(spark, folder), decisions
    )


def full_load(spark, folder):
    """Copy customers and orders, check both, and return the results."""
    root = work_path(spark, "full-load")
    sources = {"orders": read(spark, folder, "orders"), "customer": read(spark, folder, "customer")}
    run_id = f"run-{uuid.uuid4().hex[:8]}"
    return migrate.full_load(sources, {"orders": ORDERS, "customer": CUSTOMER}, root, run_id, 5000).validations


def load_existing(spark, folder):
    """Line items into a table that holds rows: refused first, with a report, then truncated and
    loaded anew; their composite reference is checked as MATCH FULL."""
    root = work_path(spark, "load-existing")
    columns = ["l_orderkey", "l_linenumber", "l_partkey"]
    whole = read(spark, folder, "lineitem").select(*columns)
    key = ForeignKey("fk_line", "lineitem", LINE_KEY, "lines", LINE_KEY, match="full")
    tables = {"lineitem": Table("lineitem", foreign_keys=(key,))}
    parents = {"lines": whole}
    migrate.load_existing({"lineitem": whole}, tables, root, "first", 20_000, outside_parents=parents)
    sources = {"lineitem": broken_line_numbers(spark, folder).select(*columns)}
    try:
        migrate.load_existing(sources, tables, root, "refused", 20_000, outside_parents=parents)
    except migrate.TargetNotEmpty:
        pass
    report_rows = spark.read.json(f"{root}/report/refused-report-json")
    refused = report_rows.select("name", "status", F.col("object").alias("object_name"), "message")
    again = migrate.load_existing(
        sources, tables, root, "again", 20_000, migrate.TRUNCATE, outside_parents=parents
    )
    return refused.unionByName(again.validations)


def report_files(spark, folder):
    """The files of a report, read back: all records from JSON and from CSV, and the exclusions."""
    path = work_path(spark, "report")
    decisions = excluded_dependents(spark, folder).select(
        F.lit("ROW").alias("object_type"), F.col("item").alias("object_name"), "status", "reason"
    )
    findings = required_column_nulls(spark, folder)
    report.write_report(path, "run", validation_suite(spark, folder), findings=findings, decisions=decisions)
    kinds = ", ".join(f"{c} string" for c in report.REPORT_COLUMNS)
    records = [
        spark.read.schema(kinds).json(f"{path}/run-report-json"),
        report.read_csv(spark, f"{path}/run-report-csv", kinds),
    ]
    listed = report.read_csv(spark, f"{path}/run-exclusions-csv", ", ".join(f"{c} string" for c in report.EXCLUSION_COLUMNS))
    files = [df.select(F.lit(kind).alias("file"), "record_type", "name", "status", "object", "message")
             for kind, df in zip(("json", "csv"), records, strict=True)]
    excluded = listed.select(
        F.lit("exclusions").alias("file"), F.lit("").alias("record_type"), F.col("object_name").alias("name"), "status",
        F.col("object_type").alias("object"), F.col("reason").alias("message"),
    )
    return validate.union_all([*files, excluded])


# --- functions ---------------------------------------------------------------------


def canonical_text(spark, folder):
    events = read(spark, folder, "events")
    return events.select("event_id", row_text(events, scales={"value": 2}).alias("row_text"))


def text_digests(spark, folder):
    """MD5 and SHA-256 in lower-case hex."""
    return read(spark, folder, "documents").select(
        "doc_id", F.md5("text").alias("md5_hex"), F.sha2("text", 256).alias("sha256_hex")
    )


def bytes_text(spark, folder):
    """Bytes shown as text: UTF-8 as it is, and other bytes in hex."""
    documents = read(spark, folder, "documents")
    utf8 = F.encode("text", "UTF-8")
    return documents.select(
        "doc_id",
        bytes_as_text(utf8).alias("shown"),
        bytes_as_text(F.concat(F.unhex(F.lit("FF")), F.encode("source", "UTF-8"))).alias("shown_hex"),
    )


def collapsed_text(spark, folder):
    return read(spark, folder, "conversations").select(
        "conv_id", "turn", F.trim(collapsed(F.col("text"))).alias("plain"), F.upper("role").alias("role_upper")
    )


def exact_integers(spark, folder):
    """Numbers in text: zeros behind the point are dropped, fractions are refused."""
    text = F.concat(
        F.lit(" "), F.col("o_custkey").cast("string"), F.lit("."), F.lpad(F.col("o_orderkey") % 4, 2, "0")
    )
    narrow = exact_integer(F.col("o_orderkey") * 10, T.LongType(), T.ShortType())
    return read(spark, folder, "orders").select(
        "o_orderkey",
        exact_integer(text, T.StringType(), T.LongType()).alias("whole"),
        narrow.cast("bigint").alias("narrow"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_projected": scan_projected,
    "scan_chunk": scan_chunk,
    "rename_reserved": rename_reserved_columns,
    "convert_on_copy": convert_on_copy,
    "key_bounds": key_bounds,
    "chunk_plan_range": chunk_plan_range,
    "chunk_plan_dense": chunk_plan_dense,
    "chunk_plan_quantile": chunk_plan_quantile,
    "quantile_balance": quantile_balance,
    "chunk_plan_rownum": chunk_plan_rownum,
    "chunk_plan_keyless": chunk_plan_keyless,
    "chunk_plan_auto": chunk_plan_auto,
    "chunk_balance": chunk_balance,
    "copy_counts": copy_counts,
    "copy_restart": copy_restart,
    "chunk_ledger": chunk_ledger,
    "row_capped_chunks": row_capped_chunks,
    "latest_chunk_state": latest_chunk_state,
    "pending_chunks": pending_chunks,
    "target_row_counts": target_row_counts,
    "row_count_check": row_count_check,
    "checksum_table": checksum_table,
    "checksum_check": checksum_check,
    "checksum_native": checksum_native,
    "checksum_by_chunk": checksum_by_chunk,
    "fingerprint_drift": fingerprint_drift,
    "fingerprint_tree": fingerprint_tree,
    "baseline_drift": baseline_drift,
    "sample_rows": sample_rows,
    "sample_diff": sample_diff,
    "row_diff_keyed": row_diff_keyed,
    "row_diff_drill_down": row_diff_drill_down,
    "row_diff_multiset": row_diff_multiset,
    "fk_closed_self": fk_closed_self,
    "chunk_plan_wide": chunk_plan_wide,
    "checksum_other_types": checksum_other_types,
    "row_diff_scaled": row_diff_scaled,
    "duplicate_keys": duplicate_keys,
    "duplicate_groups": duplicate_groups,
    "key_candidates": key_candidates,
    "fk_orphans": fk_orphans,
    "orphan_keys": orphan_keys,
    "fk_orphans_composite": fk_orphans_composite,
    "fk_orphans_full": fk_orphans_full,
    "excluded_parent_impact": excluded_parent_impact,
    "excluded_parent_findings": excluded_parent_findings,
    "excluded_dependents": excluded_dependents,
    "exclusion_flags": exclusion_flags,
    "exclusion_flags_by_table": exclusion_flags_by_table,
    "fk_closed_subset": fk_closed_subset,
    "pattern_flags": pattern_flags,
    "pattern_findings": pattern_findings,
    "whole_value_flags": whole_value_flags,
    "type_fit": type_fit,
    "lob_profile": lob_profile,
    "lob_histogram": lob_histogram,
    "required_column_nulls": required_column_nulls,
    "validation_suite": validation_suite,
    "status_rollup": status_rollup,
    "report_rows": report_rows,
    "full_load": full_load,
    "load_existing": load_existing,
    "report_files": report_files,
    "canonical_text": canonical_text,
    "text_digests": text_digests,
    "bytes_text": bytes_text,
    "collapsed_text": collapsed_text,
    "exact_integers": exact_integers,
}
