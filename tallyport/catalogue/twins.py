"""Plain SQL that gives the same results as the registered queries.

Written from the definitions, with joins, windows and set operations, and not from the
way the DataFrame operators are put together.
"""

from __future__ import annotations

from tallyport.catalogue.queries import TEXT_PATTERNS

_ORDER_COLUMNS = {
    "o_orderkey": "number",
    "o_custkey": "number",
    "o_orderstatus": "text",
    "o_totalprice": "cents",
    "o_orderdate": "time",
    "o_orderpriority": "text",
}
_LINE_KEY_COLUMNS = {"l_orderkey": "number", "l_linenumber": "number", "l_partkey": "number"}
_EVENT_COLUMNS = {
    "event_id": "number", "ts": "time", "user_id": "number",
    "event_type": "text", "value": "cents", "props": "text",
}
_DOCUMENT_COLUMNS = {
    "doc_id": "number", "text": "text", "lang": "text", "source": "text", "n_chars": "number",
}
_CUSTOMER_COLUMNS = {
    "c_custkey": "number", "c_name": "text", "c_nationkey": "number",
    "c_acctbal": "cents", "c_mktsegment": "text",
}

# The faulty copy of orders, orders with broken customers, and broken line numbers.
_ALTERED = """
altered_once as (
  select o_orderkey, o_custkey, o_orderstatus,
         case when o_orderkey % 89 = 7 then o_totalprice + 1 else o_totalprice end as o_totalprice,
         o_orderdate, o_orderpriority
  from orders where o_orderkey % 97 <> 5),
altered as (
  select * from altered_once union all select * from altered_once where o_orderkey % 101 = 3)"""
_BROKEN_ORDERS = """
broken_orders as (
  select o_orderkey, case when o_orderkey % 127 = 0 then null
                          when o_orderkey % 113 = 0 then o_custkey + 1000000
                          else o_custkey end as o_custkey
  from orders)"""
_BROKEN_LINES = """
broken_lines as (
  select l_orderkey, l_partkey, case when l_partkey % 50 = 0 then null
                                     when l_partkey % 77 = 0 then l_linenumber + 100
                                     else l_linenumber end as l_linenumber
  from lineitem)"""


def _canonical(column: str, kind: str) -> str:
    if kind == "cents":
        return f"cast(cast(round({column} * 100) as bigint) as varchar)"
    if kind == "time":
        return f"cast(epoch_us({column}) as varchar)"
    return f"cast({column} as varchar)"


def _row_text(columns: dict[str, str]) -> str:
    fields = []
    for column, kind in columns.items():
        value = _canonical(column, kind)
        fields.append(f"coalesce(cast(length({value}) as varchar) || ':' || {value}, 'N')")
    return " || ".join(fields)


def _hash(columns: dict[str, str]) -> str:
    return f"cast('0x' || substr(md5({_row_text(columns)}), 1, 15) as bigint)"


def _digest(columns: dict[str, str]) -> str:
    h = _hash(columns)
    return (
        f"count(*) as row_count, coalesce(bit_xor({h}), 0) as hash_xor, "
        f"cast(coalesce(sum(cast({h} as decimal(38,0))), 0) as varchar) as hash_sum"
    )


def _digest_text(rows: str, columns: dict[str, str]) -> str:
    return (
        "(select cast(row_count as varchar) || ':' || lower(to_hex(hash_xor)) || ':' || hash_sum "
        f"from (select {_digest(columns)} from {rows}))"
    )


def _chunk_id(table: str, number: str) -> str:
    return f"printf('%s-%06d', '{table}', {number})"


def _order_chunk(rows: str, size: int) -> str:
    return f"((o_orderkey - (select min(o_orderkey) from {rows})) // {size} + 1)"


def _digest_tree(name: str, rows: str, size: int, fanout: int, most: int = 8) -> str:
    """Digests of ranges and of ``fanout`` nodes below each, up to the first level of one node,
    under the name ``<name>_tree``."""
    whole = "row_count || ':' || hash_xor || ':' || hash_sum"
    found = [f"""{name}0 as (
  select *, sha256({whole}) as digest
  from (select {_order_chunk(rows, size)} as node, {_digest(_ORDER_COLUMNS)} from {rows} group by 1))"""]
    for level in range(1, most):
        found.append(f"""{name}{level} as (
  select node // {fanout} as node, cast(sum(row_count) as bigint) as row_count, bit_xor(hash_xor) as hash_xor,
         cast(sum(cast(hash_sum as decimal(38,0))) as varchar) as hash_sum,
         sha256(string_agg(node || '=' || digest, ',' order by node)) as digest
  from {name}{level - 1} group by 1)""")
    levels = " union all ".join(f"select {i} as level, * from {name}{i}" for i in range(most))
    found.append(f"""{name}_all as ({levels}),
{name}_tree as (
  select * from {name}_all
  where level <= (select min(level) from (select level from {name}_all group by level having max(node) = 0)))""")
    return ",\n".join(found)


def _quantile_plan(table: str, key: str, size: int) -> str:
    """Cuts at every ``size``-th row in key order; a key at two cuts is cut off on both sides."""
    return f"""
select '{table}' as table_name, chunk_no, {_chunk_id(table, "chunk_no")} as chunk_id, '{key}' as column_name,
       low_key, high_key,
       if(chunk_no > 0, '{key} >= ' || low_key || ' and {key} <= ' || high_key, '{key} is null') as where_clause,
       'QUANTILE' as strategy, row_count
from (
  with ranked as (
    select {key} as k, row_number() over (order by {key}) as place, count(*) over () as total
    from {table} where {key} is not null),
  cuts as (select k, count(*) as often from ranked where place % {size} = 0 and place < total group by k),
  ends as (select k, 0 as side from cuts union all select k, -1 from cuts where often > 1)
  select if(t.{key} is null, 0, 1 + (select count(*) from ends e where (e.k, e.side) < (t.{key}, 0))) as chunk_no,
         cast(min(t.{key}) as bigint) as low_key, cast(max(t.{key}) as bigint) as high_key, count(*) as row_count
  from {table} t group by 1)"""


def _quantile_plans() -> str:
    return " union all ".join(
        [_quantile_plan("orders", "o_custkey", 500), _quantile_plan("documents", "n_chars", 100),
         _quantile_plan("lineitem", "l_linenumber", 2000)]
    )


def _hits(text: str) -> dict[str, str]:
    plain = f"regexp_replace(lower({text}), '\\s+', ' ', 'g')"
    return {
        name: "(" + " or ".join(f"contains({plain}, '{lit.lower()}')" for lit in literals) + ")"
        for name, literals in TEXT_PATTERNS.items()
    }


def _finding(code, severity, table, column, description, count, stop="false") -> str:
    return (
        f"select '{code}' as code, '{severity}' as severity, '{table}' as object_name, "
        f"'{column}' as column_name, '{description}' as description, "
        f"cast(({count}) as bigint) as bad_rows, {stop} as should_stop"
    )


def _chunk_ledger(size: int) -> str:
    """Rows of both sides per chunk of the orders, under the name ``ledger``."""
    return f"""{_ALTERED},
reads as (select {_order_chunk("orders", size)} as chunk_no, count(*) as n from orders group by 1),
writes as (select {_order_chunk("altered", size)} as chunk_no, count(*) as n from altered group by 1),
ledger as (
  select 'orders' as table_name, chunk_no, {_chunk_id("orders", "chunk_no")} as chunk_id,
         coalesce(r.n, 0) as rows_read, coalesce(w.n, 0) as rows_written,
         case when coalesce(r.n, 0) = coalesce(w.n, 0) then 'SUCCESS' else 'FAILED' end as status
  from reads r full join writes w using (chunk_no))"""


def _range_plan(table: str, key: str, size: int) -> str:
    return f"""
select '{table}' as table_name, chunk_no, {_chunk_id(table, "chunk_no")} as chunk_id,
       '{key}' as column_name,
       low + (chunk_no - 1) * {size} as low_key,
       least(low + chunk_no * {size} - 1, high) as high_key,
       '{key} >= ' || cast(low + (chunk_no - 1) * {size} as varchar) || ' and {key} <= '
         || cast(least(low + chunk_no * {size} - 1, high) as varchar) as where_clause,
       'NUMERIC_PRIMARY_KEY' as strategy, row_count
from (select ({key} - (select min({key}) from {table})) // {size} + 1 as chunk_no, count(*) as row_count
      from {table} group by 1),
     (select min({key}) as low, max({key}) as high from {table})"""


def _numbered_plan(table: str, strategy: str, column: str, size: int, order: str) -> str:
    return f"""
select '{table}' as table_name, chunk_no, {_chunk_id(table, "chunk_no")} as chunk_id,
       '{column}' as column_name,
       'row_no >= ' || cast(min(rn) as varchar) || ' and row_no <= ' || cast(max(rn) as varchar)
         as where_clause,
       '{strategy}' as strategy, count(*) as row_count
from (select rn, (rn - 1) // {size} + 1 as chunk_no
      from (select row_number() over (order by {order}) as rn from {table}))
group by chunk_no"""


def _balance(table: str, key: str, size: int) -> str:
    parts = []
    for split, bucket in (
        ("RANGE", f"({key} - low) // {size}"),
        ("HASH", f"{_hash({key: 'number'})} % n"),
    ):
        parts.append(f"""
select '{table}' as table_name, '{key}' as column_name, '{split}' as split,
       cast(max(n) as bigint) as chunks, count(*) as filled_chunks,
       cast(sum(c) as bigint) as row_count, cast(max(c) as bigint) as largest_chunk,
       cast(max(c) * 100 * max(n) // sum(c) as bigint) as skew_percent
from (select {bucket} as bucket, max(n) as n, count(*) as c
      from {table}, (select min({key}) as low, (max({key}) - min({key})) // {size} + 1 as n from {table})
      group by 1)""")
    return " union all ".join(parts)


def _duplicates(rows: str, columns: str) -> str:
    first, *rest = columns.split(", ")
    set_ = " and ".join(f"{c} is not null" for c in (first, *rest))
    return (
        f"select count(*) as duplicate_groups from (select {columns} from {rows} where {set_} "
        f"group by {columns} having count(*) > 1)"
    )


def _candidate(table: str, rows: str, columns: str) -> str:
    names = columns.split(", ")
    complete = " and ".join(f"{c} is not null" for c in names)
    return f"""
select '{table}' as table_name, '{columns}' as key_columns,
       (select count(*) from {rows}) as row_count,
       (select count(*) from {rows} where not ({complete})) as null_rows,
       (select count(*) from (select distinct {columns} from {rows} where {complete})) as distinct_keys,
       (select max(n) from (select count(*) as n from {rows} where {complete} group by {columns}))
         as most_copies,
       (select count(*) from {rows} where not ({complete})) = 0
         and (select count(*) from {rows})
             = (select count(*) from (select distinct {columns} from {rows} where {complete})) as is_key"""


def _sample_message(size: int, good: str, left: str, right: str) -> str:
    return (
        f"'Compared up to {size} rows. sourceRows=' || cast(({left}) as varchar) || ' targetRows=' || "
        f"cast(({right}) as varchar) || case when {good} then '' else ' - mismatch found!' end"
    )


_ORDER_SAMPLES = f"""{_ALTERED},
left_sample as (select * from orders
  order by o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority limit 100),
right_sample as (select * from altered
  order by o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority limit 100),
sampled as (
  select (select count(*) from (select * from left_sample except all select * from right_sample))
       + (select count(*) from (select * from right_sample except all select * from left_sample)) as n)"""


def _validation_suite() -> str:
    """Rows ``name, status, object_name, message`` after a WITH that defines _ORDER_SAMPLES."""
    left, right = _digest_text("orders", _ORDER_COLUMNS), _digest_text("altered", _ORDER_COLUMNS)
    rows = "(select count(*) from {})".format
    good = "(select n from sampled) = 0"
    samples = _sample_message(
        100, good, "select count(*) from left_sample", "select count(*) from right_sample"
    )
    return f"""
select 'row-count' as name,
       case when {rows("orders")} = {rows("altered")} then 'PASS' else 'FAIL' end as status,
       'orders' as object_name,
       'source=' || cast({rows("orders")} as varchar) || ' target=' || cast({rows("altered")} as varchar)
         as message
union all
select 'checksum', case when {left} = {right} then 'PASS' else 'FAIL' end, 'orders',
       'source=' || {left} || ' target=' || {right}
union all
select 'sample-row', case when {good} then 'PASS' else 'FAIL' end, 'orders', {samples}
union all
select 'duplicate-key', case when duplicate_groups = 0 then 'PASS' else 'FAIL' end, 'orders.pk_orders',
       'duplicateGroups=' || cast(duplicate_groups as varchar)
from ({_duplicates("altered", "o_orderkey")})
union all
select 'foreign-key-orphans', case when n = 0 then 'PASS' else 'FAIL' end, 'orders.fk_customer',
       'orphans=' || cast(n as varchar)
from (select count(*) as n from altered left join customer on o_custkey = c_custkey
      where o_custkey is not null and c_custkey is null)"""


def _required_nulls() -> str:
    text = "null in a required column"
    return " union all ".join(
        _finding("REQUIRED-COLUMN", "BLOCKER", "orders", column, text, count, f"({count}) > 0")
        for column, count in (
            ("O_ORDERKEY", "select count(*) from broken_orders where o_orderkey is null"),
            ("O_CUSTKEY", "select count(*) from broken_orders where o_custkey is null"),
            ("O_CLERK", "select count(*) from broken_orders"),
        )
    )


_EXCLUDED_DEPENDENTS = """
select item, 'NEEDS_REVIEW' as status,
       'References excluded table(s): ' || string_agg(needs, ', ' order by place) as reason
from (
  select c_name as item, 0 as place, n_name as needs from customer join nation on c_nationkey = n_nationkey
  union all
  select c_name, 1, r_name from customer join nation on c_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey
  union all
  select c_name, 2, c_mktsegment from customer) edges
where lower(needs) in ('asia', 'nation_3', 'machinery')
group by item"""


def _pattern_flags() -> str:
    hits = _hits("text")
    listed = ", ".join(f"case when {test} then '{name}' end" for name, test in hits.items())
    counted = " + ".join(f"cast({test} as bigint)" for test in hits.values())
    return f"""
select doc_id, {counted} as hit_count, concat_ws(', ', {listed}) as hits,
       case when {counted} > 0 then 'NEEDS_REVIEW' else 'READY' end as status
from documents"""


def _profile(table: str, column: str) -> str:
    return f"""
select 'RDN-004' as code, 'MEDIUM' as severity, '{table}' as object_name, '{column}' as column_name,
       count(*) as row_count, count(*) - count({column}) as null_rows, max(length({column})) as longest,
       cast(sum(length({column})) as bigint) as total_length,
       count(*) filter (where length({column}) > 4000) as bad_rows, false as should_stop
from {table}"""


def _histogram(table: str, column: str) -> str:
    steps = (0, 100, 1000, 4000, 10000, 100000, 1000000)
    classes = " ".join(f"when length({column}) >= {s} then {s}" for s in reversed(steps))
    return (
        f"select '{table}' as object_name, '{column}' as column_name, "
        f"cast(case {classes} end as bigint) as from_length, count(*) as value_count "
        f"from {table} where {column} is not null group by 3"
    )


def twins() -> dict[str, str]:
    orders, altered = _digest_text("orders", _ORDER_COLUMNS), _digest_text("altered", _ORDER_COLUMNS)
    customer = _digest_text("customer", _CUSTOMER_COLUMNS)
    plain_documents = {c: k for c, k in _DOCUMENT_COLUMNS.items() if c != "text"}
    documents = _digest_text("documents", plain_documents)
    line_order = (
        "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
        "l_tax, l_returnflag, l_linestatus, l_shipdate"
    )
    document_hits, page_hits = _hits("text"), _hits("html")
    sql = {
        "scan_projected": "select o_orderkey, o_custkey, o_totalprice from orders",
        "scan_chunk": """
with bounds as (select min(o_orderkey) as low, (max(o_orderkey) - min(o_orderkey) + 1) // 4 as q from orders)
select o_orderkey, o_totalprice from orders, bounds
where o_orderkey >= low + q and o_orderkey <= low + 2 * q - 1""",
        "rename_reserved": """
select o_orderkey as order_, o_custkey as user_, o_totalprice as limit_, o_orderstatus as status from orders""",
        "convert_on_copy": """
select o_orderkey, cast(cast(o_orderdate as date) as timestamp) as order_day,
       'INTERVAL ''' || cast(date_diff('day', timestamp '1990-01-01', o_orderdate) as varchar)
         || ' 00:00:00'' DAY TO SECOND' as order_age
from orders""",
        "key_bounds": """
select 'orders' as table_name, min(o_orderkey) as min_key, max(o_orderkey) as max_key from orders
union all select 'events', min(event_id), max(event_id) from events
union all select 'conversations', 1, count(*) from conversations
union all select 'lineitem', 1, count(*) from lineitem""",
        "chunk_plan_range": _range_plan("orders", "o_orderkey", 1000),
        "chunk_plan_dense": """
with bounds as (select min(n_chars) as low, max(n_chars) as high from documents),
ranges as (select unnest(generate_series(1, (high - low) // 1000 + 1)) as chunk_no, low, high from bounds)
select 'documents' as table_name, chunk_no, printf('%s-%06d', 'documents', chunk_no) as chunk_id,
       'n_chars' as column_name, low + (chunk_no - 1) * 1000 as low_key,
       least(low + chunk_no * 1000 - 1, high) as high_key,
       'n_chars >= ' || cast(low + (chunk_no - 1) * 1000 as varchar) || ' and n_chars <= '
         || cast(least(low + chunk_no * 1000 - 1, high) as varchar) as where_clause,
       'NUMERIC_PRIMARY_KEY' as strategy,
       (select count(*) from documents
        where n_chars between low + (chunk_no - 1) * 1000 and low + chunk_no * 1000 - 1) as row_count
from ranges""",
        "chunk_plan_quantile": _quantile_plans(),
        "quantile_balance": f"""
select table_name, column_name, count(*) as chunks, cast(sum(row_count) as bigint) as row_count,
       max(row_count) as largest_chunk, max(if(low_key <> high_key, row_count, 0)) as largest_of_several_keys,
       cast(max(row_count) * 100 * count(*) // sum(row_count) as bigint) as skew_percent
from ({_quantile_plans()}) where chunk_no > 0 group by 1, 2""",
        "chunk_plan_rownum": f"""
select chunk_no, {_chunk_id("conversations", "chunk_no")} as chunk_id,
       min(rn) as first_row, max(rn) as last_row,
       arg_min(conv_id, rn) as first_conv, arg_min(turn, rn) as first_turn,
       arg_max(conv_id, rn) as last_conv, arg_max(turn, rn) as last_turn, count(*) as row_count
from (select *, (rn - 1) // 50 + 1 as chunk_no
      from (select conv_id, turn, row_number() over (order by conv_id, turn) as rn from conversations))
group by chunk_no""",
        "chunk_plan_keyless": f"""
select 'lineitem' as table_name, chunk_no, {_chunk_id("lineitem", "chunk_no")} as chunk_id,
       'ROWID' as column_name, min(rn) as first_row, max(rn) as last_row, 'ROWID' as strategy,
       count(*) as row_count
from (select rn, (rn - 1) // 5000 + 1 as chunk_no
      from (select row_number() over () as rn from lineitem))
group by chunk_no""",
        "chunk_plan_auto": f"""
select table_name, chunk_no, chunk_id, column_name, where_clause, strategy, row_count
from ({_range_plan("orders", "o_orderkey", 5000)})
union all {_numbered_plan("conversations", "ROW_NUMBER", "conv_id, turn", 100, "conv_id, turn")}
union all {_numbered_plan("lineitem", "ROWID", "ROWID", 5000, line_order)}""",
        "chunk_balance": " union all ".join(
            (
                _balance("orders", "o_custkey", 100),
                _balance("events", "event_id", 1000),
                _balance("documents", "n_chars", 1000),
            )
        ),
        "copy_counts": f"""
select table_name, chunk_id, where_clause as chunk_range, row_count as rows_read,
       row_count as rows_written, 'SUCCESS' as status
from ({_range_plan("orders", "o_orderkey", 1000)})""",
        "copy_restart": f"""
with plan as ({_range_plan("orders", "o_orderkey", 500)}),
broken as (select {_chunk_id("orders", "n")} as error_chunk
           from (select max(o_orderkey - low) // 500 + 1 as n
                 from orders, (select min(o_orderkey) as low from orders) where o_orderkey % 7 = 3))
select table_name, chunk_id, cast(1 + if(chunk_id = error_chunk, 1, 0) as bigint) as records,
       cast(1 as bigint) as copies, cast(if(chunk_id = error_chunk, 1, 0) as bigint) as failures,
       row_count as rows_read, row_count as rows_written, if(chunk_id = error_chunk, error_chunk, null) as error_chunk
from plan, broken""",
        "chunk_ledger": f"with {_chunk_ledger(100)} select * from ledger",
        "row_capped_chunks": f"""
with plan as (
  select table_name, chunk_id, row_count from ({_range_plan("orders", "o_orderkey", 500)})
  union all select table_name, chunk_id, row_count from ({_range_plan("events", "event_id", 500)})
  union all select table_name, chunk_id, row_count from ({_range_plan("customer", "c_custkey", 500)}))
select table_name, chunk_id, row_count, cast(rows_before as bigint) as rows_before,
       case when rows_before < 4000 then 'PENDING' else 'SKIPPED' end as status
from (select *, coalesce(sum(row_count) over (partition by table_name order by chunk_id
                rows between unbounded preceding and 1 preceding), 0) as rows_before from plan)""",
        "latest_chunk_state": """
with records as (
  select 'run-1' as run_id, o_orderpriority as table_name, printf('%s-%06d', 'c', o_custkey) as chunk_id,
         o_orderkey as rows_read, cast(o_orderkey as varchar) as chunk_range,
         case o_orderstatus when 'F' then 'FAILED' when 'O' then 'RUNNING' else 'SUCCESS' end as status,
         o_orderdate as moment
  from orders),
ranked as (
  select *, row_number() over (partition by table_name, chunk_id order by moment desc, rows_read desc) as newest,
         first_value(chunk_range) over w as first_range, first_value(moment) over w as first_moment
  from records window w as (partition by table_name, chunk_id order by moment, rows_read))
select run_id, table_name, chunk_id, rows_read, first_range as chunk_range, status,
       first_moment as started_at, moment as completed_at
from ranked where newest = 1""",
        "pending_chunks": f"""
with {_chunk_ledger(25)},
plan as ({_range_plan("orders", "o_orderkey", 25)})
select table_name, chunk_id, where_clause, row_count from plan
where not exists (select 1 from ledger l where l.chunk_id = plan.chunk_id and l.status = 'SUCCESS')""",
        "target_row_counts": " union all ".join(
            f"select '{t}' as table_name, count(*) as row_count, count(*) = 0 as is_empty from {t}"
            for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
        ),
        "row_count_check": f"""
with {_ALTERED},
counts as (select (select count(*) from orders) as s, (select count(*) from altered) as t)
select 'row-count' as name, case when s = t then 'PASS' else 'FAIL' end as status,
       'orders' as object_name, 'source=' || cast(s as varchar) || ' target=' || cast(t as varchar) as message
from counts""",
        "checksum_table": f"""
with {_ALTERED}
select 'orders' as table_name, {_digest(_ORDER_COLUMNS)} from orders
union all select 'orders_altered', {_digest(_ORDER_COLUMNS)} from altered
union all select 'events', {_digest(_EVENT_COLUMNS)} from events
union all select 'documents', {_digest(_DOCUMENT_COLUMNS)} from documents""",
        "checksum_check": f"""
with {_ALTERED}
select 'checksum' as name, case when {orders} = {altered} then 'PASS' else 'FAIL' end as status,
       'orders' as object_name, 'source=' || {orders} || ' target=' || {altered} as message
union all
select 'checksum', 'PASS', 'customer', 'source=' || {customer} || ' target=' || {customer}
union all
select 'checksum', 'WARNING', 'documents',
       'source=' || {documents} || ' target=' || {documents} || ' (Skipped LOB columns: [text])'""",
        "checksum_native": f"""
with {_ALTERED},
changed as (
  select (select count(*) from (select * from orders except all select * from altered))
       + (select count(*) from (select * from altered except all select * from orders)) as n)
select 'checksum' as name, case when n = 0 then 'PASS' else 'FAIL' end as status, 'orders' as object_name
from changed
union all select 'checksum', 'PASS', 'customer'""",
        "checksum_by_chunk": f"""
with {_ALTERED},
s as (select {_order_chunk("orders", 50)} as chunk_no, {_digest(_ORDER_COLUMNS)} from orders group by 1),
t as (select (o_orderkey - (select min(o_orderkey) from orders)) // 50 + 1 as chunk_no,
             {_digest(_ORDER_COLUMNS)} from altered group by 1)
select 'orders' as table_name, {_chunk_id("orders", "chunk_no")} as chunk_id,
       coalesce(s.row_count, 0) as source_rows, coalesce(s.hash_xor, 0) as source_xor,
       coalesce(s.hash_sum, '0') as source_sum,
       coalesce(t.row_count, 0) as target_rows, coalesce(t.hash_xor, 0) as target_xor,
       coalesce(t.hash_sum, '0') as target_sum,
       case when s.row_count = t.row_count and s.hash_xor = t.hash_xor and s.hash_sum = t.hash_sum
            then 'PASS' else 'FAIL' end as status
from s full join t using (chunk_no)""",
        "fingerprint_drift": f"""
with {_ALTERED},
s as (select {_order_chunk("orders", 50)} as chunk_no, {_digest(_ORDER_COLUMNS)} from orders group by 1),
t as (select (o_orderkey - (select min(o_orderkey) from orders)) // 50 + 1 as chunk_no,
             {_digest(_ORDER_COLUMNS)} from altered group by 1)
select 'orders' as table_name, {_chunk_id("orders", "chunk_no")} as chunk_id,
       s.row_count as baseline_rows, t.row_count as current_rows,
       case when s.row_count is null then 'NEW' when t.row_count is null then 'MISSING'
            when s.row_count = t.row_count and s.hash_xor = t.hash_xor and s.hash_sum = t.hash_sum
            then 'SAME' else 'CHANGED' end as drift
from s full join t using (chunk_no)""",
        "fingerprint_tree": f"""
with {_digest_tree("leaf", "orders", 20, 8)}
select level, node, row_count, hash_xor, hash_sum, digest from leaf_tree""",
        "baseline_drift": f"""
with changed as (
  select * replace (
           case when o_orderkey % 1009 = 7 then -o_orderkey when o_orderkey % 1009 = 8 then null
                else o_orderkey end as o_orderkey,
           o_totalprice + case when o_orderkey between 200 and 210 then 1 else 0 end as o_totalprice)
  from orders where o_orderkey <> (select min(o_orderkey) from orders)),
s as (select {_order_chunk("orders", 20)} as chunk_no, {_digest(_ORDER_COLUMNS)} from orders group by 1),
t as (select case when o_orderkey >= (select min(o_orderkey) from orders)
                  then (o_orderkey - (select min(o_orderkey) from orders)) // 20 + 1 else 0 end as chunk_no,
             {_digest(_ORDER_COLUMNS)} from changed group by 1)
select 'orders' as table_name, {_chunk_id("orders", "chunk_no")} as chunk_id,
       s.row_count as baseline_rows, t.row_count as current_rows,
       case when s.row_count is null then 'NEW' when t.row_count is null then 'MISSING' else 'CHANGED' end as drift
from s full join t using (chunk_no)
where (s.row_count, s.hash_xor, s.hash_sum) is distinct from (t.row_count, t.hash_xor, t.hash_sum)""",
        "sample_rows": """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
from orders order by o_orderkey limit 100""",
        "sample_diff": f"""
with {_ORDER_SAMPLES},
line_sample as (select * from lineitem order by {line_order} limit 250)
select 'sample-row' as name, case when (select n from sampled) = 0 then 'PASS' else 'FAIL' end as status,
       'orders' as object_name,
       {_sample_message(100, "(select n from sampled) = 0", "select count(*) from left_sample",
                        "select count(*) from right_sample")} as message
union all
select 'sample-row', 'PASS', 'lineitem',
       {_sample_message(250, "true", "select count(*) from line_sample", "select count(*) from line_sample")}""",
        "row_diff_keyed": f"""
with {_ALTERED},
l as (
  select o_orderkey, count(*) as n, count(distinct o_totalprice) as versions,
         any_value(o_custkey) as c1, any_value(o_orderstatus) as c2, any_value(o_totalprice) as c3,
         any_value(o_orderdate) as c4, any_value(o_orderpriority) as c5
  from (select * from orders except all select * from altered) group by 1),
r as (
  select o_orderkey, count(*) as n, count(distinct o_totalprice) as versions,
         any_value(o_custkey) as c1, any_value(o_orderstatus) as c2, any_value(o_totalprice) as c3,
         any_value(o_orderdate) as c4, any_value(o_orderpriority) as c5
  from (select * from altered except all select * from orders) group by 1)
select o_orderkey,
       case when r.n is null then 'ONLY_SOURCE' when l.n is null then 'ONLY_TARGET' else 'CHANGED' end
         as difference,
       coalesce(l.n, 0) - least(coalesce(l.n, 0), coalesce(r.n, 0)) as only_source_rows,
       coalesce(r.n, 0) - least(coalesce(l.n, 0), coalesce(r.n, 0)) as only_target_rows,
       least(coalesce(l.n, 0), coalesce(r.n, 0)) as changed_rows,
       case when l.versions = 1 and r.versions = 1 then
         concat_ws(', ', case when l.c1 is distinct from r.c1 then 'o_custkey' end,
                   case when l.c2 is distinct from r.c2 then 'o_orderstatus' end,
                   case when l.c3 is distinct from r.c3 then 'o_totalprice' end,
                   case when l.c4 is distinct from r.c4 then 'o_orderdate' end,
                   case when l.c5 is distinct from r.c5 then 'o_orderpriority' end)
       end as changed_columns
from l full join r using (o_orderkey)""",
        "row_diff_multiset": f"""
with {_ALTERED}
select o_orderkey, o_totalprice, 'source' as side, count(*) as copies
from (select o_orderkey, o_totalprice from orders except all select o_orderkey, o_totalprice from altered)
group by 1, 2
union all
select o_orderkey, o_totalprice, 'target' as side, count(*) as copies
from (select o_orderkey, o_totalprice from altered except all select o_orderkey, o_totalprice from orders)
group by 1, 2""",
        "duplicate_keys": f"""
with {_ALTERED}, {_BROKEN_LINES}
select 'orders_altered' as table_name, duplicate_groups from ({_duplicates("altered", "o_orderkey")})
union all
select 'lineitem_broken', duplicate_groups from ({_duplicates("broken_lines", "l_orderkey, l_linenumber")})""",
        "duplicate_groups": """
select l_orderkey, l_linenumber, count(*) as copies from lineitem
where l_orderkey is not null and l_linenumber is not null
group by 1, 2 having count(*) > 1""",
        "key_candidates": f"with {_BROKEN_LINES}"
        + " union all ".join(
            (
                _candidate("lineitem", "broken_lines", "l_orderkey, l_linenumber"),
                _candidate("lineitem", "broken_lines", "l_orderkey, l_partkey"),
                _candidate("orders", "orders", "o_orderkey"),
                _candidate("orders", "orders", "o_custkey, o_orderdate"),
            )
        ),
        "fk_orphans": f"""
with {_BROKEN_ORDERS}
select count(*) as orphans from broken_orders left join customer on o_custkey = c_custkey
where o_custkey is not null and c_custkey is null""",
        "orphan_keys": f"""
with {_BROKEN_ORDERS}
select o_custkey, count(*) as child_rows from broken_orders
where o_custkey is not null and o_custkey not in (select c_custkey from customer) group by 1""",
        "fk_orphans_composite": f"""
with {_BROKEN_LINES}
select count(*) as orphans from broken_lines c
where l_orderkey is not null and l_linenumber is not null and not exists (
  select 1 from lineitem p where p.l_orderkey = c.l_orderkey and p.l_linenumber = c.l_linenumber)""",
        "fk_orphans_full": f"""
with {_BROKEN_LINES},
marked as (
  select l_orderkey is not null and l_linenumber is not null and not exists (
           select 1 from lineitem p where p.l_orderkey = c.l_orderkey and p.l_linenumber = c.l_linenumber)
           as missing,
         (l_orderkey is null or l_linenumber is null)
           and (l_orderkey is not null or l_linenumber is not null) as partial
  from broken_lines c)
select count(*) filter (where missing) as simple_orphans,
       count(*) filter (where missing or partial) as full_orphans
from marked""",
        "excluded_parent_impact": """
select c_nationkey, count(*) as child_rows from customer
where c_nationkey in (select n_nationkey from nation join region on n_regionkey = r_regionkey
                      where r_name = 'ASIA')
group by 1""",
        "excluded_parent_findings": f"""
with {_BROKEN_ORDERS},
hit as (select count(*) as n from broken_orders join customer on o_custkey = c_custkey where c_acctbal < 0)
select 'RDN-008' as code, 'BLOCKER' as severity, 'orders' as object_name, 'o_custkey' as column_name,
       'fk_customer refers to excluded rows of customer' as description, n as bad_rows, n > 0 as should_stop
from hit
union all
select 'RDN-008', 'BLOCKER', 'customer', 'c_nationkey', 'fk_nation refers to excluded rows of nation',
       0, false""",
        "excluded_dependents": _EXCLUDED_DEPENDENTS,
        "exclusion_flags": """
select c_custkey, c_mktsegment,
       case when lower(c_mktsegment) in ('building', 'machinery') then 'EXCLUDED' else 'READY' end as status,
       case when lower(c_mktsegment) in ('building', 'machinery') then 'Excluded by configuration' end as reason
from customer""",
        "exclusion_flags_by_table": """
with named as (
  select s_suppkey, lower(n_name) as nation,
         n_nationkey in (select c_nationkey from customer where c_acctbal < -900) as hit
  from supplier join nation on s_nationkey = n_nationkey)
select s_suppkey, nation, case when hit then 'EXCLUDED' else 'READY' end as status,
       case when hit then 'Excluded by configuration' end as reason
from named""",
        "fk_closed_subset": f"""
with {_BROKEN_ORDERS},
c as (select * from customer where c_mktsegment = 'BUILDING'),
o as (select * from broken_orders where o_custkey is null or o_custkey in (select c_custkey from c)),
l as (select * from lineitem where l_orderkey is null or l_orderkey in (select o_orderkey from o))
select 'customer' as table_name, {_digest({"c_custkey": "number"})} from c
union all select 'orders', {_digest({"o_orderkey": "number"})} from o
union all select 'lineitem', {_digest({"l_orderkey": "number", "l_partkey": "number"})} from l""",
        "pattern_flags": _pattern_flags(),
        "pattern_findings": " union all ".join(
            _finding(
                "RDN-007", "HIGH", table, column, name, f"select count(*) from {table} where {hits[name]}"
            )
            for table, column, hits in (("documents", "text", document_hits), ("pages", "html", page_hits))
            for name in hits
        ),
        "whole_value_flags": " union all ".join(
            _finding(
                "RDN-007", "LOW", "documents", column, regex,
                f"select count(*) from documents where regexp_full_match(trim({column}), '(?i)(?:{regex})')",
            )
            for column, regex in (("source", r"SRC1\d?"), ("lang", "e[ns]"), ("text", "[a-z ,.]+"))
        ),
        "type_fit": " union all ".join(
            (
                _finding("RDN-010", "MEDIUM", "orders", "o_orderkey", "smallint",
                         "select count(*) from orders where o_orderkey * 10 not between -32768 and 32767"),
                _finding("RDN-010", "MEDIUM", "orders", "o_totalprice", "decimal(7,1)",
                         "select count(*) from orders where abs(o_totalprice) >= 999999.95 "
                         "or cast(cast(o_totalprice as varchar) as decimal(38,18)) "
                         "<> round(cast(cast(o_totalprice as varchar) as decimal(38,18)), 1)"),
                _finding("RDN-010", "MEDIUM", "orders", "o_orderpriority", "varchar(8)",
                         "select count(*) from orders where length(o_orderpriority) > 8"),
                _finding("RDN-009", "BLOCKER", "orders", "o_orderdate", "BFILE is not supported",
                         "select count(*) from orders where o_orderdate is not null",
                         "(select count(*) from orders where o_orderdate is not null) > 0"),
                _finding("RDN-010", "MEDIUM", "events", "props", "smallint",
                         "select count(*) from events where event_type = 'error' or "
                         "cast(json_extract_string(props, '$.k') as bigint) not between -32768 and 32767"),
                _finding("RDN-010", "MEDIUM", "events", "value", "int",
                         "select count(*) from events where value <> floor(value) "
                         "or value not between -2147483648 and 2147483647"),
                _finding("RDN-010", "MEDIUM", "documents", "text", "varchar(4000)",
                         "select count(*) from documents where length(text) > 4000"),
            )
        ),
        "lob_profile": " union all ".join(
            _profile(t, c)
            for t, c in (
                ("documents", "text"), ("documents", "source"), ("pages", "html"), ("pages", "url"),
                ("conversations", "text"),
            )
        ),
        "lob_histogram": " union all ".join(
            _histogram(t, c)
            for t, c in (("documents", "text"), ("pages", "html"), ("pages", "url"), ("conversations", "text"))
        ),
        "required_column_nulls": f"with {_BROKEN_ORDERS} {_required_nulls()}",
        "validation_suite": f"with {_ORDER_SAMPLES} {_validation_suite()}",
        "status_rollup": f"""
with {_ORDER_SAMPLES}, {_BROKEN_ORDERS},
suite as ({_validation_suite()}),
findings as ({_required_nulls()}),
review as (select count(*) as n from ({_pattern_flags()}) where status = 'NEEDS_REVIEW'),
stop as (select bool_or(should_stop) as should_stop from findings)
select 'orders' as table_name,
       case when count(*) filter (where status = 'FAIL') > 0 then 'FAIL'
            when (select n from review) > 0 then 'WARNING' else 'PASS' end as status,
       count(*) as checks, count(*) filter (where status = 'FAIL') as failed,
       (select should_stop from stop) as should_stop
from suite
union all
select 'customer', case when (select n from review) > 0 then 'WARNING' else 'PASS' end, 1, 0,
       (select should_stop from stop)""",
        "report_rows": f"""
with {_chunk_ledger(500)}, {_BROKEN_ORDERS},
{_ORDER_SAMPLES.removeprefix(_ALTERED).lstrip(",").strip()},
suite as ({_validation_suite()}),
findings as ({_required_nulls()}),
decisions as ({_EXCLUDED_DEPENDENTS})
select 'VALIDATION' as record_type, name, status, object_name as object, '' as chunk,
       '' as database_code, '' as sql_text, message
from suite
union all
select 'ERROR', 'data-load', 'RETRY_OR_MANUAL_REVIEW', table_name, chunk_id, '', '',
       'read=' || cast(rows_read as varchar) || ', written=' || cast(rows_written as varchar)
from ledger where status = 'FAILED'
union all
select 'READINESS', code, severity, object_name, '', '', '',
       description || ' | Column: ' || column_name || ' | Rows: ' || cast(bad_rows as varchar)
from findings
union all
select 'EXCLUSION', item, status, 'ROW', '', '', '', reason from decisions""",
        "full_load": f"""
select 'row-count' as name, 'PASS' as status, t as object_name,
       'source=' || cast(n as varchar) || ' target=' || cast(n as varchar) as message
from (select 'orders' as t, count(*) as n from orders union all select 'customer', count(*) from customer)
union all
select 'checksum', 'PASS', t, 'source=' || d || ' target=' || d
from (select 'orders' as t, {orders} as d union all select 'customer', {customer})
union all
select 'sample-row', 'PASS', t,
       'Compared up to 100 rows. sourceRows=' || cast(n as varchar) || ' targetRows=' || cast(n as varchar)
from (select 'orders' as t, least(100, (select count(*) from orders)) as n
      union all select 'customer', least(100, (select count(*) from customer)))
union all select 'duplicate-key', 'PASS', 'orders.pk_orders', 'duplicateGroups=0'
union all select 'duplicate-key', 'PASS', 'customer.pk_customer', 'duplicateGroups=0'
union all select 'foreign-key-orphans', 'PASS', 'orders.fk_customer', 'orphans=0'""",
        "load_existing": f"""
with {_BROKEN_LINES},
marked as (
  select l_orderkey is not null and l_linenumber is not null and not exists (
           select 1 from lineitem p where p.l_orderkey = c.l_orderkey and p.l_linenumber = c.l_linenumber)
         or (l_orderkey is null) <> (l_linenumber is null) as bad
  from broken_lines c),
n as (select count(*) as n from lineitem)
select 'run' as name, 'FAIL' as status, 'refused' as object_name,
       'TargetNotEmpty: target lineitem contains ' || n || ' rows' as message from n
union all select 'row-count', 'PASS', 'lineitem', 'source=' || n || ' target=' || n from n
union all select 'checksum', 'PASS', 'lineitem', 'source=' || d || ' target=' || d
from (select {_digest_text("broken_lines", _LINE_KEY_COLUMNS)} as d)
union all select 'sample-row', 'PASS', 'lineitem',
       'Compared up to 100 rows. sourceRows=' || least(100, n) || ' targetRows=' || least(100, n) from n
union all select 'target-foreign-key-orphans', case when count(*) = 0 then 'PASS' else 'FAIL' end, 'lineitem.fk_line',
       'orphans=' || count(*) from marked where bad""",
        "report_files": f"""
with {_ORDER_SAMPLES}, {_BROKEN_ORDERS},
suite as ({_validation_suite()}),
findings as ({_required_nulls()}),
decisions as ({_EXCLUDED_DEPENDENTS}),
records as (
  select 'VALIDATION' as record_type, name, status, object_name as object, message from suite
  union all select 'READINESS', code, severity, object_name,
         description || ' | Column: ' || column_name || ' | Rows: ' || cast(bad_rows as varchar) from findings
  union all select 'EXCLUSION', item, status, 'ROW', reason from decisions)
select file, records.* from records, (values ('json'), ('csv')) as f(file)
union all select 'exclusions', '', item, status, 'ROW', reason from decisions""",
        "canonical_text": f"select event_id, {_row_text(_EVENT_COLUMNS)} as row_text from events",
        "text_digests": "select doc_id, md5(text) as md5_hex, sha256(text) as sha256_hex from documents",
        "bytes_text": """
select doc_id, text as shown, 'FF' || upper(to_hex(encode(source))) as shown_hex from documents""",
        "collapsed_text": r"""
select conv_id, turn, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) as plain,
       upper(role) as role_upper
from conversations""",
        "exact_integers": """
select o_orderkey, case when o_orderkey % 4 = 0 then o_custkey end as whole,
       case when o_orderkey * 10 between -32768 and 32767 then o_orderkey * 10 end as narrow
from orders""",
    }
    sql["row_diff_drill_down"] = sql["row_diff_keyed"]
    sql["row_diff_scaled"] = sql["row_diff_keyed"]
    sql["checksum_other_types"] = """
select 'checksum' as name, 'PASS' as status, 'orders_wide' as object_name
union all
select 'checksum', case when count(*) filter (o_orderkey % 97 = 1) = 0 then 'PASS' else 'FAIL' end, 'orders_text'
from orders"""
    sql["chunk_plan_wide"] = """
with k as (select cast(cast(o_orderkey % 18000 as hugeint) * 1000000000000000 - 9000000000000000000 as hugeint) as k
           from orders),
b as (select min(k) as low, max(k) as high from k),
c as (select (k - low) // 100000000000000000 + 1 as n, count(*) as row_count from k, b group by 1),
r as (select n, row_count, low + (n - 1) * 100000000000000000 as first_key,
             least(low + n * 100000000000000000 - 1, high) as last_key from c, b)
select 'orders' as table_name, cast(n as bigint) as chunk_no, printf('%s-%06d', 'orders', cast(n as bigint)) as chunk_id,
       'wide_key' as column_name, cast(first_key as bigint) as low_key, cast(last_key as bigint) as high_key,
       'wide_key >= ' || cast(first_key as varchar) || ' and wide_key <= ' || cast(last_key as varchar) as where_clause,
       'NUMERIC_PRIMARY_KEY' as strategy, row_count
from r"""
    sql["fk_closed_self"] = """
with recursive t as (
  select c_custkey, case when c_custkey % 10 = 0 then null when c_nationkey = 3 then c_custkey + 1000000000
                         else c_custkey // 10 end as parent
  from customer),
kept as (
  select c_custkey, parent from t where parent is null
  union
  select t.c_custkey, t.parent from t join kept on t.parent = kept.c_custkey)
select c_custkey, parent from kept"""
    return sql
