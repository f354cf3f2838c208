"""Splitting a table into bounded, restartable pieces.

Value ranges of a single key, of equal width or of equal depth; row numbers in key order;
and physical row positions for tables without a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException
from pyspark.sql.window import Window

from tallyport.functions.canon import split_columns
from tallyport.runtime import default_partitions, settle_table, work_path
from tallyport.sources.tables import remove_rows

# Strategy names as they appear in chunk reports.
KEY_RANGE = "NUMERIC_PRIMARY_KEY"
ROW_NUMBER = "ROW_NUMBER"
ROW_POSITION = "ROWID"
QUANTILE = "QUANTILE"

# Cuts of a plan of equal depth that one pass with a summary looks for, and the entries that such
# a summary may hold in one task.  Plans that need more count every key instead.
MOST_CUTS = 10_000
MOST_ENTRIES = 20 * MOST_CUTS

# Rows (or chunks) that one task handles at a time where a sequence is split into blocks.
BLOCK = 10_000

# Tables of at most this many files get their per-file offsets by broadcast (one short row
# per file, some 20 MB at the limit); beyond it the offsets are joined.
BROADCAST_FILES = 100_000

# Lists of at most this many chunk numbers (8 bytes each) are broadcast.
BROADCAST_CHUNKS = 100_000

_POSITION_BITS = 33  # monotonically_increasing_id keeps the position in its low bits


def check_size(size: int) -> None:
    if size <= 0:
        raise ValueError("chunk size must be greater than zero")


def whole_div(left: Column, right: Column | int) -> Column:
    """Integer division without a detour over doubles."""
    return F.call_function("div", left, right if isinstance(right, Column) else F.lit(right))


def chunk_id(table: str | Column, number: Column) -> Column:
    """``TABLE-000001``; numbers above six digits keep all their digits."""
    name = F.lit(table) if isinstance(table, str) else table
    return F.format_string("%s-%06d", name, number)


def is_whole_number(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.DecimalType):
        return data_type.scale == 0
    return isinstance(data_type, T.IntegralType)


def choose_strategy(schema: T.StructType, keys: Sequence[str]) -> str:
    if not keys:
        return ROW_POSITION
    if len(keys) == 1 and is_whole_number(schema[keys[0]].dataType):
        return KEY_RANGE
    return ROW_NUMBER


def key_bounds(df: DataFrame, key: str) -> DataFrame:
    """Smallest and largest key; an empty table gives (1, 0), which plans no chunk."""
    return df.agg(
        F.coalesce(F.min(key), F.lit(1)).alias("min_key"),
        F.coalesce(F.max(key), F.lit(0)).alias("max_key"),
    )


def row_bounds(df: DataFrame) -> DataFrame:
    """Bounds (1, number of rows) of a table that is chunked by row."""
    return df.agg(F.lit(1).cast("bigint").alias("min_key"), F.count(F.lit(1)).alias("max_key"))


# --- value ranges ------------------------------------------------------------------


def _quotient(value: Column, size: int) -> tuple[Column, Column]:
    """Quotient rounded down and remainder from 0; neither leaves the type of ``value``."""
    rest = value % F.lit(size)
    below = F.when(rest < 0, 1).otherwise(0)
    return whole_div(value, size) - below, rest + below * size


def ranges_between(low: Column, key: Column, size: int, key_type: T.DataType) -> Column:
    """How many whole ranges of ``size`` lie between two keys.

    Whole keys are divided before they are subtracted, since the difference of two keys can
    be too large for their type.
    """
    if not is_whole_number(key_type):
        return F.floor((key - low) / F.lit(size)).cast("bigint")
    if not isinstance(key_type, T.DecimalType):
        low, key = low.cast("bigint"), key.cast("bigint")
    (low_part, low_rest), (key_part, key_rest) = _quotient(low, size), _quotient(key, size)
    return (key_part - low_part - F.when(key_rest < low_rest, 1).otherwise(0)).cast("bigint")


def range_number(df: DataFrame, key: str, size: int, low: Column | None = None) -> Column:
    """Chunk number of a row by the range its key lies in; 0 for a null key.

    ``low`` is the key at which chunk 1 starts, by default the smallest key of ``df``
    (a scalar subquery, so no join).
    """
    check_size(size)
    low = df.agg(F.min(key)).scalar() if low is None else low
    number = ranges_between(low, F.col(key), size, df.schema[key].dataType)
    return F.coalesce(number + 1, F.lit(0).cast("bigint"))


def plan_key_ranges(
    df: DataFrame, table: str, key: str, size: int, dense: bool = False, quote: str = ""
) -> DataFrame:
    """Chunks of ``size`` consecutive key values, with the rows in each.

    Only ranges that hold rows are planned, plus chunk 0 where keys are null.  With
    ``dense`` every range between the bounds is planned, empty ones too.  Whole-number
    ranges include both ends; for other keys a range is half open and the last one has
    no upper end, so no key falls between two chunks.  ``quote`` stands around the key's
    name in predicates (doubled inside it); plain names need none.
    """
    check_size(size)
    key_type = df.schema[key].dataType
    name = f"{quote}{key.replace(quote, quote * 2)}{quote}" if quote else key
    low, high = df.agg(F.min(key)).scalar(), df.agg(F.max(key)).scalar()
    counts = (
        df.select(range_number(df, key, size, low).alias("chunk_no"))
        .groupBy("chunk_no")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    if dense:
        counts = _all_ranges(df, key, size).join(counts, "chunk_no", "left").fillna(0, "row_count")
    whole = is_whole_number(key_type)
    if whole:
        # Wide enough for any bound of a range; each end lies within the keys' own type.
        wide = T.DecimalType(38, 0)
        first = low.cast(wide) + (F.col("chunk_no") - 1).cast("decimal(20,0)") * F.lit(size).cast("decimal(18,0)")
        start = first.cast(key_type)
        room = high.cast(wide) - first
        end = F.when(room < size, high).otherwise((first + F.lit(size - 1)).cast(key_type))
        test = F.concat(
            F.lit(f"{name} >= "), start.cast("string"), F.lit(f" and {name} <= "), end.cast("string")
        )
    else:
        start = (low + (F.col("chunk_no") - 1) * size).cast(key_type)
        end = (start + size).cast(key_type)
        last = end > high
        test = F.concat(
            F.lit(f"{name} >= "),
            start.cast("string"),
            F.when(last, F.lit("")).otherwise(F.concat(F.lit(f" and {name} < "), end.cast("string"))),
        )
    has_key = F.col("chunk_no") > 0
    return counts.select(
        F.lit(table).alias("table_name"),
        "chunk_no",
        chunk_id(table, F.col("chunk_no")).alias("chunk_id"),
        F.lit(key).alias("column_name"),
        F.when(has_key, start).alias("low_key"),
        F.when(has_key, end).alias("high_key"),
        F.when(has_key, test).otherwise(F.lit(f"{name} is null")).alias("where_clause"),
        F.lit(KEY_RANGE).alias("strategy"),
        "row_count",
    )


def _all_ranges(df: DataFrame, key: str, size: int) -> DataFrame:
    """Numbers of all ranges between the bounds (one small row reaches the driver)."""
    top = df.agg(F.max(range_number(df, key, size)).alias("top")).first()["top"] or 0
    ranges = df.sparkSession.range(1, top + 1).withColumnRenamed("id", "chunk_no")
    nulls = df.where(F.col(key).isNull()).limit(1).select(F.lit(0).cast("bigint").alias("chunk_no"))
    return ranges.union(nulls)


# --- ranges of equal depth ---------------------------------------------------------


def quantile_cuts(df: DataFrame, key: str, size: int, accuracy: int | None = None) -> list[tuple[str, bool]]:
    """Where ranges of about ``size`` rows end in key order: ``(key as text, whether the key
    itself belongs to the range)``.

    Keys at the ranks ``size``, ``2 * size`` and so on come from one pass with Spark's mergeable
    quantile summary.  A rank is wrong by rows / ``accuracy`` at most, by default a
    twentieth of ``size``; a table of fewer rows than ``accuracy`` is cut exactly.  A key
    that reaches over two cuts has a range of its own.  The driver receives the cuts, at
    most ``MOST_CUTS``.
    """
    check_size(size)
    rows = df.agg(F.count(key)).first()[0]
    cuts = -(-rows // size) - 1
    if cuts > MOST_CUTS:
        raise ValueError(f"{rows} rows in chunks of {size} are too many chunks; choose {suggest_size(rows)} or more")
    if cuts < 1:
        return []
    # Half a rank below, so that rounding never reaches the next one.
    shares = ", ".join(f"{(i * size - 0.5) / rows!r}D" for i in range(1, cuts + 1))
    name = "`" + key.replace("`", "``") + "`"
    found = F.expr(f"percentile_approx({name}, array({shares}), {accuracy or max(10_000, 20 * cuts)})")
    keys = df.agg(F.transform(found, lambda k: k.cast("string"))).first()[0]
    ends = []
    for i, k in enumerate(keys):
        if i and keys[i - 1] == k:
            continue
        if i + 1 < cuts and keys[i + 1] == k:
            ends.append((k, False))
        ends.append((k, True))
    return ends


def quantile_number(df: DataFrame, key: str, cuts: Sequence[tuple[str, bool]]) -> Column:
    """Chunk number of a row by the cuts before its key; 0 for a null key.

    A binary search over a constant array, some ten steps a row, without a join.
    """
    kind = df.schema[key].dataType.simpleString()
    # One text each, which Spark folds to an array once.
    ends = F.split(F.lit(",".join(k for k, _ in cuts)), ",").cast(f"array<{kind}>")
    whole = F.split(F.lit(",".join(str(int(w)) for _, w in cuts)), ",").cast("array<int>")
    value = F.col(key)

    def step(at: Column, width: Column) -> Column:
        spot = at + width
        end = F.get(ends, spot - 1)
        behind = (value > end) | ((value == end) & (F.get(whole, spot - 1) == 0))
        return F.when((spot <= len(cuts)) & behind, spot).otherwise(at)

    widths = [1 << i for i in reversed(range(len(cuts).bit_length()))]
    passed = F.aggregate(F.array(*map(F.lit, widths)), F.lit(0), step) if cuts else F.lit(0)
    return F.when(value.isNull(), F.lit(0)).otherwise(passed + 1).cast("bigint")


def plan_quantiles(
    df: DataFrame, table: str, key: str, size: int, accuracy: int | None = None, quote: str = ""
) -> DataFrame:
    """Chunks of about ``size`` rows each, as ranges of a key of any spread.

    The key is a number, a date or a timestamp.  Bounds are the smallest and largest key that
    a range holds, so a chunk is read again by its predicate.  Chunk 0 holds null keys.

    Up to ``MOST_CUTS`` cuts and an ``accuracy`` of ``MOST_ENTRIES``, the cuts are those of
    :func:`quantile_cuts`.  Beyond, keys are counted and cut at their exact ranks, by as many
    tasks as there are; the driver receives two counts.
    """
    check_size(size)
    rows, known = df.agg(F.count(F.lit(1)), F.count(key)).first()
    if -(-known // size) - 1 > MOST_CUTS or (accuracy or 0) > MOST_ENTRIES:
        counts = _exact_ranges(df, key, size, known, rows - known)
    else:
        number = quantile_number(df, key, quantile_cuts(df, key, size, accuracy))
        counts = df.groupBy(number.alias("chunk_no")).agg(
            F.min(key).alias("low_key"), F.max(key).alias("high_key"), F.count(F.lit(1)).alias("row_count")
        )
    name = f"{quote}{key.replace(quote, quote * 2)}{quote}" if quote else key
    mark = {"date": "date", "timestamp": "timestamp", "timestamp_ntz": "timestamp"}.get(df.schema[key].dataType.simpleString())

    def said(value: str) -> Column:
        text = F.col(value).cast("string")
        return F.concat(F.lit(f"{mark} '"), text, F.lit("'")) if mark else text

    test = F.concat(F.lit(f"{name} >= "), said("low_key"), F.lit(f" and {name} <= "), said("high_key"))
    return counts.select(
        F.lit(table).alias("table_name"),
        "chunk_no",
        chunk_id(table, F.col("chunk_no")).alias("chunk_id"),
        F.lit(key).alias("column_name"),
        "low_key",
        "high_key",
        F.when(F.col("chunk_no") > 0, test).otherwise(F.lit(f"{name} is null")).alias("where_clause"),
        F.lit(QUANTILE).alias("strategy"),
        "row_count",
    )


def _exact_ranges(df: DataFrame, key: str, size: int, known: int, nulls: int) -> DataFrame:
    """``chunk_no, low_key, high_key, row_count`` of ranges cut at the exact ranks.

    Rows are counted by key, the counts are range partitioned and written in order once, and a
    running total over blocks of them gives each key the rows before it.  The cuts before a key
    follow from that; a key that holds several is a range of its own, behind the keys since the
    cut before.  The ranges are numbered by a running total of the cuts they end at, so a range
    without keys keeps its number.
    """
    spark, value = df.sparkSession, F.col("`" + key.replace("`", "``") + "`")
    counts = df.where(value.isNotNull()).groupBy(value.alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    ordered = counts.repartitionByRange(default_partitions(spark), "_key").sortWithinPartitions("_key")
    stored = settle_table(ordered.withColumn("_spot", F.monotonically_increasing_id()), "keys")
    placed = running_total(stored, "_rows", "_spot", [], "_ahead")
    passed = whole_div(F.col("_ahead"), size)
    # The last row ends the table, not a range before another.
    cuts = whole_div(F.least(F.col("_ahead") + F.col("_rows"), F.lit(known - 1)), size) - passed
    marked = placed.select("_key", "_rows", cuts.alias("_cuts"), (passed * 2 + (cuts > 1).cast("int")).alias("_range"))
    ranges = marked.groupBy("_range").agg(
        F.min("_key").alias("low_key"),
        F.max("_key").alias("high_key"),
        F.sum("_rows").alias("row_count"),
        F.sum(F.least("_cuts", F.lit(2))).alias("_ends"),
    )
    numbered = running_total(settle_table(ranges, "ranges"), "_ends", "_range", [], "_passed")
    found = numbered.select(
        (F.col("_passed") + F.col("_range") % 2 + 1).alias("chunk_no"), "low_key", "high_key", "row_count"
    )
    if not nulls:
        return found
    none = F.lit(None).cast(df.schema[key].dataType)
    zero = spark.range(1).select(
        F.col("id").alias("chunk_no"), none.alias("low_key"), none.alias("high_key"), F.lit(nulls).cast("bigint").alias("row_count")
    )
    return found.unionByName(zero)


def plan_balance(plan: DataFrame) -> DataFrame:
    """Per table of a plan: its chunks and rows, the largest chunk, the largest of more than one
    key, and the largest in percent of the mean."""
    several = F.when(~F.col("low_key").eqNullSafe(F.col("high_key")), F.col("row_count")).otherwise(0)
    found = plan.where("chunk_no > 0").groupBy("table_name", "column_name").agg(
        F.count(F.lit(1)).alias("chunks"),
        F.sum("row_count").alias("row_count"),
        F.max("row_count").alias("largest_chunk"),
        F.max(several).cast("bigint").alias("largest_of_several_keys"),
    )
    skew = whole_div(F.col("largest_chunk") * 100 * F.col("chunks"), F.col("row_count"))
    return found.withColumn("skew_percent", skew)


# --- row numbers -------------------------------------------------------------------


def number_rows(
    df: DataFrame, order_by: Sequence[str], partitions: int | None = None, stable_input: bool | None = None
) -> DataFrame:
    """Add ``row_no``: the global row number in the given order, nulls first.

    A window over the whole table would sort it in one task.  Here the rows are range
    partitioned and sorted, written once, and each row's number is its position in its
    partition plus the rows of the partitions before it.  The scan position closes the
    order, so rows that agree in all ``order_by`` columns, however many, still spread
    over several partitions.

    ``stable_input`` says that recomputing ``df`` gives the same rows in the same order,
    as a file scan with filters and projections does; other inputs are written first.  If not
    given, it is taken from whether ``df`` is such a scan.
    """
    return Numbering(df, order_by, partitions, stable_input).rows().drop("_total")


class Numbering:
    """A table in order, written once to the shared folder, with a number for each row.

    Parts of the order are folders, and a small table holds the rows before each part.
    Plans, copies and restarts of one run read the same numbering; some rows are read from
    the parts that hold them.  :meth:`delete` removes it when nothing needs it any more.
    """

    def __init__(
        self,
        df: DataFrame,
        order_by: Sequence[str],
        partitions: int | None = None,
        stable_input: bool | None = None,
    ):
        self.spark = df.sparkSession
        self.folder = work_path(self.spark, "numbered")
        stable_input = is_file_scan(df) if stable_input is None else stable_input
        source = df
        if not stable_input:
            df.write.parquet(f"{self.folder}/input")
            source = self.spark.read.schema(df.schema).parquet(f"{self.folder}/input")
        partitions = partitions or default_partitions(self.spark)
        order = [F.col(c).asc_nulls_first() for c in order_by]
        placed = (
            source.withColumn("_spot", F.monotonically_increasing_id())
            .repartitionByRange(partitions, *order, F.col("_spot"))
            .sortWithinPartitions(*order, F.col("_spot"))
            .withColumn("_spot", F.monotonically_increasing_id())
            .withColumn("_part", F.shiftright("_spot", _POSITION_BITS))
        )
        placed.write.partitionBy("_part").parquet(f"{self.folder}/rows")
        if not stable_input:
            remove_rows(self.spark, f"{self.folder}/input")
        self.stored = self.spark.read.schema(placed.schema).parquet(f"{self.folder}/rows")
        self.starts = self._starts()

    def _starts(self) -> DataFrame:
        """Rows, and rows before, of each part: at most one row per partition of the order, so one
        task and a broadcast are bounded."""
        before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        counts = self.stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
        return counts.select(
            "_part",
            "_rows",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
            F.sum("_rows").over(Window.partitionBy()).alias("_total"),
        )

    def settle(self) -> Numbering:
        """Write the rows before each part as well, for more than one reader."""
        self.starts.write.parquet(f"{self.folder}/starts")
        self.starts = self.spark.read.schema(self.starts.schema).parquet(f"{self.folder}/starts")
        return self

    def rows(self, first: int | None = None, last: int | None = None) -> DataFrame:
        """Rows with ``row_no`` and the number of all rows, ``_total``; with bounds only those
        between them, from the parts that hold some."""
        held, wanted = self.stored, F.lit(True)
        if first is not None:
            meets = (F.col("_start") < last) & (F.col("_start") + F.col("_rows") >= first)
            parts = [r["_part"] for r in self.starts.where(meets).select("_part").collect()]
            held, wanted = held.where(F.col("_part").isin(parts)), F.col("row_no").between(first, last)
        inside = F.col("_spot").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
        return (
            held.join(F.broadcast(self.starts), "_part")
            .withColumn("row_no", F.col("_start") + inside + 1)
            .drop("_part", "_rows", "_start", "_spot")
            .where(wanted)
        )

    def chunks(self, first: int, last: int, size: int) -> DataFrame:
        """Rows of the chunks ``first`` to ``last`` with their ``chunk_no``."""
        rows = self.rows((first - 1) * size + 1, last * size)
        return rows.withColumn("chunk_no", whole_div(F.col("row_no") - 1, size) + 1).drop("row_no", "_total")

    def delete(self) -> None:
        remove_rows(self.spark, self.folder)


def plan_row_numbers(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    size: int,
    partitions: int | None = None,
    stable_input: bool | None = None,
) -> DataFrame:
    """Chunks of ``size`` rows in key order.

    ``first_key`` and ``last_key`` are structs of the key columns.  For a unique key they
    describe the chunk fully, so it can be read again by :func:`between_keys` without
    numbering the table anew.
    """
    check_size(size)
    return plan_numbering(Numbering(df.select(*keys), keys, partitions, stable_input), table, keys, size)


def plan_numbering(numbering: Numbering, table: str, keys: Sequence[str], size: int) -> DataFrame:
    """The chunks of a numbering that is in the order of ``keys``."""
    row, total = F.col("row_no"), F.col("_total")
    edges = numbering.rows().where(
        (row % size == 1) | (row % size == 0) | (row == total) | F.lit(size == 1)
    )
    key = F.struct(*keys)
    return (
        edges.groupBy((whole_div(row - 1, size) + 1).alias("chunk_no"))
        .agg(
            F.min("row_no").alias("first_row"),
            F.max("row_no").alias("last_row"),
            F.min_by(key, row).alias("first_key"),
            F.max_by(key, row).alias("last_key"),
        )
        .select(
            F.lit(table).alias("table_name"),
            "chunk_no",
            chunk_id(table, F.col("chunk_no")).alias("chunk_id"),
            F.lit(", ".join(keys)).alias("column_name"),
            "first_row",
            "last_row",
            "first_key",
            "last_key",
            F.lit(ROW_NUMBER).alias("strategy"),
            (F.col("last_row") - F.col("first_row") + 1).alias("row_count"),
        )
    )


def between_keys(keys: Sequence[str], first, last) -> Column:
    """Rows from ``first`` to ``last`` in key order (rows of a plan's key structs).

    The plain test on the leading column repeats part of the exact one; it is there
    because it can be pushed down to the files.
    """
    lead = F.col(keys[0]).between(first[0], last[0])
    key = F.struct(*keys)
    low = F.struct(*[F.lit(v).alias(k) for k, v in zip(keys, first, strict=True)])
    high = F.struct(*[F.lit(v).alias(k) for k, v in zip(keys, last, strict=True)])
    return lead & (key >= low) & (key <= high)


# --- row positions -----------------------------------------------------------------


def is_file_scan(df: DataFrame) -> bool:
    """True for a scan of files with nothing but filters and projections on top."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    return plan.nodeName() == "LogicalRelation"


def has_row_positions(df: DataFrame) -> bool:
    """True for a plain scan of files that know each row's place."""
    try:
        df.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return False
    return True


def _file_starts(df: DataFrame) -> DataFrame:
    """Rows per file and the number of rows in all files before it.

    One row per file: the driver lists the files anyway, so this window is bounded.
    """
    path, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    complete = F.when(F.col("_rows") == F.col("_last") + 1, F.col("_rows")).otherwise(
        F.raise_error(F.lit("row positions need a scan of whole files, without filters"))
    )
    return (
        df.select(path.alias("_file"), place.alias("_place"))
        .groupBy("_file")
        .agg(F.count(F.lit(1)).alias("_rows"), F.max("_place").alias("_last"))
        .select("_file", complete.alias("_rows"))
        .select("_file", "_rows", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )


def plan_row_positions(df: DataFrame, table: str, size: int) -> DataFrame:
    """Chunks of ``size`` rows in physical order, from one count per file.

    ``pieces`` lists the file row ranges of a chunk.  No row is shuffled or sorted.
    """
    check_size(size)
    starts = _file_starts(df)
    spans = explode_span(
        starts,
        whole_div(F.col("_start"), size) + 1,
        whole_div(F.col("_start") + F.col("_rows") - 1, size) + 1,
        "chunk_no",
    )
    low = F.greatest((F.col("chunk_no") - 1) * size, F.col("_start")) - F.col("_start")
    high = F.least(F.col("chunk_no") * size, F.col("_start") + F.col("_rows")) - F.col("_start")
    pieces = spans.select("chunk_no", "_file", low.alias("first_index"), (high - 1).alias("last_index"))
    first_row = (F.col("chunk_no") - 1) * size + 1
    return (
        pieces.groupBy("chunk_no")
        .agg(
            F.sum(F.col("last_index") - F.col("first_index") + 1).alias("row_count"),
            # at most one piece per row of the chunk
            F.sort_array(
                F.collect_list(F.struct(F.col("_file").alias("file_path"), "first_index", "last_index"))
            ).alias("pieces"),
        )
        .select(
            F.lit(table).alias("table_name"),
            "chunk_no",
            chunk_id(table, F.col("chunk_no")).alias("chunk_id"),
            F.lit(ROW_POSITION).alias("column_name"),
            first_row.alias("first_row"),
            (first_row + F.col("row_count") - 1).alias("last_row"),
            "pieces",
            F.lit(ROW_POSITION).alias("strategy"),
            "row_count",
        )
    )


def explode_span(df: DataFrame, low: Column, high: Column, name: str, block: int = BLOCK) -> DataFrame:
    """One row per whole number from ``low`` to ``high``.

    A long span is cut into blocks first, which are spread over tasks, so no task builds
    one long array.
    """
    blocks = F.sequence(whole_div(low, block), whole_div(high, block))
    spread = df.select("*", low.alias("_low"), high.alias("_high"), F.explode(blocks).alias("_block"))
    numbers = F.sequence(
        F.greatest(F.col("_low"), F.col("_block") * block),
        F.least(F.col("_high"), F.col("_block") * block + (block - 1)),
    )
    return (
        spread.repartition(default_partitions(df.sparkSession))
        .withColumn(name, F.explode(numbers))
        .drop("_low", "_high", "_block")
    )


# --- any strategy ------------------------------------------------------------------


def assign_chunks(
    df: DataFrame, keys: Sequence[str], size: int, partitions: int | None = None, stable_input: bool | None = None
) -> DataFrame:
    """Add ``chunk_no`` to every row, by the strategy that fits the key."""
    check_size(size)
    strategy = choose_strategy(df.schema, keys)
    if strategy == KEY_RANGE:
        return df.withColumn("chunk_no", range_number(df, keys[0], size))
    if strategy == ROW_POSITION and has_row_positions(df):
        starts = _file_starts(df)
        if len(df.inputFiles()) <= BROADCAST_FILES:
            starts = F.broadcast(starts)
        placed = df.select(
            "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place")
        ).join(starts, "_file")
        row_no = F.col("_start") + F.col("_place")
        return placed.withColumn("chunk_no", whole_div(row_no, size) + 1).drop(
            "_file", "_place", "_rows", "_start"
        )
    numbered = number_rows(df, whole_order(df, keys), partitions, stable_input)
    return numbered.withColumn("chunk_no", whole_div(F.col("row_no") - 1, size) + 1).drop("row_no")


def whole_order(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """Rows that agree in the key are ordered by their other columns, so a later run cuts
    the chunks at the same rows."""
    return [*keys, *[c for c in split_columns(df.schema)[0] if c not in keys]]


def plan_chunks(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    size: int,
    partitions: int | None = None,
    stable_input: bool | None = None,
) -> DataFrame:
    """Chunk plan of a table: number, id, strategy, predicate or row range, and rows."""
    strategy = choose_strategy(df.schema, keys)
    if strategy == KEY_RANGE:
        plan = plan_key_ranges(df, table, keys[0], size)
        where = F.col("where_clause")
    elif strategy == ROW_POSITION and has_row_positions(df):
        plan = plan_row_positions(df, table, size)
        where = _row_range()
    else:
        order = list(keys) or split_columns(df.schema)[0]
        plan = plan_row_numbers(df, table, order, size, partitions, stable_input)
        where = _row_range()
    return _plan_columns(plan, where, strategy)


def plan_numbered_chunks(numbering: Numbering, df: DataFrame, table: str, keys: Sequence[str], size: int) -> DataFrame:
    """As :func:`plan_chunks`, from a numbering of ``df`` in its :func:`whole_order`."""
    order = list(keys) or split_columns(df.schema)[0]
    return _plan_columns(plan_numbering(numbering, table, order, size), _row_range(), choose_strategy(df.schema, keys))


def _plan_columns(plan: DataFrame, where: Column, strategy: str) -> DataFrame:
    return plan.select(
        "table_name",
        "chunk_no",
        "chunk_id",
        "column_name",
        where.alias("where_clause"),
        F.lit(strategy).alias("strategy"),
        "row_count",
    )


def _row_range() -> Column:
    return F.concat(
        F.lit("row_no >= "),
        F.col("first_row").cast("string"),
        F.lit(" and row_no <= "),
        F.col("last_row").cast("string"),
    )


def running_total(
    df: DataFrame, value: str, position: str, partition_by: Sequence[str], name: str, block: int = BLOCK
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all earlier positions of the partition.

    ``position`` is a dense whole number.  Sums are taken per block of positions first,
    so that one table with very many chunks is not one window in one task.
    """
    with_block = df.withColumn("_block", whole_div(F.col(position), block))
    earlier = (Window.unboundedPreceding, -1)
    blocks = (
        with_block.groupBy(*partition_by, "_block")
        .agg(F.sum(value).alias("_sum"))
        .withColumn(
            "_before",
            F.coalesce(
                F.sum("_sum").over(Window.partitionBy(*partition_by).orderBy("_block").rowsBetween(*earlier)),
                F.lit(0),
            ),
        )
        .drop("_sum")
    )
    inside = Window.partitionBy(*partition_by, "_block").orderBy(position).rowsBetween(*earlier)
    return (
        with_block.join(blocks, [*partition_by, "_block"])
        .withColumn(name, F.col("_before") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_block", "_before")
    )


def chunk_balance(
    df: DataFrame, table: str, key: str, size: int, fingerprint: Column | None = None
) -> DataFrame:
    """How evenly rows spread over chunks by key range and by key hash.

    Both splits get the same number of chunks: that of all ranges between the bounds.
    ``skew_percent`` is the largest chunk in percent of the mean one.
    """
    check_size(size)
    low, high = df.agg(F.min(key)).scalar(), df.agg(F.max(key)).scalar()
    key_type = df.schema[key].dataType
    number = ranges_between(low, high, size, key_type) + 1
    hashed = F.xxhash64(key) if fingerprint is None else fingerprint
    splits = {
        "RANGE": ranges_between(low, F.col(key), size, key_type),
        "HASH": F.pmod(hashed, number),
    }
    result = None
    for split, bucket in splits.items():
        one = (
            df.where(F.col(key).isNotNull())
            .groupBy(bucket.alias("_bucket"))
            .agg(F.count(F.lit(1)).alias("_rows"))
            .agg(
                F.count(F.lit(1)).alias("filled_chunks"),
                F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"),
                F.coalesce(F.max("_rows"), F.lit(0)).alias("largest_chunk"),
            )
            .select(
                F.lit(table).alias("table_name"),
                F.lit(key).alias("column_name"),
                F.lit(split).alias("split"),
                F.coalesce(number, F.lit(0)).cast("bigint").alias("chunks"),
                "filled_chunks",
                "row_count",
                "largest_chunk",
                F.coalesce(
                    whole_div(F.col("largest_chunk") * 100 * number, F.nullif("row_count", F.lit(0))), F.lit(0)
                ).alias("skew_percent"),
            )
        )
        result = one if result is None else result.unionByName(one)
    return result


def predicates(plan: DataFrame) -> list[str]:
    """Predicates of a key-range plan in chunk order, for a JDBC read.

    The list is as long as the plan, one entry per read partition, so choose a chunk
    size that suits the number of tasks wanted.
    """
    return [r["where_clause"] for r in plan.orderBy("chunk_no").select("where_clause").toLocalIterator()]


def suggest_size(rows: int, most_chunks: int = 10_000) -> int:
    """A chunk size that keeps the number of chunks, and so of target folders, bounded."""
    return max(1, -(-rows // most_chunks))
