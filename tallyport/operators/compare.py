"""Comparing a source table with its target.

Comparisons that need every row are written as one aggregation over the union of both
sides.  Rows that agree cancel where they meet, equal rows are combined before the
shuffle, and no join has to bring a frequent key into one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyport.functions.canon import (
    NATIVE,
    PORTABLE,
    canonical_number,
    digest_aggregates,
    row_fingerprint,
    split_columns,
)
from tallyport.operators.chunks import BROADCAST_CHUNKS, chunk_id, is_whole_number, range_number
from tallyport.runtime import settle

# States, names and message texts of check results.
PASS, WARNING, FAIL = "PASS", "WARNING", "FAIL"
ROW_COUNT = "row-count"
CHECKSUM = "checksum"
SAMPLE_ROW = "sample-row"
DUPLICATE_KEY = "duplicate-key"
ORPHANS = "foreign-key-orphans"
TARGET_ORPHANS = "target-foreign-key-orphans"
SIDES_TEXT = "source=%s target=%s"
SAMPLE_TEXT = "Compared up to %s rows. sourceRows=%s targetRows=%s"
SAMPLE_DIFFERS_TEXT = " - mismatch found!"
SKIPPED_TEXT = " (Skipped LOB columns: [%s])"
DUPLICATE_TEXT = "duplicateGroups=%s"
ORPHAN_TEXT = "orphans=%s"

# Version of the fingerprint definition; stored baselines of another version are refused.
FINGERPRINT_VERSION = "1"

_WEIGHT = "_weight"
_PART = "_part"
_MISFIT = "_misfit"


def verdict(good: Column) -> Column:
    return F.when(good, F.lit(PASS)).otherwise(F.lit(FAIL))


def result_row(name: str, status: Column, object_name: str, message: Column) -> list[Column]:
    """The columns of one check result."""
    return [
        F.lit(name).alias("name"),
        status.alias("status"),
        F.lit(object_name).alias("object_name"),
        message.alias("message"),
    ]


# --- one schema --------------------------------------------------------------------


def same_types(
    source: DataFrame, target: DataFrame, columns: Sequence[str]
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with ``columns`` in the types of the source, and the columns to compare.

    Where a type differs, the target's values are cast.  One that cannot be cast, or that the
    cast changes, goes as text into an extra column, which is null in the source, so such a
    row never equals one of the source.
    """
    columns = list(columns)
    other = [c for c in columns if target.schema[c].dataType != source.schema[c].dataType]
    if not other:
        return source.select(*columns), target.select(*columns), columns
    cast, misfits = [], []
    for name in columns:
        wanted, given, value = source.schema[name].dataType, target.schema[name].dataType, F.col(name)
        if name not in other:
            cast.append(value)
            continue
        fitted = value.try_cast(wanted)
        lost = fitted.isNull() | _changed(value, fitted, given, wanted)
        misfits.append(F.when(value.isNotNull() & lost, F.concat(F.lit(f"{name}="), value.cast("string"))))
        cast.append(fitted.alias(name))
    misfit = F.nullif(F.concat_ws(", ", *misfits), F.lit(""))
    return (
        source.select(*columns, F.lit(None).cast("string").alias(_MISFIT)),
        target.select(*cast, misfit.alias(_MISFIT)),
        [*columns, _MISFIT],
    )


def _changed(value: Column, fitted: Column, given: T.DataType, wanted: T.DataType) -> Column:
    """Whether a cast from ``given`` to ``wanted`` that gave a value lost a part of it.

    Texts may write the same value in several ways, so they are compared by what they say; any
    other value is cast back.
    """
    if isinstance(given, T.StringType):
        if isinstance(wanted, T.NumericType):
            return _other_number(value, fitted, wanted)
        if isinstance(wanted, T.DateType):
            return ~value.try_cast("timestamp_ntz").eqNullSafe(fitted.cast("timestamp_ntz"))
        if isinstance(wanted, (T.TimestampType, T.TimestampNTZType)):
            moved = ~value.try_cast("timestamp").eqNullSafe(fitted.cast("timestamp"))
            return moved | value.rlike(_BELOW_MICROS)
        return F.lit(False)
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType, T.NullType)
    if isinstance(given, nested) or isinstance(wanted, nested):
        return F.lit(False)
    return ~fitted.try_cast(given).eqNullSafe(value)


#: A fraction of a second with more digits than a timestamp holds.
_BELOW_MICROS = r"\.[0-9]{6}[0-9]*[1-9]"
_NUMBER = r"^[\x00-\x20]*+([+-]?+)([0-9]*+)\.?+([0-9]*+)(?:[eE]([+-]?[0-9]++))?+[dDfF]?[\x00-\x20]*+$"


def _number_parts(text: Column) -> tuple[Column, Column, Column]:
    """Sign, digits without outer zeros, and the power of ten of the last digit."""
    sign, whole, fraction, power = (F.regexp_extract(text, _NUMBER, i) for i in range(1, 5))
    left = F.ltrim(F.concat(whole, fraction), F.lit("0"))
    digits = F.rtrim(left, F.lit("0"))
    shift = F.length(left) - F.length(digits) - F.length(fraction)
    exponent = F.when(power == "", F.lit(0)).otherwise(power.try_cast("bigint")) + shift
    return F.when(sign == "-", sign).otherwise(F.lit("")), digits, exponent


def _other_number(value: Column, fitted: Column, wanted: T.DataType) -> Column:
    """Whether a text writes another number than ``fitted``, digit by digit.

    A fraction of as many digits as tell all floating-point numbers apart is that number.
    """
    text = fitted.cast("string")
    sign, digits, power = _number_parts(value)
    other_sign, other_digits, other_power = _number_parts(text)
    same = (digits == other_digits) & ((digits == "") | ((sign == other_sign) & power.eqNullSafe(other_power)))
    differs = ~(same & value.rlike(_NUMBER) & text.rlike(_NUMBER))
    if not isinstance(wanted, (T.FloatType, T.DoubleType)):
        return differs
    told = F.lit(9 if isinstance(wanted, T.FloatType) else 17)
    kept = (F.length(digits) <= told) & (power < 0) & text.rlike(_NUMBER) & (fitted != 0)
    return value.rlike(_NUMBER) & differs & ~F.coalesce(kept, F.lit(False))


# --- row counts --------------------------------------------------------------------


def row_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """Rows of both sides in one row."""
    none = F.lit(0).cast("bigint")
    left = source.agg(F.count(F.lit(1)).alias("source_rows")).withColumn("target_rows", none)
    right = target.agg(F.count(F.lit(1)).alias("target_rows")).select(
        none.alias("source_rows"), "target_rows"
    )
    return left.unionByName(right).agg(
        F.sum("source_rows").alias("source_rows"), F.sum("target_rows").alias("target_rows")
    )


def row_count_columns(table: str, source_rows: str, target_rows: str) -> list[Column]:
    message = F.format_string(SIDES_TEXT, source_rows, target_rows)
    return result_row(ROW_COUNT, verdict(F.col(source_rows) == F.col(target_rows)), table, message)


def row_count_check(source: DataFrame, target: DataFrame, table: str) -> DataFrame:
    return row_counts(source, target).select(*row_count_columns(table, "source_rows", "target_rows"))


# --- checksums ---------------------------------------------------------------------


def table_digest(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    scales: Mapping[str, int] | None = None,
    method: str = PORTABLE,
) -> DataFrame:
    """Count, xor and sum of the row fingerprints: one scan, no sort, no row shuffled."""
    return df.select(row_fingerprint(df, columns, scales, method).alias("_hash")).agg(
        *digest_aggregates(F.col("_hash"))
    )


def both_digests(
    source: DataFrame,
    target: DataFrame,
    columns: Sequence[str] | None = None,
    scales: Mapping[str, int] | None = None,
    method: str = PORTABLE,
) -> DataFrame:
    """Digests of both sides in one row, as ``source_*`` and ``target_*``."""
    source, target, columns = same_types(source, target, columns or split_columns(source.schema)[0])
    sides = {"source": source, "target": target}
    united = None
    for side, df in sides.items():
        digest = table_digest(df, columns, scales, method)
        wide = digest.select(
            *[
                (F.col(c) if s == side else F.lit(None).cast(digest.schema[c].dataType)).alias(f"{s}_{c}")
                for s in sides
                for c in digest.columns
            ]
        )
        united = wide if united is None else united.unionByName(wide)
    return united.agg(*[F.max(c).alias(c) for c in united.columns])


def digest_text(side: str) -> Column:
    return F.concat_ws(
        ":",
        F.col(f"{side}_row_count").cast("string"),
        F.lower(F.hex(F.col(f"{side}_hash_xor"))),
        F.col(f"{side}_hash_sum"),
    )


def checksum_columns(table: str, skipped: Sequence[str] = ()) -> list[Column]:
    """PASS, or WARNING where large columns were left out, or FAIL."""
    good = digest_text("source") == digest_text("target")
    message = F.concat(
        F.format_string(SIDES_TEXT, digest_text("source"), digest_text("target")), _skipped_note(skipped)
    )
    status = F.when(good, F.lit(WARNING if skipped else PASS)).otherwise(F.lit(FAIL))
    return result_row(CHECKSUM, status, table, message)


def checksum_check(
    source: DataFrame,
    target: DataFrame,
    table: str,
    scales: Mapping[str, int] | None = None,
    method: str = PORTABLE,
) -> DataFrame:
    scalar, large = split_columns(source.schema)
    if not scalar:
        raise ValueError(f"table {table} has no column to compare; large columns: {large}")
    digests = both_digests(source, target, scalar, scales, method)
    return digests.select(*checksum_columns(table, large))


def _skipped_note(skipped: Sequence[str]) -> Column:
    return F.lit(SKIPPED_TEXT % ", ".join(skipped) if skipped else "")


def chunk_digests(
    df: DataFrame,
    table: str,
    key: str,
    size: int,
    columns: Sequence[str] | None = None,
    scales: Mapping[str, int] | None = None,
    low: Column | None = None,
    method: str = PORTABLE,
) -> DataFrame:
    """Digest per key range.

    For digests that are stored, give the ``low`` of the first run: without it chunk 1 starts at the
    smallest key there is today, and one row less at the start moves every chunk.  Keys
    below ``low`` share chunk 0 with rows without a key.
    """
    number = range_number(df, key, size) if low is None else _side_chunk(df, key, size, low)
    hashed = df.select(
        number.alias("chunk_no"),
        row_fingerprint(df, columns, scales, method).alias("_hash"),
    )
    return (
        hashed.groupBy("chunk_no")
        .agg(*digest_aggregates(F.col("_hash")))
        .select(F.lit(table).alias("table_name"), chunk_id(table, F.col("chunk_no")).alias("chunk_id"), "*")
    )


def checksum_by_chunk(
    source: DataFrame,
    target: DataFrame,
    table: str,
    key: str,
    size: int,
    columns: Sequence[str] | None = None,
    scales: Mapping[str, int] | None = None,
    method: str = PORTABLE,
) -> DataFrame:
    """Row counts and digests of both sides per key range of the source, with a status.

    Target rows below the smallest source key share chunk 0 with rows without a key.
    """
    columns = list(columns or split_columns(source.schema)[0])
    source, target, columns = same_types(source, target, columns if key in columns else [key, *columns])
    low = source.agg(F.min(key)).scalar()
    return _side_digests(source, target, key, size, columns, scales, low, method).select(
        F.lit(table).alias("table_name"),
        chunk_id(table, F.col("chunk_no")).alias("chunk_id"),
        *[f"{side}_{name}" for side in _SIDES for name in _DIGEST],
        verdict(_sides_agree()).alias("status"),
    )


_SIDES = ("source", "target")
_DIGEST = ("rows", "xor", "sum")


def _side_chunk(df: DataFrame, key: str, size: int, low: Column) -> Column:
    number = F.when(F.col(key) < low, F.lit(0)).otherwise(range_number(df, key, size, low))
    return number.cast("bigint")


def _side_digests(source, target, key, size, columns, scales, low, method) -> DataFrame:
    """Digests of both sides per chunk number."""
    sides = [df.withColumn("chunk_no", _side_chunk(df, key, size, low)) for df in (source, target)]
    return _digests_by(sides, "chunk_no", columns, scales, method)


def _digests_by(sides, part, columns, scales, method) -> DataFrame:
    """Digests of both sides per value of ``part``, from one aggregation over both."""
    hashed = [
        df.select(
            part,
            row_fingerprint(df, columns, scales, method).alias("_hash"),
            F.lit(side).alias("_side"),
        )
        for side, df in zip(_SIDES, sides, strict=True)
    ]
    aggregates = [
        aggregate.alias(f"{side}_{name}")
        for side in _SIDES
        for aggregate, name in zip(
            digest_aggregates(F.col("_hash"), F.col("_side") == side), _DIGEST, strict=True
        )
    ]
    return hashed[0].unionByName(hashed[1]).groupBy(part).agg(*aggregates)


def _sides_agree() -> Column:
    return reduce(and_, [F.col(f"source_{name}") == F.col(f"target_{name}") for name in _DIGEST])


# --- stored fingerprints -----------------------------------------------------------


def fingerprint_drift(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """SAME, CHANGED, MISSING or NEW per chunk (one row per chunk on either side)."""
    keys = ["table_name", "chunk_id"]
    digest = ["row_count", "hash_xor", "hash_sum"]
    old = baseline.select(*keys, F.struct(*digest).alias("_old"))
    new = current.select(*keys, F.struct(*digest).alias("_new"))
    status = (
        F.when(F.col("_old").isNull(), "NEW")
        .when(F.col("_new").isNull(), "MISSING")
        .when(F.col("_old") == F.col("_new"), "SAME")
        .otherwise("CHANGED")
    )
    return old.join(new, keys, "full_outer").select(
        *keys,
        F.col("_old.row_count").alias("baseline_rows"),
        F.col("_new.row_count").alias("current_rows"),
        status.alias("drift"),
    )


# --- samples -----------------------------------------------------------------------


def sample_rows(df: DataFrame, keys: Sequence[str] = (), size: int = 100) -> DataFrame:
    """The first ``size`` rows by key, else by all comparable columns.

    Rows equal in the key are ordered by the other columns, so both sides pick alike.
    With a single key the key column is read first, and its ``size``-th value then bounds
    the scan of the whole rows.
    """
    scalar, _ = split_columns(df.schema)
    rows = df.select(*scalar)
    if len(keys) == 1:
        key = F.col(keys[0])
        last = df.select(key.alias("_key")).orderBy(F.col("_key").asc_nulls_first()).limit(size)
        rows = rows.where((key <= last.agg(F.max("_key")).scalar()) | key.isNull())
    order = [*keys, *[c for c in scalar if c not in keys]]
    return rows.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(size)


def sample_result(
    source: DataFrame, target: DataFrame, table: str, keys: Sequence[str] = (), size: int = 100
) -> DataFrame:
    """Whether the first rows of both sides are the same multiset, after casting the
    target to the source's types."""
    scalar, large = split_columns(source.schema)
    if not scalar:
        raise ValueError(f"table {table} has no column to compare; large columns: {large}")
    alike, other, _ = same_types(source, target, scalar)
    left, right = sample_rows(alike, keys, size), sample_rows(other, keys, size)
    differing = net_rows(left, right).agg(
        F.count_if(F.col(_WEIGHT) != 0).alias("differing"),
        F.sum("_source_rows").alias("source_rows"),
        F.sum("_target_rows").alias("target_rows"),
    )
    none = F.lit(0).cast("bigint")
    counts = [F.coalesce(F.col(c), none) for c in ("source_rows", "target_rows")]
    message = F.concat(
        F.format_string(SAMPLE_TEXT, F.lit(size), *counts),
        F.when(F.col("differing") > 0, F.lit(SAMPLE_DIFFERS_TEXT)).otherwise(F.lit("")),
        _skipped_note(large),
    )
    return differing.select(*result_row(SAMPLE_ROW, verdict(F.col("differing") == 0), table, message))


# --- row differences ---------------------------------------------------------------


def rounded(df: DataFrame, columns: Sequence[str], scales: Mapping[str, int] | None) -> DataFrame:
    """Columns with floating-point values rounded to the decimals that count for them, so
    that values equal in a checksum are equal here."""
    scales = scales or {}
    return df.select(*[canonical_number(F.col(c), df.schema[c].dataType, scales.get(c)).alias(c) for c in columns])


def net_rows(source: DataFrame, target: DataFrame) -> DataFrame:
    """Distinct rows of both sides with how often each side has them, and the net count
    (source minus target).  One shuffle; equal rows are combined before it."""
    columns = source.columns
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    united = source.select("*", one.alias("_s"), none.alias("_t")).unionByName(
        target.select(*columns, none.alias("_s"), one.alias("_t"))
    )
    return (
        united.groupBy(*columns)
        .agg(F.sum("_s").alias("_source_rows"), F.sum("_t").alias("_target_rows"))
        .withColumn(_WEIGHT, F.col("_source_rows") - F.col("_target_rows"))
    )


def row_diff_multiset(
    source: DataFrame,
    target: DataFrame,
    columns: Sequence[str] | None = None,
    scales: Mapping[str, int] | None = None,
) -> DataFrame:
    """Rows that one side has more often than the other, with the number of surplus
    copies: ``source except all target`` and the reverse, in one pass.

    The copies are counted rather than repeated, so a row that occurs a billion times
    stays one row.  Columns count, and are shown, as far as their ``scales`` go.  A target
    value that the source's type cannot hold is part of ``_misfit`` (only there if types differ).
    """
    columns = list(columns or split_columns(source.schema)[0])
    source, target, columns = same_types(source, target, columns)
    net = net_rows(rounded(source, columns, scales), rounded(target, columns, scales)).where(F.col(_WEIGHT) != 0)
    return net.select(
        *columns,
        F.when(F.col(_WEIGHT) > 0, "source").otherwise("target").alias("side"),
        F.abs(_WEIGHT).alias("copies"),
    )


def row_diff_keyed(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    scales: Mapping[str, int] | None = None,
) -> DataFrame:
    """Keys whose rows differ: rows only in the source, only in the target, and changed.

    Equal rows cancel first.  Of what is left of a key, source and target rows pair one
    to one as changed rows, and the surplus of either side counts as only there.  Where
    one version of a row stands against one other, ``changed_columns`` names the columns
    that differ; keys with several versions leave it null, and
    :func:`row_diff_multiset` has their rows.  Columns count as far as their ``scales`` go.
    """
    keys = list(keys)
    columns = list(columns or split_columns(source.schema)[0])
    columns = [*keys, *[c for c in columns if c not in keys]]
    source, target, columns = same_types(source, target, columns)
    values = columns[len(keys) :]
    net = net_rows(rounded(source, columns, scales), rounded(target, columns, scales))
    left, right = F.col(_WEIGHT) > 0, F.col(_WEIGHT) < 0
    row = F.struct(*values) if values else F.struct(F.lit(1).alias("_none"))
    per_key = (
        net.where(F.col(_WEIGHT) != 0)
        .groupBy(*keys)
        .agg(
            F.sum(F.when(left, F.col(_WEIGHT)).otherwise(0)).alias("_left"),
            F.sum(F.when(right, -F.col(_WEIGHT)).otherwise(0)).alias("_right"),
            F.count_if(left).alias("_left_versions"),
            F.count_if(right).alias("_right_versions"),
            F.max(F.when(left, row)).alias("_old"),
            F.max(F.when(right, row)).alias("_new"),
        )
    )
    changed = F.least("_left", "_right")
    differing = F.array_compact(
        F.array(*[F.when(~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")), F.lit(c)) for c in values])
        if values
        else F.array(F.lit(None).cast("string"))
    )
    single = (F.col("_left_versions") == 1) & (F.col("_right_versions") == 1)
    return per_key.select(
        *keys,
        F.when(F.col("_right") == 0, "ONLY_SOURCE")
        .when(F.col("_left") == 0, "ONLY_TARGET")
        .otherwise("CHANGED")
        .alias("difference"),
        (F.col("_left") - changed).alias("only_source_rows"),
        (F.col("_right") - changed).alias("only_target_rows"),
        changed.alias("changed_rows"),
        F.when(single, F.array_join(differing, ", ")).alias("changed_columns"),
    )


def row_diff_drill_down(
    source: DataFrame,
    target: DataFrame,
    key: str | Sequence[str],
    size: int,
    columns: Sequence[str] | None = None,
    scales: Mapping[str, int] | None = None,
    most_sent: int = BROADCAST_CHUNKS,
) -> DataFrame:
    """:func:`row_diff_keyed`, looking only into parts whose checksums differ.

    A part is a range of a single whole-number key, or a bucket of the hash of any other
    key, of about ``size`` rows.  The checksums need no row to be shuffled; of the
    parts that differ the rows are compared as in the full form, with the same result.
    The list of parts is sent to all tasks up to ``most_sent``, and joined beyond it.
    """
    keys = [key] if isinstance(key, str) else list(key)
    columns = list(columns or split_columns(source.schema)[0])
    columns = [*keys, *[c for c in columns if c not in keys]]
    alike, other, wider = same_types(source, target, columns)
    if len(keys) == 1 and is_whole_number(alike.schema[keys[0]].dataType):
        low = alike.agg(F.min(keys[0])).scalar()
        parts = [_side_chunk(df, keys[0], size, low) for df in (alike, other)]
    else:
        buckets = max(1, -(-alike.count() // size))
        hashed = F.xxhash64(*[F.col(c) for c in keys])
        parts = [F.pmod(hashed, F.lit(buckets))] * 2
    sides = [df.withColumn(_PART, part) for df, part in zip((alike, other), parts, strict=True)]
    digests = _digests_by(sides, _PART, wider, scales, NATIVE)
    # Written first: how many there are decides how they are joined.
    differing = settle(digests.where(~_sides_agree()).select(_PART))
    if differing.count() <= most_sent:
        differing = F.broadcast(differing)
    found = [df.join(differing, _PART, "left_semi").drop(_PART) for df in sides]
    return row_diff_keyed(*found, keys, wider, scales)
