"""One text form per value, and fingerprints built on it.

The form does not depend on partitioning, row order, session time zone or the
class a driver returns.  A field carries its length, so a null, the word NULL and
text that holds a delimiter all stay apart.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source type names whose columns are left out of comparisons.
LARGE_OBJECT_TYPES = ("RAW", "LONG", "BFILE")
LARGE_OBJECT_MARK = "LOB"

# Metadata entry of a StructField that keeps the type name of the source column.
SOURCE_TYPE = "source_type"

# Fingerprint methods.
PORTABLE, NATIVE = "md5", "xxhash64"

_UTC_NAMES = ("UTC", "Etc/UTC", "Z", "+00:00")
_MICROS_PER_SECOND = 1_000_000
_MICROS_PER_DAY = 86_400 * _MICROS_PER_SECOND
_LONG_LIMIT = 9.0e18
_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def is_large_object(field: T.StructField) -> bool:
    """True for binary and nested columns and for columns marked with a large-object type."""
    if isinstance(field.dataType, (T.BinaryType, *_NESTED)):
        return True
    source_type = str((field.metadata or {}).get(SOURCE_TYPE, "")).upper()
    return LARGE_OBJECT_MARK in source_type or source_type in LARGE_OBJECT_TYPES


def split_columns(schema: T.StructType) -> tuple[list[str], list[str]]:
    """Names of the comparable columns and of the large ones, in schema order."""
    scalar = [f.name for f in schema if not is_large_object(f)]
    large = [f.name for f in schema if is_large_object(f)]
    return scalar, large


def epoch_micros(value: Column, data_type: T.DataType) -> Column:
    """Microseconds since 1970-01-01; a zone-less timestamp is read as it stands,
    whatever the session time zone."""
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(value)
    session = SparkSession.getActiveSession()
    if session is not None and session.conf.get("spark.sql.session.timeZone") in _UTC_NAMES:
        return F.unix_micros(value.cast("timestamp"))  # the same, and cheaper
    days = F.unix_date(value.cast("date")).cast("bigint")
    seconds = F.hour(value) * 3600 + F.minute(value) * 60
    micros = (F.extract(F.lit("SECOND"), value) * _MICROS_PER_SECOND).cast("bigint")
    return days * F.lit(_MICROS_PER_DAY) + seconds.cast("bigint") * _MICROS_PER_SECOND + micros


def _shifted(number: Column, scale: int) -> tuple[Column, Column]:
    """A double times ``10**scale`` as a bigint, rounded half away from zero, and whether
    that fits.  Built from floor, since ``round`` goes over decimals for every row."""
    shifted = number * F.lit(float(10**scale))
    size = F.abs(shifted)
    whole = F.floor(size)
    rounded = whole + F.when(size - whole >= 0.5, 1).otherwise(0)
    return F.when(shifted < 0, -rounded).otherwise(rounded), size < F.lit(_LONG_LIMIT)


def canonical_number(value: Column, data_type: T.DataType, scale: int | None) -> Column:
    """A floating-point value rounded to ``scale`` decimals, any other as it is; two values
    have the same canonical text exactly if they are equal here."""
    if scale is None or not isinstance(data_type, (T.FloatType, T.DoubleType)):
        return value
    number = value.cast("double")
    shifted, fits = _shifted(number, scale)
    return F.when(fits, shifted / F.lit(float(10**scale))).otherwise(number + F.lit(0.0))


def canonical_text(value: Column, data_type: T.DataType, scale: int | None = None) -> Column:
    """The canonical text of a value; null stays null.

    ``scale`` is the number of decimals that count for a floating-point column.
    """
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return epoch_micros(value, data_type).cast("string")
    if isinstance(data_type, T.DateType):
        return F.unix_date(value).cast("string")
    if isinstance(data_type, T.BinaryType):
        return F.hex(value)
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        number = value.cast("double")
        plain = (number + F.lit(0.0)).cast("string")  # -0.0 reads as 0.0
        if scale is None:
            return plain
        shifted, fits = _shifted(number, scale)
        return F.when(fits, shifted.cast("string")).otherwise(plain)
    if isinstance(data_type, _NESTED):
        raise TypeError(f"no canonical text for {data_type.simpleString()}")
    return value.cast("string")


def _field_parts(text: Column) -> list[Column]:
    """The parts of a field: length, colon and text, or ``N`` for null."""
    return [
        F.coalesce(F.length(text).cast("string"), F.lit("N")),
        F.when(text.isNull(), F.lit("")).otherwise(F.lit(":")),
        F.coalesce(text, F.lit("")),
    ]


def _chosen(df: DataFrame, columns: Iterable[str] | None) -> list[str]:
    return list(columns) if columns is not None else split_columns(df.schema)[0]


def row_text(
    df: DataFrame, columns: Iterable[str] | None = None, scales: Mapping[str, int] | None = None
) -> Column:
    """All fields of a row in one text, each with its length before it."""
    scales = scales or {}
    parts = []
    for name in _chosen(df, columns):
        parts += _field_parts(canonical_text(F.col(name), df.schema[name].dataType, scales.get(name)))
    return F.concat(*parts)


def text_fingerprint(text: Column) -> Column:
    """The first 60 bits of the MD5 of a text, as a bigint."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def row_fingerprint(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    scales: Mapping[str, int] | None = None,
    method: str = PORTABLE,
) -> Column:
    """A 60-bit fingerprint of a row.

    The portable method hashes the row's canonical text by MD5, which any other engine
    can repeat.  The native one hashes the same canonical values by Spark's own 64-bit
    hash, at a fraction of the cost, and serves where Spark reads both sides.
    """
    if method == PORTABLE:
        return text_fingerprint(row_text(df, columns, scales))
    if method != NATIVE:
        raise ValueError(f"unknown fingerprint method {method}")
    scales = scales or {}
    values, nulls = [], []
    for place, name in enumerate(_chosen(df, columns)):
        values.append(_canonical_value(F.col(name), df.schema[name].dataType, scales.get(name)))
        # the hash passes over nulls, so their places are hashed as well
        nulls.append(F.when(F.col(name).isNull(), F.lit(1 << place % 62).cast("bigint")).otherwise(F.lit(0)))
    masks = [reduce(add, nulls[i : i + 62]) for i in range(0, len(nulls), 62)]
    return F.shiftrightunsigned(F.xxhash64(*values, *masks), 4)


def _canonical_value(value: Column, data_type: T.DataType, scale: int | None) -> Column:
    """As :func:`canonical_text`, but in a type that is cheap to hash."""
    if isinstance(data_type, (T.StringType, T.BooleanType)):
        return value
    if isinstance(data_type, T.IntegralType):
        return value.cast("bigint")
    if isinstance(data_type, T.DecimalType) and data_type.scale == 0 and data_type.precision <= 18:
        return value.cast("bigint")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return epoch_micros(value, data_type)
    if isinstance(data_type, T.DateType):
        return F.unix_date(value).cast("bigint")
    if isinstance(data_type, (T.FloatType, T.DoubleType)) and scale is not None:
        # numbers that do not fit stay apart by their own value
        shifted, fits = _shifted(value.cast("double"), scale)
        return F.when(fits, shifted).otherwise(F.xxhash64(value.cast("double") + F.lit(0.0)))
    return canonical_text(value, data_type, scale)


def digest_aggregates(fingerprint: Column, when: Column | None = None) -> list[Column]:
    """Aggregates that identify a multiset of rows in any order: count, xor and sum.

    The sum catches pairs of equal rows, which cancel in the xor.  ``when`` limits them
    to some rows.
    """
    counted = F.lit(1) if when is None else F.when(when, 1)
    kept = fingerprint if when is None else F.when(when, fingerprint)
    return [
        F.count(counted).alias("row_count"),
        F.coalesce(F.bit_xor(kept), F.lit(0).cast("bigint")).alias("hash_xor"),
        _exact_sum(kept).cast("string").alias("hash_sum"),
    ]


def _exact_sum(fingerprint: Column) -> Column:
    """The sum as decimal(38,0), from three bigint sums of 20 bits each: a decimal sum per
    row costs far more, and a sum of 20-bit parts holds for 2**43 rows."""
    total = F.lit(0).cast("decimal(38,0)")
    for part in range(3):
        bits = F.shiftright(fingerprint, 20 * part).bitwiseAND(F.lit((1 << 20) - 1))
        place = F.lit(str(1 << (20 * part))).cast("decimal(14,0)")
        total = total + F.coalesce(F.sum(bits), F.lit(0)).cast("decimal(20,0)") * place
    return total.cast("decimal(38,0)")


def bytes_as_text(value: Column) -> Column:
    """Bytes read as UTF-8; bytes that are not UTF-8 are given in hex instead."""
    return F.when(F.is_valid_utf8(value), F.decode(value, "UTF-8")).otherwise(F.hex(value))
