"""Which Spark type holds a source column, and how sure that is."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

READY = "READY"
REVIEW = "REVIEW"
BLOCKED = "BLOCKED"

# Source type names and what becomes of them.
CHARACTER_LENGTHS = {"VARCHAR2": 4000, "NVARCHAR2": 4000, "CHAR": 1, "NCHAR": 1}
LARGE_TEXT = ("CLOB", "NCLOB")
LARGE_BYTES = ("BLOB", "RAW")
ALWAYS_BLOCKED = ("BFILE", "LONG", "XMLTYPE", "SDO_GEOMETRY")
# Most digits that fit each integer type of the target.
INTEGER_DIGITS = ((4, T.ShortType()), (9, T.IntegerType()), (18, T.LongType()))

_ZONED = re.compile(r"TIMESTAMP(\(\d+\))? WITH( LOCAL)? TIME ZONE")
_PLAIN_TIMESTAMP = re.compile(r"TIMESTAMP(\(\d+\))?")


@dataclass(frozen=True)
class TypeChoice:
    """``max_length`` limits text columns; ``type`` is None for a blocked column."""

    type: T.DataType | None
    risk: str
    note: str = ""
    max_length: int | None = None


def choose_type(
    source_type: str | None,
    precision: int | None = None,
    scale: int | None = None,
    fallback_to_text: bool = False,
) -> TypeChoice:
    name = " ".join((source_type or "").upper().split())
    if name == "NUMBER":
        return _number(precision, scale or 0)
    if name in CHARACTER_LENGTHS:
        limit = CHARACTER_LENGTHS[name] if precision is None else precision
        return TypeChoice(T.StringType(), READY, max_length=limit)
    if name in LARGE_TEXT:
        return TypeChoice(T.StringType(), REVIEW, f"{name} needs a size review")
    if name in LARGE_BYTES:
        return TypeChoice(T.BinaryType(), REVIEW, f"{name} needs a size review")
    if name == "DATE" or _PLAIN_TIMESTAMP.fullmatch(name):
        return TypeChoice(T.TimestampNTZType(), READY)
    if _ZONED.fullmatch(name):
        return TypeChoice(T.TimestampType(), READY)
    if name.startswith("INTERVAL"):
        return TypeChoice(T.StringType(), READY)
    if fallback_to_text and name not in ALWAYS_BLOCKED:
        return TypeChoice(T.StringType(), REVIEW, f"{name} is kept as text")
    return TypeChoice(None, BLOCKED, f"{name or 'an unnamed type'} is not supported")


def _number(precision: int | None, scale: int) -> TypeChoice:
    if precision is None:
        return TypeChoice(T.DecimalType(38, 18), REVIEW, "number without precision")
    if scale == 0:
        for digits, data_type in INTEGER_DIGITS:
            if precision <= digits:
                return TypeChoice(data_type, READY)
    # A negative scale drops digits before the point; a scale above the precision adds
    # zeros behind it.
    digits, scale = (precision - scale, 0) if scale < 0 else (max(precision, scale), scale)
    if digits > 38:
        return TypeChoice(None, BLOCKED, f"a decimal of {digits} digits is out of range")
    return TypeChoice(T.DecimalType(digits, scale), READY)
