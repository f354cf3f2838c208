"""Value conversion on the way to the target."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Converter = Callable[[Column, T.StructField], Column]


def _interval_text(value: Column, field: T.StructField) -> Column:
    return value.cast("string")


def _day_with_time(value: Column, field: T.StructField) -> Column:
    return value.cast("timestamp_ntz")


DEFAULT_CONVERTERS: Mapping[type, Converter] = {
    T.DayTimeIntervalType: _interval_text,
    T.YearMonthIntervalType: _interval_text,
    T.DateType: _day_with_time,
}


def convert_values(
    df: DataFrame,
    converters: Mapping[type, Converter] = DEFAULT_CONVERTERS,
    by_column: Mapping[str, Converter] | None = None,
) -> DataFrame:
    """Project every column through the converter of its name or else of its type.

    Columns without a converter pass unchanged, and so do nulls, large text and bytes.
    """
    by_column = by_column or {}
    projected = []
    for field in df.schema:
        convert = by_column.get(field.name) or converters.get(type(field.dataType))
        value = F.col(f"`{field.name}`")
        projected.append(convert(value, field).alias(field.name) if convert else value)
    return df.select(*projected)


def exact_integer(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """The value as a whole number of the target type, else null.

    Blanks around text and zeros after the decimal point do not matter; fractions and
    numbers out of range give null.
    """
    if isinstance(source, T.IntegralType):
        return value.try_cast(target)
    if isinstance(source, (T.FractionalType, T.DecimalType)):
        return F.when(value == F.floor(value), value.try_cast(target))
    text = F.trim(value.cast("string"))
    # Plain digits are cast as they are; only other forms, such as exponents, take the
    # slow way over decimals.
    number = text.try_cast("decimal(38,18)")
    return (
        F.when(text.rlike(r"^[+-]?[0-9]+(\.0*)?$"), F.substring_index(text, ".", 1).try_cast(target))
        .when(text.rlike(r"\.[0-9]*[1-9][0-9]*$"), None)
        .when(number == F.floor(number), number.try_cast(target))
    )
