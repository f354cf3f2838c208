"""Canonical text, names, types and conversions."""

from __future__ import annotations

import hashlib
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyport.functions import canon
from tallyport.functions.convert import convert_values, exact_integer
from tallyport.functions.names import RESERVED_WORDS, rename_reserved, target_name
from tallyport.functions.text import VENDOR_SQL_PATTERNS, collapsed, holds
from tallyport.functions.types import BLOCKED, READY, REVIEW, choose_type


def one(df):
    return df.first()[0]


def test_fields_keep_null_text_and_delimiters_apart(spark):
    values = [("NULL", "a"), (None, "a"), ("N", "a"), ("1:x", ""), ("1", ":x"), ("a||", "b"), ("a", "||b")]
    df = spark.createDataFrame(values, "x string, y string")
    texts = [r[0] for r in df.select(canon.row_text(df)).collect()]
    assert len(set(texts)) == len(values)
    assert texts[1] == "N1:a"


def test_fingerprint_is_sixty_bits_of_md5(spark):
    df = spark.createDataFrame([("abc",)], "x string")
    expected = int(hashlib.md5(b"abc").hexdigest()[:15], 16)
    assert one(df.select(canon.text_fingerprint(F.col("x")))) == expected


@pytest.mark.parametrize(
    ("value", "kind", "scale", "text"),
    [
        ("12", "int", None, "12"),
        ("12.345", "double", 2, "1235"),
        ("-0.0", "double", None, "0.0"),
        ("1e300", "double", 2, "1.0E300"),
        ("NaN", "double", 2, "NaN"),
        ("12.50", "decimal(6,2)", None, "12.50"),
        ("true", "boolean", None, "true"),
        ("1970-01-03", "date", None, "2"),
        ("1970-01-02 00:00:01.000007", "timestamp_ntz", None, "86401000007"),
    ],
)
def test_canonical_text(spark, value, kind, scale, text):
    df = spark.range(1).select(F.lit(value).cast(kind).alias("v"))
    assert one(df.select(canon.canonical_text(F.col("v"), df.schema["v"].dataType, scale))) == text


def test_canonical_binary_and_nested(spark):
    df = spark.createDataFrame([(bytearray(b"\x01\xff"), [1])], "b binary, a array<int>")
    assert one(df.select(canon.canonical_text(F.col("b"), T.BinaryType()))) == "01FF"
    with pytest.raises(TypeError):
        canon.canonical_text(F.col("a"), df.schema["a"].dataType)


def test_zoneless_timestamp_does_not_depend_on_the_session_zone(spark):
    df = spark.sql("select timestamp_ntz'2024-07-01 12:34:56.789012' as t, timestamp_ntz'1901-01-01 00:00:00' as u")

    def micros():
        return df.select(*[canon.epoch_micros(F.col(c), T.TimestampNTZType()) for c in ("t", "u")]).first()

    before = micros()
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert tuple(micros()) == tuple(before)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert before[0] == 1719837296789012
    assert before[1] < 0


@pytest.mark.parametrize("number", [0.125, -0.125, 0.115, 2.675, 1e15 + 0.3, -7.005, 0.0, 12.344999])
def test_cents_round_half_away_from_zero(spark, number):
    df = spark.createDataFrame([(number,)], "d double")
    text = one(df.select(canon.canonical_text(F.col("d"), T.DoubleType(), 2)))
    shifted = number * 100.0
    wanted = math.copysign(math.floor(abs(shifted)) + (abs(shifted) % 1 >= 0.5), shifted)
    assert text == str(int(wanted))


@pytest.mark.parametrize("method", [canon.PORTABLE, canon.NATIVE])
def test_fingerprints_tell_rows_apart_and_look_past_types(spark, method):
    values = [(1, None, "a"), (1, "a", None), (None, "1", "a"), (2, "", "a"), (2, None, "a"), (2, "a", "a")]
    df = spark.createDataFrame(values, "n long, x string, y string")
    prints = [r[0] for r in df.select(canon.row_fingerprint(df, method=method)).collect()]
    assert len(set(prints)) == len(values)
    assert all(0 <= p < 1 << 60 for p in prints)
    other = df.withColumn("n", F.col("n").cast("decimal(18,0)"))
    assert [r[0] for r in other.select(canon.row_fingerprint(other, method=method)).collect()] == prints


def test_native_fingerprint_of_other_types(spark):
    df = spark.sql(
        "select date'2024-01-01' as d, timestamp_ntz'2024-01-01 01:02:03' as t, 1.5BD as b, true as f, "
        "1.2d as p, double('NaN') as q, interval '1' day as i"
    )
    value = one(df.select(canon.row_fingerprint(df, scales={"p": 2, "q": 2}, method=canon.NATIVE)))
    near = df.withColumn("p", F.lit(1.2004))
    assert one(near.select(canon.row_fingerprint(near, scales={"p": 2, "q": 2}, method=canon.NATIVE))) == value
    with pytest.raises(ValueError, match="method"):
        canon.row_fingerprint(df, method="crc")


def test_large_columns_are_split_off(spark):
    schema = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("doc", T.StringType(), True, {canon.SOURCE_TYPE: "nclob"}),
            T.StructField("long_text", T.StringType(), True, {canon.SOURCE_TYPE: "LONG"}),
            T.StructField("raw", T.BinaryType()),
            T.StructField("vector", T.ArrayType(T.FloatType())),
            T.StructField("name", T.StringType(), True, {canon.SOURCE_TYPE: "VARCHAR2"}),
        ]
    )
    assert canon.split_columns(schema) == (["id", "name"], ["doc", "long_text", "raw", "vector"])


def test_bytes_as_text(spark):
    df = spark.createDataFrame([(bytearray("é".encode()),), (bytearray(b"\xff\x00"),), (None,)], "b binary")
    assert [r[0] for r in df.select(canon.bytes_as_text(F.col("b"))).collect()] == ["é", "FF00", None]


def test_names():
    assert len(RESERVED_WORDS) == 12
    assert target_name("LIMIT") == "limit_"
    assert target_name("limit", "QUOTE") == "LIMIT"
    assert target_name("Account_No") == "account_no"
    assert target_name("Zone", reserved={"ZONE"}) == "zone_"
    with pytest.raises(ValueError):
        target_name("a", "OTHER")


def test_rename_keeps_values_and_refuses_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "ID long, LIMIT long")
    renamed = rename_reserved(df)
    assert renamed.columns == ["id", "limit_"]
    assert tuple(renamed.first()) == (1, 2)
    with pytest.raises(ValueError, match="limit_"):
        rename_reserved(spark.createDataFrame([(1, 2)], "LIMIT long, limit_ long"))


@pytest.mark.parametrize(
    ("source", "precision", "scale", "spark_type", "risk"),
    [
        ("NUMBER", 4, 0, "smallint", READY),
        ("NUMBER", 5, 0, "int", READY),
        ("NUMBER", 9, 0, "int", READY),
        ("NUMBER", 10, None, "bigint", READY),
        ("NUMBER", 18, 0, "bigint", READY),
        ("NUMBER", 19, 0, "decimal(19,0)", READY),
        ("number", 10, 2, "decimal(10,2)", READY),
        ("NUMBER", 5, -2, "decimal(7,0)", READY),
        ("NUMBER", 2, 5, "decimal(5,5)", READY),
        ("NUMBER", None, None, "decimal(38,18)", REVIEW),
        ("VARCHAR2", 20, None, "string", READY),
        ("NCHAR", None, None, "string", READY),
        ("DATE", None, None, "timestamp_ntz", READY),
        ("TIMESTAMP(6)", None, None, "timestamp_ntz", READY),
        ("timestamp(3)  with   local time zone", None, None, "timestamp", READY),
        ("TIMESTAMP WITH TIME ZONE", None, None, "timestamp", READY),
        ("INTERVAL DAY(2) TO SECOND(6)", None, None, "string", READY),
        ("CLOB", None, None, "string", REVIEW),
        ("BLOB", None, None, "binary", REVIEW),
        ("RAW", None, None, "binary", REVIEW),
    ],
)
def test_type_choice(source, precision, scale, spark_type, risk):
    choice = choose_type(source, precision, scale)
    assert (choice.type.simpleString(), choice.risk) == (spark_type, risk)


def test_unsupported_types():
    for name in ("BFILE", "LONG", "XMLTYPE", "SDO_GEOMETRY"):
        assert choose_type(name, fallback_to_text=True).risk == BLOCKED
    assert choose_type("MYTYPE").risk == BLOCKED
    assert choose_type(None).risk == BLOCKED
    assert choose_type("MYTYPE", fallback_to_text=True).type == T.StringType()
    assert choose_type("VARCHAR2").max_length == 4000
    assert choose_type("CHAR").max_length == 1


def test_conversion_hook_and_nulls(spark):
    df = spark.sql("select interval '1 02:00:00' day to second as i, date'2024-01-02' as d, 'x' as s, null as n")
    out = convert_values(df, by_column={"s": lambda value, field: F.upper(value)})
    assert [f.dataType.simpleString() for f in out.schema] == ["string", "timestamp_ntz", "string", "void"]
    assert out.first()["s"] == "X"
    assert out.first()["i"] == "INTERVAL '1 02:00:00' DAY TO SECOND"


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("12", 12), (" 12.00 ", 12), ("-7.", -7), ("+3", 3), ("1e3", 1000), ("1.5", None), ("1.5e1", 15),
        ("0.00000000000000000001", None), ("abc", None), ("", None), ("99999999999999999999", None), (None, None),
    ],
)
def test_exact_integer_of_text(spark, text, number):
    df = spark.createDataFrame([(text,)], "t string")
    assert one(df.select(exact_integer(F.col("t"), T.StringType(), T.LongType()))) == number


def test_exact_integer_of_numbers(spark):
    df = spark.sql("select 3.0d as a, 3.5d as b, double('NaN') as c, double('Infinity') as d, 40000L as e")
    double, short = T.DoubleType(), T.ShortType()
    got = df.select(
        *[exact_integer(F.col(c), double, short) for c in "abcd"], exact_integer(F.col("e"), T.LongType(), short)
    ).first()
    assert tuple(got) == (3, None, None, None, None)


@pytest.mark.parametrize("text", ["select 1 FROM \n\t dual", "a(+)b", "x CONNECT   BY y", "fromdual", "plain", "from  dualx"])
def test_word_search_equals_search_in_collapsed_text(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    for literals in VENDOR_SQL_PATTERNS.values():
        for literal in literals:
            both = df.select(
                holds(F.lower("t"), literal), collapsed(F.col("t")).contains(literal)
            ).first()
            assert both[0] == both[1], literal
