import pytest
from pyspark.sql import functions as F

from salaria.functions import java_trim, split_fields, strict_int, total_pay, wrap_int32


def _one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("\t a\t", "a"),
        ("\x01a\x1f", "a"),
        (" a", " a"),        # U+00A0 is not trimmed
        ("a  ", "a  "),      # U+2028 is above U+0020: kept, inner space kept
        ("\x00 a b \x20", "a b"),
        ("", ""),
        ("\x7f", "\x7f"),
    ],
)
def test_java_trim(spark, value, expected):
    assert _one(spark, java_trim, value) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("a,b,,", ["a", "b", "", ""]),
        (",,,", ["", "", "", ""]),
        ('"E,x",L,D', ['"E', 'x"', "L", "D"]),
        ("a.b", ["a.b"]),
        ("", [""]),
    ],
)
def test_split_keeps_empty_fields_and_ignores_quotes(spark, value, expected):
    assert _one(spark, lambda c: split_fields(c), value) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("7", 7), ("+7", 7), ("007", 7), ("-0", 0), ("-7", -7),
        ("2147483647", 2147483647), ("-2147483648", -2147483648),
        ("٣", 3), ("1٣", 13), ("７", 7),
        ("8000.5", None), ("1e3", None), ("+", None), ("-", None), ("N/A", None), ("1 2", None),
        ("0x1", None), ("2147483648", None), ("-2147483649", None), ("7\x7f", None),
        ("7 ", None), ("7\n", None), ("", None), (" 7", None), (None, None),
        ("\U0001d7ce", None),  # supplementary-plane digit: not a Java char digit
    ],
)
def test_strict_int_matches_parse_int(spark, value, expected):
    assert _one(spark, strict_int, value) == expected


def test_total_pay_widen_and_wrap(spark):
    df = spark.createDataFrame([(2147483647, 1), (2147483647, 2147483647), (5, 6)], "b int, o int")
    rows = df.select(
        total_pay(F.col("b"), F.col("o")).alias("w"), total_pay(F.col("b"), F.col("o"), "wrap").alias("x")
    ).collect()
    assert [(r.w, r.x) for r in rows] == [
        (2147483648, -2147483648),
        (4294967294, -2),
        (11, 11),
    ]


def test_wrap_int32_general(spark):
    df = spark.createDataFrame([(v,) for v in (-2147483649, -1, 0, 4294967296, 6442450943)], "v long")
    got = [r.r for r in df.select(wrap_int32(F.col("v")).alias("r")).collect()]
    assert got == [2147483647, -1, 0, 0, 2147483647]


def test_total_pay_rejects_unknown_mode():
    with pytest.raises(ValueError):
        total_pay(F.lit(1), F.lit(2), "saturate")
