"""Integer rules: strict 32-bit parsing and total pay with optional wrap."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from salaria.schema import OVERFLOW_WIDEN, OVERFLOW_WRAP

INT32_MIN = -(2**31)
INT32_SPAN = 2**32


def _bmp_decimal_digits() -> tuple[str, str]:
    """Non-ASCII decimal digits of the Basic Multilingual Plane and their values.

    Java's ``Integer.parseInt`` reads any BMP character of category Nd as a digit
    (it works on UTF-16 units, so supplementary-plane digits are rejected). The
    table is derived from the Unicode database rather than written out.
    """
    src, dst = [], []
    for cp in range(0x80, 0x10000):
        ch = chr(cp)
        if unicodedata.category(ch) == "Nd":
            src.append(ch)
            dst.append(str(unicodedata.digit(ch)))
    return "".join(src), "".join(dst)


NON_ASCII_DIGITS, ASCII_DIGIT_VALUES = _bmp_decimal_digits()

# Optional sign then one or more digits, anchored at the very start and end.
# ``\z`` (not ``$``) so that a trailing U+2028 or newline is not accepted.
INTEGER_PATTERN = r"\A[+-]?[0-9]+\z"


def strict_int(col: Column) -> Column:
    """Parse like ``Integer.parseInt``: NULL unless the text is an in-range int32.

    The regex rejects decimals, exponents, spaces, lone signs and stray control
    characters (``try_cast`` alone accepts ``'7\\x7f'``); ``try_cast`` adds the
    range check (``2147483648`` -> NULL).
    """
    # translate allocates per character: apply it only to text with non-ASCII
    # characters (in UTF-8 exactly those whose byte length exceeds the char length).
    is_ascii = F.length(col) == F.octet_length(col)
    digits = F.when(is_ascii, col).otherwise(F.translate(col, NON_ASCII_DIGITS, ASCII_DIGIT_VALUES))
    return F.when(digits.rlike(INTEGER_PATTERN), digits.try_cast("int"))


def wrap_int32(col: Column) -> Column:
    """Map a BIGINT onto the 32-bit two's complement range (Java int overflow)."""
    return F.pmod(col + F.lit(-INT32_MIN), F.lit(INT32_SPAN)) + F.lit(INT32_MIN)


def total_pay(base_salary: Column, bonus: Column, overflow: str = OVERFLOW_WIDEN) -> Column:
    """``base_salary + bonus`` as BIGINT; ``overflow='wrap'`` reproduces int wrap-around.

    Spark's ANSI ``int + int`` would raise on overflow and kill the job, so the sum
    is always formed in BIGINT first.
    """
    s = base_salary.cast("bigint") + bonus.cast("bigint")
    if overflow == OVERFLOW_WIDEN:
        return s
    if overflow == OVERFLOW_WRAP:
        return wrap_int32(s)
    raise ValueError(f"overflow must be {OVERFLOW_WIDEN!r} or {OVERFLOW_WRAP!r}, not {overflow!r}")
