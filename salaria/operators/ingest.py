"""Line classification and typed records (the two ingest steps).

Every input line stays in the output with a ``status``: the first rule it fails,
or ``OK``. All rules are one narrow projection over the scan, fused by
whole-stage codegen; nothing shuffles here. Parsed columns of rejected lines may
be NULL or partly filled, so consumers select on ``status``.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salaria import schema as S
from salaria.functions import field, split_fields, strict_int

_F = "_fields"
_RAW_SALARY = "_raw_salary"
_RAW_BONUS = "_raw_bonus"


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Append columns computed exactly once per row.

    The values pass through a one-element generator, which filters on the
    classification cannot be pushed through. Without it Catalyst inlines each
    parse step into every predicate of a status filter (CASE branches are not
    shared by subexpression elimination), and again into the output projection:
    the line was split ~15 times per row, and codegen exceeded its 64 KB method
    limit when the line was itself a derived expression.
    """
    packed = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(packed)))


def _split_and_trim(lines: DataFrame, line_col: str, names: tuple[str, ...]) -> DataFrame:
    """Split the raw line, then trim each field, each step once per row.

    The line itself is not trimmed first: trimming never removes a comma, so the
    field count is the same, and the outer fields lose the same characters in the
    field trim. A line that is blank after trimming is one field, empty after trim.
    """
    # At most one part more than a valid line has: enough to tell a wrong count.
    # A NULL line counts as an empty one.
    split = split_fields(F.coalesce(F.col(line_col), F.lit("")), S.FIELD_DELIMITER, max_fields=len(names) + 1)
    parts = _once(lines, **{_F: split})
    return _once(parts, **{name: field(F.col(_F), i) for i, name in enumerate(names)})


def _is_blank(first_field: str) -> Column:
    return (F.size(_F) == 1) & (F.col(first_field) == "")


def _any_empty(names) -> Column:
    return reduce(or_, [F.col(n) == "" for n in names])


def clean_employees(lines: DataFrame, line_col: str = S.LINE) -> DataFrame:
    """Classify employee lines; adds ``status`` and the four trimmed fields.

    Rules in order: BLANK (NULL, or empty after trim), MALFORMED (not exactly 4 fields),
    INCOMPLETE (a field empty after trim), else OK. Other input columns are kept.
    """
    parts = _split_and_trim(lines, line_col, S.EMPLOYEE_FIELDS)
    status = (
        F.when(_is_blank(S.EMPLOYEE_ID), S.BLANK)
        .when(F.size(_F) != S.EMPLOYEE_FIELD_COUNT, S.MALFORMED)
        .when(_any_empty(S.EMPLOYEE_FIELDS), S.INCOMPLETE)
        .otherwise(S.OK)
    )
    return parts.withColumn(S.STATUS, status).select(*lines.columns, *S.EMPLOYEE_FIELDS, S.STATUS)


def clean_payroll(lines: DataFrame, line_col: str = S.LINE) -> DataFrame:
    """Classify payroll lines; adds ``status``, trimmed fields and the two ints.

    Rules in order: BLANK (NULL, or empty after trim), MALFORMED (not exactly 5 fields), INCOMPLETE (a field
    empty), INVALID_NUMERIC (salary or bonus not an int32), NEGATIVE (either < 0),
    else OK. Other input columns are kept.
    """
    names = (S.PAYROLL_ID, S.EMPLOYEE_ID, S.MONTH, _RAW_SALARY, _RAW_BONUS)
    parts = _split_and_trim(lines, line_col, names)
    parts = _once(
        parts, **{S.BASE_SALARY: strict_int(F.col(_RAW_SALARY)), S.BONUS: strict_int(F.col(_RAW_BONUS))}
    )
    status = (
        F.when(_is_blank(S.PAYROLL_ID), S.BLANK)
        .when(F.size(_F) != S.PAYROLL_FIELD_COUNT, S.MALFORMED)
        .when(_any_empty(names), S.INCOMPLETE)
        .when(F.col(S.BASE_SALARY).isNull() | F.col(S.BONUS).isNull(), S.INVALID_NUMERIC)
        .when((F.col(S.BASE_SALARY) < S.MIN_NUMERIC_VALUE) | (F.col(S.BONUS) < S.MIN_NUMERIC_VALUE), S.NEGATIVE)
        .otherwise(S.OK)
    )
    return parts.withColumn(S.STATUS, status).select(*lines.columns, *S.PAYROLL_FIELDS, S.STATUS)


def valid_employees(classified: DataFrame) -> DataFrame:
    """Employee records that passed every rule (duplicates by id are kept)."""
    return classified.filter(F.col(S.STATUS) == S.OK).select(*S.EMPLOYEE_FIELDS)


def valid_payroll(classified: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Payroll records that passed every rule; ``keep`` carries extra columns."""
    return classified.filter(F.col(S.STATUS) == S.OK).select(*S.PAYROLL_FIELDS, *keep)
