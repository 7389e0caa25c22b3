"""Data-quality and join-quality counts (the reference's job counters).

Each count is a plain aggregate expression; the job folds its counts into the key
table (``counts_from_key_table_exprs``), so no line is scanned twice for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salaria import schema as S


def _status_count(status: str) -> Column:
    return F.count_if(F.col(S.STATUS) == status)


def employee_quality_exprs() -> list[Column]:
    return [
        F.count(F.lit(1)).alias(S.LINES_READ),
        _status_count(S.OK).alias(S.RECORDS_EMITTED),
        _status_count(S.BLANK).alias(S.BLANK_LINES_SKIPPED),
        _status_count(S.MALFORMED).alias(S.MALFORMED_RECORDS_SKIPPED),
        _status_count(S.INCOMPLETE).alias(S.INCOMPLETE_RECORDS_SKIPPED),
    ]


def payroll_quality_exprs() -> list[Column]:
    return employee_quality_exprs() + [
        _status_count(S.INVALID_NUMERIC).alias(S.INVALID_NUMERIC_FIELDS_SKIPPED),
        _status_count(S.NEGATIVE).alias(S.NEGATIVE_VALUE_RECORDS_SKIPPED),
    ]


def employee_quality(classified_employees: DataFrame) -> DataFrame:
    """One row: lines read, emitted, and skipped per reason."""
    return classified_employees.agg(*employee_quality_exprs())


def payroll_quality(classified_payroll: DataFrame) -> DataFrame:
    """One row: lines read, emitted, and skipped per reason."""
    return classified_payroll.agg(*payroll_quality_exprs())


def status_counts(classified: DataFrame) -> DataFrame:
    """Lines per status (one row per status present)."""
    return classified.groupBy(S.STATUS).agg(F.count(F.lit(1)).alias("lines"))


def key_census_exprs(where: Column | None = None) -> list[Column]:
    """Census counts; ``where`` restricts the rows that count as keys."""
    cond = F.lit(True) if where is None else where
    return [
        F.count_if(cond).alias(S.KEYS_PROCESSED),
        F.count_if(cond & F.col(S.HAS_EMPLOYEE).isNull()).alias(S.MISSING_EMPLOYEE_RECORDS),
        F.count_if(cond & F.col(S.N_PAYROLL).isNull()).alias(S.NO_PAYROLL_RECORDS),
    ]


def key_census(keys: DataFrame) -> DataFrame:
    """One row over ``tagged_keys`` or ``key_info``: keys seen, keys without employee, keys without payroll."""
    return keys.agg(*key_census_exprs())


def missing_employees(keys: DataFrame) -> DataFrame:
    """Payroll keys with no valid employee record (still reported, as UNKNOWN)."""
    return keys.filter(F.col(S.HAS_EMPLOYEE).isNull()).select(S.EMPLOYEE_ID)


def employees_without_payroll(keys: DataFrame) -> DataFrame:
    """Employee keys with no valid payroll record (nothing reported for them)."""
    return keys.filter(F.col(S.N_PAYROLL).isNull()).select(S.EMPLOYEE_ID)


def report_quality(report: DataFrame, valid_payroll: DataFrame) -> DataFrame:
    """Report rows emitted next to valid payroll records; the two must be equal.

    One aggregate over a tagged union, so both counts come from a single job.
    """
    tagged = report.select(F.lit(1).alias("_r"), F.lit(0).alias("_v")).unionByName(
        valid_payroll.select(F.lit(0).alias("_r"), F.lit(1).alias("_v"))
    )
    return tagged.agg(
        F.coalesce(F.sum("_r"), F.lit(0)).cast("bigint").alias(S.RECORDS_EMITTED),
        F.coalesce(F.sum("_v"), F.lit(0)).cast("bigint").alias("valid_payroll_records"),
    )


def counts_from_key_table_exprs() -> list[Column]:
    """Quality counters as sums over ``key_info_with_counts`` (marker rows included)."""
    from salaria.operators.report import REJECT_MARK

    def total(what: str, name: str) -> Column:
        return F.expr(f"cast(coalesce(sum({what}), 0) as bigint) as {name}")

    out = []
    for side, valid, reasons in (
        ("emp", "n_employee", {S.BLANK: S.BLANK_LINES_SKIPPED, S.MALFORMED: S.MALFORMED_RECORDS_SKIPPED, S.INCOMPLETE: S.INCOMPLETE_RECORDS_SKIPPED}),
        ("pay", S.N_PAYROLL, {S.BLANK: S.BLANK_LINES_SKIPPED, S.MALFORMED: S.MALFORMED_RECORDS_SKIPPED, S.INCOMPLETE: S.INCOMPLETE_RECORDS_SKIPPED,
                              S.INVALID_NUMERIC: S.INVALID_NUMERIC_FIELDS_SKIPPED, S.NEGATIVE: S.NEGATIVE_VALUE_RECORDS_SKIPPED}),
    ):
        out += [total(f"coalesce({valid}, 0) + coalesce({side}_rejected, 0)", f"{side}_{S.LINES_READ}"), total(valid, f"{side}_{S.RECORDS_EMITTED}")]
        # Rejected lines of a status lie under its marker key.
        out += [total(f"if({S.EMPLOYEE_ID} = concat(char({ord(REJECT_MARK)}), '{status}'), {side}_rejected, null)", f"{side}_{counter}")
                for status, counter in reasons.items()]
    return out
