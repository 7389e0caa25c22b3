"""Join, total pay and per-employee maximum.

Plan at scale (payroll is the big, possibly skewed side):

1. ``key_info``: payroll pre-aggregated per employee (``max`` and ``count``, with
   map-side partial aggregation, so a hot key costs one row per map task) full
   outer joined with one employee row per key. Both sides come out of their
   aggregates hash-partitioned by ``employee_id``, so the sort-merge join adds no
   exchange; it sorts one row per key and spills if a partition is large (a
   shuffled hash join would have to hold a partition's keys in memory).
2. The key table is materialised in the checkpoint folder and measured.
3. Every payroll row gets its employee's attributes and ``max_pay`` through
   ``plans.keyjoin.attach_by_key``: a size-checked broadcast (payroll rows are
   never shuffled) or a salted shuffle join. No window over ``employee_id`` is
   used: it would buffer a hot key's rows in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salaria import schema as S
from salaria.functions import total_pay
from salaria.plans import keyjoin
from salaria.plans.scratch import materialize, session_scratch


def one_per_key(employees: DataFrame) -> DataFrame:
    """One employee record per id: duplicates must not multiply payroll rows.

    The reference lets the last record seen win, in an unspecified order; here the
    greatest ``(first_name, last_name, department)`` wins, a pure function of the
    data. Partial aggregation collapses duplicates before the shuffle.
    """
    best = F.max(F.struct(S.FIRST_NAME, S.LAST_NAME, S.DEPARTMENT)).alias("_best")
    return employees.groupBy(S.EMPLOYEE_ID).agg(best).select(
        S.EMPLOYEE_ID,
        F.col(f"_best.{S.FIRST_NAME}").alias(S.FIRST_NAME),
        F.col(f"_best.{S.LAST_NAME}").alias(S.LAST_NAME),
        F.col(f"_best.{S.DEPARTMENT}").alias(S.DEPARTMENT),
    )


def with_total_pay(payroll: DataFrame, overflow: str = S.OVERFLOW_WIDEN) -> DataFrame:
    """Adds ``total_pay = base_salary + bonus`` (BIGINT, or int32-wrapped)."""
    return payroll.withColumn(S.TOTAL_PAY, total_pay(F.col(S.BASE_SALARY), F.col(S.BONUS), overflow))


def max_pay_by_employee(payroll_with_total: DataFrame) -> DataFrame:
    """Greatest ``total_pay`` per employee id (partial + final aggregate)."""
    return payroll_with_total.groupBy(S.EMPLOYEE_ID).agg(F.max(S.TOTAL_PAY).alias(S.MAX_PAY))


def key_info(employees_one: DataFrame, payroll_with_total: DataFrame) -> DataFrame:
    """Every key of either side: name, department, ``max_pay``, ``n_payroll``.

    ``has_employee`` is NULL for payroll without an employee and ``n_payroll`` is
    NULL for employees without payroll.
    """
    pay_keys = payroll_with_total.groupBy(S.EMPLOYEE_ID).agg(
        F.max(S.TOTAL_PAY).alias(S.MAX_PAY), F.count(F.lit(1)).alias(S.N_PAYROLL)
    )
    emp_keys = employees_one.select(
        S.EMPLOYEE_ID,
        F.concat(F.col(S.FIRST_NAME), F.lit(" "), F.col(S.LAST_NAME)).alias(S.FULL_NAME),
        S.DEPARTMENT,
        F.lit(True).alias(S.HAS_EMPLOYEE),
    )
    return pay_keys.join(emp_keys, S.EMPLOYEE_ID, "full")


def tagged_keys(employees: DataFrame, payroll: DataFrame) -> DataFrame:
    """Every key of either side, from a union of tagged ids and one aggregate (no join, no sort).

    ``has_employee`` and ``n_payroll`` as in ``key_info``. A hot key costs one narrow
    partial row per map task.
    """
    def tag(df: DataFrame, has_employee, payroll_lines) -> DataFrame:
        return df.select(S.EMPLOYEE_ID, F.lit(has_employee).cast("boolean").alias(S.HAS_EMPLOYEE),
                         F.lit(payroll_lines).cast("bigint").alias(S.N_PAYROLL))

    return tag(employees, True, None).unionAll(tag(payroll, None, 1)).groupBy(S.EMPLOYEE_ID).agg(
        F.max(S.HAS_EMPLOYEE).alias(S.HAS_EMPLOYEE), F.sum(S.N_PAYROLL).alias(S.N_PAYROLL))


# Rejected lines are counted under marker keys: U+0000 followed by the status.
# No employee id can equal one, since ids are trimmed of U+0000..U+0020.
REJECT_MARK = "\x00"


def rejected_key(status: str) -> str:
    return REJECT_MARK + status


def is_employee_key(col: Column) -> Column:
    """True for a real employee id, false for a marker key of rejected lines."""
    return ~col.startswith(REJECT_MARK)


def _group_key() -> Column:
    ok = F.col(S.STATUS) == S.OK
    return F.when(ok, F.col(S.EMPLOYEE_ID)).otherwise(F.concat(F.lit(REJECT_MARK), F.col(S.STATUS)))


def key_info_with_counts(
    classified_employees: DataFrame, classified_payroll: DataFrame, overflow: str = S.OVERFLOW_WIDEN
) -> DataFrame:
    """``key_info`` built from *all* classified lines, carrying the line counts.

    Valid lines group by ``employee_id``; rejected lines group under one marker
    key per status (``rejected_key``), which partial aggregation collapses to
    one row per map task however many lines are bad. The grouping stays a single
    key column, so the aggregates' hash partitioning serves the join, and the
    partial rows stay narrow (key, max, count). Besides the ``key_info`` columns
    a row holds ``n_employee`` (valid employee lines of the key) and, on marker
    rows, ``pay_rejected`` / ``emp_rejected`` (lines with that status), so the
    quality counters are exact sums over this table: no second scan, and no
    accumulator that a re-run stage would count twice.
    """
    ok = F.col(S.STATUS) == S.OK
    is_key = is_employee_key(F.col(S.EMPLOYEE_ID))
    pay = classified_payroll.select(
        _group_key().alias(S.EMPLOYEE_ID),
        F.when(ok, total_pay(F.col(S.BASE_SALARY), F.col(S.BONUS), overflow)).alias(S.TOTAL_PAY),
    )
    pay_keys = pay.groupBy(S.EMPLOYEE_ID).agg(
        F.max(S.TOTAL_PAY).alias(S.MAX_PAY), F.count(F.lit(1)).alias("_lines")
    ).select(
        S.EMPLOYEE_ID,
        S.MAX_PAY,
        F.when(is_key, F.col("_lines")).alias(S.N_PAYROLL),
        F.when(~is_key, F.col("_lines")).alias("pay_rejected"),
    )
    emp = classified_employees.select(
        _group_key().alias(S.EMPLOYEE_ID),
        F.when(ok, F.struct(S.FIRST_NAME, S.LAST_NAME, S.DEPARTMENT)).alias("_record"),
    )
    emp_keys = emp.groupBy(S.EMPLOYEE_ID).agg(
        F.max("_record").alias("_best"), F.count(F.lit(1)).alias("_lines")
    ).select(
        S.EMPLOYEE_ID,
        F.concat(F.col(f"_best.{S.FIRST_NAME}"), F.lit(" "), F.col(f"_best.{S.LAST_NAME}")).alias(S.FULL_NAME),
        F.col(f"_best.{S.DEPARTMENT}").alias(S.DEPARTMENT),
        F.when(is_key, F.lit(True)).alias(S.HAS_EMPLOYEE),
        F.when(is_key, F.col("_lines")).alias("n_employee"),
        F.when(~is_key, F.col("_lines")).alias("emp_rejected"),
    )
    return pay_keys.join(emp_keys, S.EMPLOYEE_ID, "full")


def payroll_report(
    employees: DataFrame | None,
    payroll: DataFrame,
    overflow: str = S.OVERFLOW_WIDEN,
    *,
    keys: DataFrame | None = None,
    scratch: str | None = None,
    keep_line_id: bool = False,
    ordered: bool = False,
    order_partitions: int | None = None,
    join_partitions: int | None = None,
    max_broadcast_bytes: int = keyjoin.DEFAULT_MAX_BROADCAST_BYTES,
    rows_per_task: int = keyjoin.DEFAULT_ROWS_PER_TASK,
    key_size: keyjoin.KeyTableSize | None = None,
) -> DataFrame:
    """One report row per valid payroll record, payroll LEFT OUTER employee.

    Not fully lazy: without ``keys`` it first writes the narrow payroll (so that the
    input is parsed once) and the key table, and measures the latter, because the
    join strategy depends on the measured size; the returned report is lazy and reads
    those tables. They lie in ``scratch`` (see ``plans.scratch.scratch_scope``), or
    else in a folder that is deleted when Python ends.
    ``employees`` and ``payroll`` are valid records (``valid_employees`` /
    ``valid_payroll``; ``payroll`` needs ``employee_id, month, base_salary,
    bonus``). ``keys`` may pass an already materialised ``key_info`` of the same
    inputs (``employees`` is then not read).
    Unknown employees get ``UNKNOWN EMPLOYEE`` / ``UNKNOWN``. With ``ordered``
    the rows are totally ordered by ``(employee_id, line_id)``: this unique
    composite key splits a hot key, or a mass of identical lines, over many
    tasks. A missing ``line_id`` is
    assigned here, and fixed by writing the rows with it before anything is
    partitioned by it.
    """
    spark = payroll.sparkSession
    folder = None

    def stage(df: DataFrame, name: str) -> DataFrame:
        nonlocal folder
        folder = folder or scratch or session_scratch(spark, "report")
        return materialize(df, f"{folder}/{name}")

    own_ids = S.LINE_ID not in payroll.columns
    if own_ids:
        payroll = payroll.withColumn(S.LINE_ID, F.monotonically_increasing_id())
    pay = with_total_pay(payroll.select(S.EMPLOYEE_ID, S.MONTH, S.BASE_SALARY, S.BONUS, S.LINE_ID), overflow)
    pay = pay.drop(S.BASE_SALARY, S.BONUS)
    if keys is None and employees is None:
        raise ValueError("employees are needed when no key table is given")
    if keys is None or own_ids:
        pay = stage(pay, "report_payroll")
    if keys is None:
        keys = stage(key_info(one_per_key(employees), pay), "report_keys")
    attrs = keys.filter(F.col(S.N_PAYROLL).isNotNull()).select(
        S.EMPLOYEE_ID, S.FULL_NAME, S.DEPARTMENT, S.MAX_PAY, S.N_PAYROLL
    )
    joined = keyjoin.attach_by_key(
        pay, attrs, S.EMPLOYEE_ID, S.N_PAYROLL, S.LINE_ID,
        order_by=(S.EMPLOYEE_ID, S.LINE_ID) if ordered else (),
        order_partitions=order_partitions,
        join_partitions=join_partitions,
        max_broadcast_bytes=max_broadcast_bytes, rows_per_task=rows_per_task, size=key_size,
        stage=stage,
    )
    out = [
        S.EMPLOYEE_ID,
        F.coalesce(F.col(S.FULL_NAME), F.lit(S.UNKNOWN_EMPLOYEE)).alias(S.FULL_NAME),
        F.coalesce(F.col(S.DEPARTMENT), F.lit(S.UNKNOWN_DEPARTMENT)).alias(S.DEPARTMENT),
        S.MONTH,
        S.TOTAL_PAY,
        S.MAX_PAY,
    ]
    if keep_line_id:
        out.append(S.LINE_ID)
    return joined.select(*out)


def report_lines(report: DataFrame) -> DataFrame:
    """The text sink's line: ``employee_id TAB full_name,department,month,total,max``."""
    value = F.concat(
        F.col(S.EMPLOYEE_ID),
        F.lit(S.OUTPUT_KEY_SEPARATOR),
        F.concat_ws(
            S.FIELD_DELIMITER,
            S.FULL_NAME,
            S.DEPARTMENT,
            S.MONTH,
            F.col(S.TOTAL_PAY).cast("string"),
            F.col(S.MAX_PAY).cast("string"),
        ),
    ).alias(S.REPORT_LINE)
    extra = [S.LINE_ID] if S.LINE_ID in report.columns else []
    return report.select(value, *extra)
