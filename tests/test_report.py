import contextlib
import io

from pyspark.sql import functions as F

from salaria import schema as S
from salaria.operators import (
    clean_employees, clean_payroll, key_census, key_info, one_per_key, payroll_report,
    report_lines, valid_employees, valid_payroll, with_total_pay,
)

from helpers import lines_df

EMPLOYEES = [
    "EMP01,Nour,Hassan,Engineering",
    "EMP02,Ali,Mahmoud,HR",
    "EMP03,Sara,Khaled,Finance",
]
PAYROLL = [
    "PR001,EMP01,Jan,8000,500",
    "PR002,EMP01,Feb,8200,500",
    "PR003,EMP02,Jan,7000,300",
    "PR004,EMP03,Jan,9000,700",
    "PR005,EMP04,Jan,7500,400",
    "PR006,EMP02,Feb,INVALID,300",
]
GOLDEN = sorted([
    ("EMP01", "Nour Hassan", "Engineering", "Jan", 8500, 8700),
    ("EMP01", "Nour Hassan", "Engineering", "Feb", 8700, 8700),
    ("EMP02", "Ali Mahmoud", "HR", "Jan", 7300, 7300),
    ("EMP03", "Sara Khaled", "Finance", "Jan", 9700, 9700),
    ("EMP04", "UNKNOWN EMPLOYEE", "UNKNOWN", "Jan", 7900, 7900),
])


def _inputs(spark, emp_lines, pay_lines):
    emp = valid_employees(clean_employees(lines_df(spark, emp_lines)))
    pay = valid_payroll(clean_payroll(lines_df(spark, pay_lines, with_id=True)), keep=(S.LINE_ID,))
    return emp, pay


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_golden_sample(spark):
    emp, pay = _inputs(spark, EMPLOYEES, PAYROLL)
    rep = payroll_report(emp, pay)
    assert rep.columns == list(S.REPORT_COLUMNS)
    assert _rows(rep) == GOLDEN


def test_golden_sample_salted_path(spark):
    emp, pay = _inputs(spark, EMPLOYEES, PAYROLL)
    rep = payroll_report(emp, pay, max_broadcast_bytes=0, rows_per_task=1)
    assert _rows(rep) == GOLDEN
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        rep.explain()
    assert "_salt" in buf.getvalue()


def test_golden_census(spark):
    emp, pay = _inputs(spark, EMPLOYEES, PAYROLL)
    keys = key_info(one_per_key(emp), with_total_pay(pay))
    assert key_census(keys).first().asDict() == {
        "keys_processed": 4, "missing_employee_records": 1, "no_payroll_records": 0,
    }


def test_report_lines_text(spark):
    emp, pay = _inputs(spark, EMPLOYEES, PAYROLL)
    lines = sorted(r.value for r in report_lines(payroll_report(emp, pay)).collect())
    assert lines[0] == "EMP01\tNour Hassan,Engineering,Feb,8700,8700"
    assert "EMP04\tUNKNOWN EMPLOYEE,UNKNOWN,Jan,7900,7900" in lines


def test_duplicate_employee_does_not_multiply_rows(spark):
    emp, pay = _inputs(spark, EMPLOYEES + ["EMP01,Zed,Other,Sales"], PAYROLL)
    rep = payroll_report(emp, pay)
    assert rep.count() == 5
    names = {r.full_name for r in rep.filter(F.col(S.EMPLOYEE_ID) == "EMP01").collect()}
    assert names == {"Zed Other"}  # greatest (first, last, department) wins


def test_duplicate_payroll_lines_kept(spark):
    emp, pay = _inputs(spark, EMPLOYEES, PAYROLL + ["PR001,EMP01,Jan,8000,500"])
    assert payroll_report(emp, pay).filter(F.col(S.EMPLOYEE_ID) == "EMP01").count() == 3


def test_overflow_modes(spark):
    emp, pay = _inputs(spark, EMPLOYEES, ["P1,EMP01,Jan,2147483647,1", "P2,EMP01,Feb,5,5"])
    widen = _rows(payroll_report(emp, pay).select(S.MONTH, S.TOTAL_PAY, S.MAX_PAY))
    wrap = _rows(payroll_report(emp, pay, "wrap").select(S.MONTH, S.TOTAL_PAY, S.MAX_PAY))
    assert widen == [("Feb", 10, 2147483648), ("Jan", 2147483648, 2147483648)]
    # The reference adds two ints: the sum wraps and the max is over wrapped values.
    assert wrap == [("Feb", 10, 10), ("Jan", -2147483648, 10)]


def test_hot_key_is_split_over_buckets(spark):
    """A key with most of the rows is spread over several join tasks on the salted path."""
    pay_lines = [f"P{i},HOT,M{i % 12},{i},1" for i in range(3000)] + [f"Q{i},E{i},M1,{i},1" for i in range(300)]
    emp, pay = _inputs(spark, ["HOT,Hot,Key,Ops"], pay_lines)
    rep = payroll_report(emp, pay, max_broadcast_bytes=0, rows_per_task=500)
    # AQE would merge these tiny partitions into one; keep them apart to observe the split.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = rep.filter(F.col(S.EMPLOYEE_ID) == "HOT")
        per_task = hot.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(per_task) > 1
    assert max(r["count"] for r in per_task) < 3000
    assert rep.count() == 3300
    hot_max = {r.max_pay for r in rep.filter(F.col(S.EMPLOYEE_ID) == "HOT").collect()}
    assert hot_max == {3000}
