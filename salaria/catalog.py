"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per check.

Every query reads the whole ``customer`` and ``orders`` tables of ``sf_dir``,
turns them into employee and payroll lines (``sources.fixtures``) and runs the
library's operators over all of them. Column names equal those of
``salaria.oracle.ORACLE_SQL``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salaria import schema as S
from salaria.operators import ingest, quality, report
from salaria.plans.job import ReportSummary, run_payroll_report
from salaria.plans.scratch import session_scratch
from salaria.sources.fixtures import testdata_employee_lines, testdata_lines, testdata_payroll_lines
from salaria.sources.text import read_lines

Query = Callable[[SparkSession, str], DataFrame]


def _classified_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.clean_employees(testdata_employee_lines(spark, sf_dir))


def _classified_payroll(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.clean_payroll(testdata_payroll_lines(spark, sf_dir))


def _classified(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return _classified_employees(spark, sf_dir), _classified_payroll(spark, sf_dir)


def _valid(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return _valid_employees(spark, sf_dir), _valid_payroll(spark, sf_dir)


def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.tagged_keys(*_valid(spark, sf_dir))


def _valid_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.valid_employees(_classified_employees(spark, sf_dir))


def _valid_payroll(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.valid_payroll(_classified_payroll(spark, sf_dir), keep=(S.LINE_ID,))


def employee_lines(spark, sf_dir):
    """Employee text lines derived from ``customer`` (the fixture itself)."""
    return testdata_employee_lines(spark, sf_dir).select(S.LINE)


def payroll_lines(spark, sf_dir):
    """Payroll text lines derived from ``orders`` (the fixture itself)."""
    return testdata_payroll_lines(spark, sf_dir).select(S.LINE)


def employee_status(spark, sf_dir):
    """Every employee line with the first rule it fails (PRJ-1..5, FLT-1..3)."""
    return _classified_employees(spark, sf_dir).select(S.LINE, S.STATUS)


def payroll_status(spark, sf_dir):
    """Every payroll line with the first rule it fails (PRJ-1..5, FLT-1..5)."""
    return _classified_payroll(spark, sf_dir).select(S.LINE, S.STATUS)


def employee_status_counts(spark, sf_dir):
    """Employee lines per status."""
    return quality.status_counts(_classified_employees(spark, sf_dir))


def payroll_status_counts(spark, sf_dir):
    """Payroll lines per status."""
    return quality.status_counts(_classified_payroll(spark, sf_dir))


def employees_clean(spark, sf_dir):
    """Valid employee records, duplicates kept (FLT-6, PRJ-6)."""
    return _valid_employees(spark, sf_dir)


def payroll_clean(spark, sf_dir):
    """Valid payroll records with parsed ints (FLT-6, PRJ-4, PRJ-7)."""
    return _valid_payroll(spark, sf_dir).drop(S.LINE_ID)


def employees_one_per_key(spark, sf_dir):
    """One employee record per id (JOIN-2)."""
    return report.one_per_key(_valid_employees(spark, sf_dir))


def _total_pay(spark, sf_dir, overflow):
    pay = report.with_total_pay(_valid_payroll(spark, sf_dir), overflow)
    return pay.select(S.PAYROLL_ID, S.EMPLOYEE_ID, S.MONTH, S.TOTAL_PAY)


def payroll_total_pay(spark, sf_dir):
    """Total pay per valid payroll record, BIGINT (PRJ-9)."""
    return _total_pay(spark, sf_dir, S.OVERFLOW_WIDEN)


def payroll_total_pay_wrapped(spark, sf_dir):
    """Total pay wrapped to int32 as the reference computes it (PRJ-9)."""
    return _total_pay(spark, sf_dir, S.OVERFLOW_WRAP)


def max_pay_by_employee(spark, sf_dir):
    """Greatest total pay per employee (AGG-1)."""
    return report.max_pay_by_employee(report.with_total_pay(_valid_payroll(spark, sf_dir)))


def payroll_report(spark, sf_dir):
    """The report: payroll LEFT JOIN employee, total and max pay (JOIN-1, WIN-1, PRJ-8..11)."""
    emp, pay = _valid(spark, sf_dir)
    return report.payroll_report(emp, pay)


def payroll_report_salted(spark, sf_dir):
    """The report through the salted shuffle join (broadcast disabled, small tasks),
    so the skew path is checked against the same oracle as the broadcast path."""
    emp, pay = _valid(spark, sf_dir)
    return report.payroll_report(emp, pay, max_broadcast_bytes=0, rows_per_task=1000)


def payroll_report_ordered(spark, sf_dir):
    """The totally ordered report (range partition, broadcast join, local sort)."""
    emp, pay = _valid(spark, sf_dir)
    return report.payroll_report(emp, pay, ordered=True)


def job_counters(spark, sf_dir):
    """The job's counters: per-status counts folded into the key table, summed."""
    emp, pay = _classified(spark, sf_dir)
    table = report.key_info_with_counts(emp, pay)
    is_key = report.is_employee_key(F.col(S.EMPLOYEE_ID))
    return table.agg(*quality.counts_from_key_table_exprs(), *quality.key_census_exprs(where=is_key))


def payroll_report_wrapped(spark, sf_dir):
    """The report with int32-wrapped totals."""
    emp, pay = _valid(spark, sf_dir)
    return report.payroll_report(emp, pay, S.OVERFLOW_WRAP)


def report_lines(spark, sf_dir):
    """The text sink's lines of the report (SNK-1)."""
    return report.report_lines(payroll_report(spark, sf_dir))


def missing_employees(spark, sf_dir):
    """Payroll keys without a valid employee record (JOIN-3)."""
    return quality.missing_employees(_keys(spark, sf_dir))


def employees_without_payroll(spark, sf_dir):
    """Employee keys without valid payroll (JOIN-4)."""
    return quality.employees_without_payroll(_keys(spark, sf_dir))


def payroll_report_salted_ordered(spark, sf_dir):
    """The totally ordered report through the salted join, which runs once (JOIN-1, SORT-1)."""
    emp, pay = _valid(spark, sf_dir)
    return report.payroll_report(emp, pay, ordered=True, max_broadcast_bytes=0, rows_per_task=1000)


def _text_files(spark, sf_dir) -> tuple[str, str, str]:
    """The fixture as text files, some in subfolders: (employees, payroll, folder for an output)."""
    folder = session_scratch(spark, "text")
    employees, payroll = testdata_lines(spark, sf_dir)
    employees.write.text(f"{folder}/employees/2024/01")
    odd = F.pmod(F.col(S.LINE_ID), F.lit(2)) == 1
    payroll.filter(odd).select(S.LINE).write.text(f"{folder}/payroll")
    payroll.filter(~odd).select(S.LINE).write.text(f"{folder}/payroll/late/more")
    return f"{folder}/employees", f"{folder}/payroll", f"{folder}/report"


def employee_text_scan(spark, sf_dir):
    """Employee lines read from nested text files (SRC-1)."""
    return read_lines(spark, _text_files(spark, sf_dir)[0])


def payroll_text_scan(spark, sf_dir):
    """Payroll lines read from nested text files, with ids (SRC-2)."""
    return read_lines(spark, _text_files(spark, sf_dir)[1], with_line_id=True).select(S.LINE)


def payroll_gzip_scan(spark, sf_dir):
    """Payroll lines of one gzip file beside plain ones, dealt out over many tasks (SRC-2)."""
    folder = session_scratch(spark, "gzip")
    lines = testdata_payroll_lines(spark, sf_dir)
    third = F.pmod(F.col(S.LINE_ID), F.lit(3)) == 0
    lines.filter(third).select(S.LINE).write.text(f"{folder}/plain")
    lines.filter(~third).select(S.LINE).coalesce(1).write.option("compression", "gzip").text(f"{folder}/packed")
    return read_lines(spark, folder, deal_bytes=0)


def _job(spark, sf_dir, **options) -> tuple[ReportSummary, str]:
    employees, payroll, out = _text_files(spark, sf_dir)
    return run_payroll_report(spark, employees, payroll, out, **options), out


def job_report_lines(spark, sf_dir):
    """The text job's part files, read back (JOB-1, SNK-1, SNK-2)."""
    return spark.read.text(_job(spark, sf_dir)[1])


def job_report_lines_salted(spark, sf_dir):
    """The same through the salted join."""
    return spark.read.text(_job(spark, sf_dir, max_broadcast_bytes=0, rows_per_task=1000)[1])


def job_report_replaced(spark, sf_dir):
    """The part files of a run over the output of an earlier one on part of the payroll (SNK-2)."""
    employees, payroll, out = _text_files(spark, sf_dir)
    run_payroll_report(spark, employees, f"{payroll}/late", out, overflow=S.OVERFLOW_WRAP, ordered=False)
    run_payroll_report(spark, employees, payroll, out)
    return spark.read.text(out)


def job_rejected_lines(spark, sf_dir):
    """The text of rejected lines that the job wrote, by input and status (AGG-2, AGG-3)."""
    rejects = session_scratch(spark, "rejects")
    _job(spark, sf_dir, rejects_path=rejects)
    return spark.read.schema("value string, input string, status string").text(rejects)


def job_summary(spark, sf_dir):
    """The text job's counters, with the lines that it wrote (JOB-1, AGG-5)."""
    summary, _ = _job(spark, sf_dir)
    counts = {f"emp_{k}": v for k, v in summary.employee.items()} | {f"pay_{k}": v for k, v in summary.payroll.items()}
    counts |= summary.keys | {"lines_written": summary.records_emitted}
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{k} bigint" for k in counts))


def employee_quality(spark, sf_dir):
    """Employee line counters (AGG-2)."""
    return quality.employee_quality(_classified_employees(spark, sf_dir))


def payroll_quality(spark, sf_dir):
    """Payroll line counters (AGG-3)."""
    return quality.payroll_quality(_classified_payroll(spark, sf_dir))


def key_census(spark, sf_dir):
    """Keys processed, missing employee, no payroll (AGG-4, SET-1)."""
    return quality.key_census(_keys(spark, sf_dir))


def report_quality(spark, sf_dir):
    """Report rows next to valid payroll records (AGG-5)."""
    emp, pay = _valid(spark, sf_dir)
    return quality.report_quality(report.payroll_report(emp, pay), pay)


QUERIES: dict[str, Query] = {
    name: globals()[name]
    for name in (
        "employee_lines", "payroll_lines", "employee_status", "payroll_status",
        "employee_status_counts", "payroll_status_counts", "employees_clean", "payroll_clean",
        "employees_one_per_key", "payroll_total_pay", "payroll_total_pay_wrapped",
        "max_pay_by_employee", "payroll_report", "payroll_report_salted", "payroll_report_ordered",
        "payroll_report_wrapped", "job_counters",
        "report_lines", "missing_employees", "employees_without_payroll", "employee_quality",
        "payroll_quality", "key_census", "report_quality", "payroll_report_salted_ordered",
        "employee_text_scan", "payroll_text_scan", "job_report_lines", "job_report_lines_salted", "job_summary",
        "job_report_replaced", "payroll_gzip_scan", "job_rejected_lines",
    )
}
