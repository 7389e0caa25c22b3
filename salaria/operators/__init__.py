"""Relational operators of the payroll report: ingest, join/aggregate, quality."""

from salaria.operators.ingest import clean_employees, clean_payroll, valid_employees, valid_payroll
from salaria.operators.quality import (
    employee_quality,
    employees_without_payroll,
    key_census,
    missing_employees,
    payroll_quality,
    report_quality,
    status_counts,
)
from salaria.operators.report import (
    key_info,
    is_employee_key,
    key_info_with_counts,
    max_pay_by_employee,
    one_per_key,
    payroll_report,
    report_lines,
    tagged_keys,
    with_total_pay,
)

__all__ = [
    "clean_employees", "clean_payroll", "valid_employees", "valid_payroll",
    "employee_quality", "employees_without_payroll", "key_census", "missing_employees",
    "payroll_quality", "report_quality", "status_counts",
    "is_employee_key", "key_info", "key_info_with_counts", "max_pay_by_employee", "one_per_key", "payroll_report", "report_lines", "tagged_keys", "with_total_pay",
]
