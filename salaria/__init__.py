"""salaria: a batch engine for pay reports, built on Spark DataFrames.

Reads an employee directory and payroll transactions as text lines, classifies
every line by the first rule it fails, joins valid payroll to one record per
employee (keeping payroll of unknown employees), computes total pay per record
and the maximum per employee, and writes an ordered report with quality counts.
"""

from salaria.operators import (
    clean_employees,
    clean_payroll,
    employee_quality,
    key_census,
    payroll_quality,
    payroll_report,
    report_lines,
    valid_employees,
    valid_payroll,
)
from salaria.plans.job import run_payroll_report

__all__ = [
    "clean_employees", "clean_payroll", "employee_quality", "key_census", "payroll_quality",
    "payroll_report", "report_lines", "run_payroll_report", "valid_employees", "valid_payroll",
]
