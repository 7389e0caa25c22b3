"""Inputs and outputs: text line scans and sinks, and test-data derived lines."""

from salaria.sources.fixtures import employee_lines, payroll_lines, testdata_lines
from salaria.sources.text import read_lines, write_lines

__all__ = ["employee_lines", "payroll_lines", "read_lines", "testdata_lines", "write_lines"]
