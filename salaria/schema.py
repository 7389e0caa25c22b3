"""Column names, line statuses and placeholder values of the payroll report.

Inputs are positional, comma-separated text lines without quoting or header:

* employee line: ``employee_id,first_name,last_name,department``
* payroll line:  ``payroll_id,employee_id,month,base_salary,bonus``
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference job's values for identical
# output and counts; do not edit them.
# ---------------------------------------------------------------------------
FIELD_DELIMITER = ","
OUTPUT_KEY_SEPARATOR = "\t"
UNKNOWN_EMPLOYEE = "UNKNOWN EMPLOYEE"
UNKNOWN_DEPARTMENT = "UNKNOWN"
EMPLOYEE_FIELD_COUNT = 4
PAYROLL_FIELD_COUNT = 5
MIN_NUMERIC_VALUE = 0
# Counter names of the reference job, lower-cased as our column names:
# per input (employee lines; payroll lines add the last two) ...
LINES_READ = "lines_read"
RECORDS_EMITTED = "records_emitted"
BLANK_LINES_SKIPPED = "blank_lines_skipped"
MALFORMED_RECORDS_SKIPPED = "malformed_records_skipped"
INCOMPLETE_RECORDS_SKIPPED = "incomplete_records_skipped"
INVALID_NUMERIC_FIELDS_SKIPPED = "invalid_numeric_fields_skipped"
NEGATIVE_VALUE_RECORDS_SKIPPED = "negative_value_records_skipped"
# ... and per join key.
KEYS_PROCESSED = "keys_processed"
MISSING_EMPLOYEE_RECORDS = "missing_employee_records"
NO_PAYROLL_RECORDS = "no_payroll_records"
# ---------------------------------------------------------------------------

# Our column names (positional order of the input lines).
EMPLOYEE_ID = "employee_id"
FIRST_NAME = "first_name"
LAST_NAME = "last_name"
DEPARTMENT = "department"
EMPLOYEE_FIELDS = (EMPLOYEE_ID, FIRST_NAME, LAST_NAME, DEPARTMENT)

PAYROLL_ID = "payroll_id"
MONTH = "month"
BASE_SALARY = "base_salary"
BONUS = "bonus"
PAYROLL_FIELDS = (PAYROLL_ID, EMPLOYEE_ID, MONTH, BASE_SALARY, BONUS)

LINE = "line"          # raw text of an input line
LINE_ID = "line_id"    # unique, scan-assigned row id: salt and sort tie-break
FILE = "_file"         # file of a line, and the start of its split in the file
START = "_start"
REJECTED = "_rejected"  # 1 for lines that fail a rule, else 0
STATUS = "status"      # first rule a line fails, or OK

FULL_NAME = "full_name"
TOTAL_PAY = "total_pay"
MAX_PAY = "max_pay"
N_PAYROLL = "n_payroll"
HAS_EMPLOYEE = "has_employee"
REPORT_COLUMNS = (EMPLOYEE_ID, FULL_NAME, DEPARTMENT, MONTH, TOTAL_PAY, MAX_PAY)
REPORT_LINE = "value"

# Line statuses, in the order the rules are applied (first failure wins).
BLANK = "BLANK"
MALFORMED = "MALFORMED"
INCOMPLETE = "INCOMPLETE"
INVALID_NUMERIC = "INVALID_NUMERIC"
NEGATIVE = "NEGATIVE"
OK = "OK"
EMPLOYEE_STATUSES = (BLANK, MALFORMED, INCOMPLETE, OK)
PAYROLL_STATUSES = (BLANK, MALFORMED, INCOMPLETE, INVALID_NUMERIC, NEGATIVE, OK)

OVERFLOW_WIDEN = "widen"   # total pay as BIGINT, the true sum
OVERFLOW_WRAP = "wrap"     # total pay wrapped to 32-bit two's complement
