"""Spark classification vs a brute-force model of the Java line rules.

The model is test-only and written from the rules: ``String.trim`` strips code
points <= U+0020, ``split(",", -1)`` keeps empty fields, ``Integer.parseInt``
takes an optional sign and BMP decimal digits within int32 range; the first
failing rule names the status.
"""

import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from salaria import schema as S
from salaria.operators import clean_employees, clean_payroll

from helpers import lines_df


def java_trim(s: str) -> str:
    i, j = 0, len(s)
    while i < j and ord(s[i]) <= 0x20:
        i += 1
    while j > i and ord(s[j - 1]) <= 0x20:
        j -= 1
    return s[i:j]


def parse_int(s: str):
    if not s:
        return None
    sign, body = 1, s
    if s[0] in "+-":
        sign, body = (-1 if s[0] == "-" else 1), s[1:]
    if not body:
        return None
    value = 0
    for ch in body:
        if ord(ch) > 0xFFFF or unicodedata.category(ch) != "Nd":
            return None
        value = value * 10 + unicodedata.digit(ch)
    value *= sign
    return value if -(2**31) <= value <= 2**31 - 1 else None


def model_payroll(line: str):
    t = java_trim(line)
    if t == "":
        return (S.BLANK,)
    f = t.split(",")
    if len(f) != 5:
        return (S.MALFORMED,)
    f = [java_trim(x) for x in f]
    if any(x == "" for x in f):
        return (S.INCOMPLETE,)
    a, b = parse_int(f[3]), parse_int(f[4])
    if a is None or b is None:
        return (S.INVALID_NUMERIC,)
    if a < 0 or b < 0:
        return (S.NEGATIVE,)
    return (S.OK, f[0], f[1], f[2], a, b)


def model_employee(line: str):
    t = java_trim(line)
    if t == "":
        return (S.BLANK,)
    f = t.split(",")
    if len(f) != 4:
        return (S.MALFORMED,)
    f = [java_trim(x) for x in f]
    if any(x == "" for x in f):
        return (S.INCOMPLETE,)
    return (S.OK, *f)


ALPHABET = st.sampled_from(
    list("0123456789+-,,,,  aZ.") + ["\t", "\x00", "\x1f", "\x7f", "\xa0", " ", "٣", "７", "\U0001d7ce", "e"]
)
LINE = st.text(alphabet=ALPHABET, max_size=24)
NUMBERISH = st.one_of(
    st.integers(min_value=-(2**31) - 3, max_value=2**31 + 3).map(str),
    st.text(alphabet=st.sampled_from(list("0123456789+-٣７ \t")), max_size=12),
)


@st.composite
def payroll_like(draw):
    fields = [draw(LINE), draw(LINE), draw(LINE), draw(NUMBERISH), draw(NUMBERISH)]
    return ",".join(fields) if draw(st.booleans()) else draw(LINE)


SETTINGS = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(payroll_like(), min_size=50, max_size=200))
def test_payroll_rules_match_model(spark, lines):
    rows = clean_payroll(lines_df(spark, lines, with_id=True)).orderBy(S.LINE_ID).collect()
    for line, r in zip(lines, rows):
        got = (r.status,) if r.status != S.OK else (
            r.status, r.payroll_id, r.employee_id, r.month, r.base_salary, r.bonus
        )
        assert got == model_payroll(line), repr(line)


@SETTINGS
@given(st.lists(LINE, min_size=50, max_size=200))
def test_employee_rules_match_model(spark, lines):
    rows = clean_employees(lines_df(spark, lines, with_id=True)).orderBy(S.LINE_ID).collect()
    for line, r in zip(lines, rows):
        got = (r.status,) if r.status != S.OK else (
            r.status, r.employee_id, r.first_name, r.last_name, r.department
        )
        assert got == model_employee(line), repr(line)


def model_report(emp_lines, pay_lines, wrap=False):
    best = {}
    for line in emp_lines:
        r = model_employee(line)
        if r[0] == S.OK:
            best[r[1]] = max(best.get(r[1], r[2:]), r[2:])
    rows = []
    for line in pay_lines:
        r = model_payroll(line)
        if r[0] == S.OK:
            total = r[4] + r[5]
            if wrap:
                total = (total + 2**31) % 2**32 - 2**31
            rows.append((r[2], r[3], total))
    top = {}
    for emp_id, _, total in rows:
        top[emp_id] = max(top.get(emp_id, total), total)
    out = []
    for emp_id, month, total in rows:
        e = best.get(emp_id)
        name, dept = (f"{e[0]} {e[1]}", e[2]) if e else ("UNKNOWN EMPLOYEE", "UNKNOWN")
        out.append((emp_id, name, dept, month, total, top[emp_id]))
    return sorted(out)


IDS = st.sampled_from(["E1", "E2", " E3", "E4\t", "e1", "E\xa05"])
WORD = st.text(alphabet=st.sampled_from(list("abZ \t\x01")), max_size=4)
INT = st.one_of(st.integers(min_value=0, max_value=2**31 - 1).map(str), st.sampled_from(["x", "-1", "+5", "007"]))


@st.composite
def emp_line(draw):
    return ",".join([draw(IDS), draw(WORD), draw(WORD), draw(WORD)])


@st.composite
def pay_line(draw):
    return ",".join([draw(WORD) + "p", draw(IDS), draw(WORD) + "m", draw(INT), draw(INT)])


@SETTINGS
@given(st.lists(emp_line(), max_size=15), st.lists(pay_line(), min_size=1, max_size=60), st.booleans())
def test_report_matches_model(spark, emp_lines, pay_lines, wrap):
    from salaria.operators import payroll_report, valid_employees, valid_payroll

    emp = valid_employees(clean_employees(lines_df(spark, emp_lines)))
    pay = valid_payroll(clean_payroll(lines_df(spark, pay_lines, with_id=True)), keep=(S.LINE_ID,))
    got = sorted(map(tuple, payroll_report(emp, pay, "wrap" if wrap else "widen").collect()))
    assert got == model_report(emp_lines, pay_lines, wrap)
