"""Invariants over random lines (property-based)."""

import string

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salaria import schema as S
from salaria.operators import (
    clean_employees, clean_payroll, key_census, key_info, one_per_key, payroll_quality, payroll_report,
    valid_employees, valid_payroll, with_total_pay,
)

from helpers import lines_df

IDS = st.sampled_from(["E1", "E2", "E3", " E1", "E4\t", "", "e1"])
WORD = st.text(alphabet=string.ascii_letters + " \t\x01\xa0", max_size=6)
NUM = st.one_of(
    st.integers(min_value=-5, max_value=2**31 + 5).map(str),
    st.sampled_from(["", "+", "x", "1.5", " 7 ", "+007", "-0", "2147483647"]),
)


@st.composite
def payroll_line(draw):
    fields = [draw(WORD), draw(IDS), draw(WORD), draw(NUM), draw(NUM)]
    n = draw(st.sampled_from([5, 5, 5, 4, 6]))
    fields = (fields + ["9"])[:n]
    return ",".join(fields)


@st.composite
def employee_line(draw):
    fields = [draw(IDS), draw(WORD), draw(WORD), draw(WORD)]
    n = draw(st.sampled_from([4, 4, 4, 3, 5]))
    return ",".join((fields + ["z"])[:n])


SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(employee_line(), max_size=12), st.lists(payroll_line(), max_size=25))
def test_report_invariants(spark, emp_lines, pay_lines):
    emp_c = clean_employees(lines_df(spark, emp_lines))
    pay_c = clean_payroll(lines_df(spark, pay_lines, with_id=True))
    emp, pay = valid_employees(emp_c), valid_payroll(pay_c, keep=(S.LINE_ID,))

    # every line lands in exactly one status
    q = payroll_quality(pay_c).first().asDict()
    assert q["lines_read"] == len(pay_lines)
    assert sum(v for k, v in q.items() if k != "lines_read") == len(pay_lines)

    rep = payroll_report(emp, pay)
    rows = rep.collect()
    # one report row per valid payroll record; the max is the key's max and attained
    assert len(rows) == q["records_emitted"]
    by_key = {}
    for r in rows:
        by_key.setdefault(r.employee_id, []).append(r)
    for rs in by_key.values():
        assert len({r.max_pay for r in rs}) == 1
        assert rs[0].max_pay == max(r.total_pay for r in rs)

    # census partitions the keys
    keys = key_info(one_per_key(emp), with_total_pay(pay))
    c = key_census(keys).first()
    n_emp_keys = emp.select(S.EMPLOYEE_ID).distinct().count()
    n_pay_keys = pay.select(S.EMPLOYEE_ID).distinct().count()
    matched = c.keys_processed - c.missing_employee_records - c.no_payroll_records
    assert matched + c.no_payroll_records == n_emp_keys
    assert matched + c.missing_employee_records == n_pay_keys

    # salted path gives the same multiset
    salted = payroll_report(emp, pay, max_broadcast_bytes=0, rows_per_task=2)
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, rows))


@SETTINGS
@given(st.lists(employee_line(), min_size=1, max_size=8), st.lists(payroll_line(), min_size=1, max_size=15),
       st.randoms())
def test_line_order_and_employee_duplicates_do_not_matter(spark, emp_lines, pay_lines, rnd):
    def report(e, p):
        emp = valid_employees(clean_employees(lines_df(spark, e)))
        pay = valid_payroll(clean_payroll(lines_df(spark, p, with_id=True)), keep=(S.LINE_ID,))
        return sorted(map(tuple, payroll_report(emp, pay).collect()))

    shuffled_e, shuffled_p = emp_lines[:], pay_lines[:]
    rnd.shuffle(shuffled_e)
    rnd.shuffle(shuffled_p)
    base = report(emp_lines, pay_lines)
    assert report(shuffled_e, shuffled_p) == base
    assert report(emp_lines + emp_lines, pay_lines) == base


def test_classification_without_ansi(spark):
    """The rules give the same statuses with ANSI mode off (no exceptions either way)."""
    lines = ["p,e,m,1,2", "p,e,m", "p,e,m,2147483648,1", "p,e,m,x,-1", "", "p,e,m,-1,1"]
    expected = [S.OK, S.MALFORMED, S.INVALID_NUMERIC, S.INVALID_NUMERIC, S.BLANK, S.NEGATIVE]
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            got = [r.status for r in clean_payroll(lines_df(spark, lines, with_id=True)).orderBy(S.LINE_ID)
                   .select(S.STATUS).collect()]
            assert got == expected, ansi
            total = with_total_pay(valid_payroll(clean_payroll(lines_df(spark, ["p,e,m,2147483647,2147483647"]))))
            assert total.select(F.col(S.TOTAL_PAY)).first()[0] == 4294967294
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
