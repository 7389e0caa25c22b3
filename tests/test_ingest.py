import pytest

from salaria import schema as S
from salaria.operators import clean_employees, clean_payroll, employee_quality, payroll_quality

from helpers import lines_df


def _emp(spark, lines):
    return [r.asDict() for r in clean_employees(lines_df(spark, lines)).collect()]


def _pay(spark, lines):
    return [r.asDict() for r in clean_payroll(lines_df(spark, lines)).collect()]


@pytest.mark.parametrize(
    "line, status",
    [
        ("EMP01,Nour,Hassan,Engineering", S.OK),
        ("", S.BLANK),
        ("  \t ", S.BLANK),
        (",,,", S.INCOMPLETE),
        ("A,B,C,D,", S.MALFORMED),
        ("A,B,C", S.MALFORMED),
        ("E1,A,B,  ", S.INCOMPLETE),
        ('"E,x",L,D', S.OK),
        ("employee_id,first_name,last_name,department", S.OK),  # no header logic
        ("E1, ,B,C", S.INCOMPLETE),  # NBSP-free blank field
        ("E1,\xa0,B,C", S.OK),      # U+00A0 is not trimmed
    ],
)
def test_employee_status(spark, line, status):
    assert _emp(spark, [line])[0][S.STATUS] == status


def test_employee_fields_trimmed(spark):
    row = _emp(spark, ["\tEMP9 , First ,Last9\t,SEG "])[0]
    assert (row[S.EMPLOYEE_ID], row[S.FIRST_NAME], row[S.LAST_NAME], row[S.DEPARTMENT]) == (
        "EMP9", "First", "Last9", "SEG"
    )
    assert row[S.STATUS] == S.OK


@pytest.mark.parametrize(
    "line, status",
    [
        ("PR001,EMP01,Jan,8000,500", S.OK),
        ("", S.BLANK),
        ("PR1,E1,Jan,1", S.MALFORMED),
        ("PR1,E1,Jan,1,2,3", S.MALFORMED),
        ("PR1,E1, ,1,2", S.INCOMPLETE),
        ("PR1,E1,Jan,1,", S.INCOMPLETE),
        ("PR006,EMP02,Feb,INVALID,300", S.INVALID_NUMERIC),
        ("PR1,E1,Jan,INVALID,-1", S.INVALID_NUMERIC),   # parse precedes the sign rule
        ("PR1,E1,Jan,-1,INVALID", S.INVALID_NUMERIC),
        ("PR1,E1,Jan,-5,3", S.NEGATIVE),
        ("PR1,E1,Jan,5,-3", S.NEGATIVE),
        ("PR1,E1,Jan,-0,0", S.OK),
        ("PR1,E1,Jan,8000.5,1", S.INVALID_NUMERIC),
        ("PR1,E1,Jan,2147483648,1", S.INVALID_NUMERIC),
        ("PR1,E1,Jan,+,1", S.INVALID_NUMERIC),
        ("payroll_id,employee_id,month,base_salary,bonus", S.INVALID_NUMERIC),
        ("\tPR9 , EMP1 ,M1\t, +00123 , 9 ", S.OK),
    ],
)
def test_payroll_status(spark, line, status):
    assert _pay(spark, [line])[0][S.STATUS] == status


def test_payroll_numbers_canonical(spark):
    row = _pay(spark, ["\tPR9 , EMP1 ,M1\t, +00123 , 9 "])[0]
    assert (row[S.PAYROLL_ID], row[S.EMPLOYEE_ID], row[S.MONTH], row[S.BASE_SALARY], row[S.BONUS]) == (
        "PR9", "EMP1", "M1", 123, 9
    )


def test_every_line_kept_and_counted_once(spark):
    lines = ["", "a", "a,b,c,d,e", "p,e,m,1,2", "p,e,m,x,2", "p,e,m,-1,2", "p,e,,1,2"]
    classified = clean_payroll(lines_df(spark, lines))
    q = payroll_quality(classified).first().asDict()
    assert q == {
        # "a" has one field; "a,b,c,d,e" has five, with text where the numbers go.
        "lines_read": 7, "records_emitted": 1, "blank_lines_skipped": 1, "malformed_records_skipped": 1,
        "incomplete_records_skipped": 1, "invalid_numeric_fields_skipped": 2, "negative_value_records_skipped": 1,
    }
    e = employee_quality(clean_employees(lines_df(spark, ["", "a,b,c,d", "a,b,c", "a,,c,d"]))).first().asDict()
    assert e == {"lines_read": 4, "records_emitted": 1, "blank_lines_skipped": 1,
                 "malformed_records_skipped": 1, "incomplete_records_skipped": 1}


def test_extra_input_columns_pass_through(spark):
    out = clean_payroll(lines_df(spark, ["p,e,m,1,2"], with_id=True))
    assert out.columns == [S.LINE, S.LINE_ID, *S.PAYROLL_FIELDS, S.STATUS]


@pytest.mark.parametrize(
    "line, status",
    [
        ("p,e,m,1,2," + "," * 5000, S.MALFORMED),
        ("p,e,m,1,2,", S.MALFORMED),
        ("p,e,m,1,", S.INCOMPLETE),
        (",,,,", S.INCOMPLETE),
        (",,,,,", S.MALFORMED),
    ],
)
def test_field_count_with_bounded_split(spark, line, status):
    assert _pay(spark, [line])[0][S.STATUS] == status


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_null_lines_are_blank(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        lines = spark.createDataFrame([(None,), ("",), ("E1,A,B,C",)], "line string")
        assert [r.status for r in clean_employees(lines).collect()] == ["BLANK", "BLANK", "OK"]
        assert [r.status for r in clean_payroll(lines).collect()] == ["BLANK", "BLANK", "MALFORMED"]
        assert [r.line for r in clean_payroll(lines).collect()] == [None, "", "E1,A,B,C"]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
