"""Plan shapes the design relies on at scale (regression guards)."""

import contextlib
import io

from pyspark.sql import functions as F

from salaria import schema as S
from salaria.operators import quality, valid_employees, valid_payroll
from salaria.operators import clean_employees, clean_payroll, is_employee_key, key_info_with_counts, payroll_report, tagged_keys
from salaria.plans.scratch import materialize

from helpers import lines_df

EMP = ["E1,A,B,D", "E2,C,D,E", "E1,Z,Z,Z", "bad"]
PAY = [f"P{i},E{i % 3},M1,{i},1" for i in range(60)] + ["x"]


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("simple")
    return buf.getvalue()


def _inputs(spark, tmp_dir):
    emp = clean_employees(lines_df(spark, EMP))
    pay = clean_payroll(lines_df(spark, PAY, with_id=True))
    table = materialize(key_info_with_counts(emp, pay), f"{tmp_dir}/keys")
    valid = pay.filter(F.col(S.STATUS) == S.OK).select(
        S.EMPLOYEE_ID, S.MONTH, S.BASE_SALARY, S.BONUS, S.LINE_ID
    )
    return emp, pay, table.filter(is_employee_key(F.col(S.EMPLOYEE_ID))), valid


def test_parse_is_one_narrow_stage(spark):
    plan = _plan(clean_payroll(lines_df(spark, PAY)).filter(F.col(S.STATUS) == S.OK))
    assert "Exchange" not in plan
    assert plan.count("Generate") == 3          # split, trim, ints: each once per row
    assert plan.count("split(") == 1


def test_key_table_one_exchange_per_side(spark):
    emp = clean_employees(lines_df(spark, EMP))
    pay = clean_payroll(lines_df(spark, PAY, with_id=True))
    plan = _plan(key_info_with_counts(emp, pay))
    assert plan.count("Exchange hashpartitioning") == 2
    assert "SortMergeJoin" in plan and "FullOuter" in plan
    assert "partial_max" in plan and "partial_count" in plan   # map-side pre-aggregation


def test_census_is_a_tagged_union_and_one_aggregate(spark):
    emp, pay = valid_employees(clean_employees(lines_df(spark, EMP))), valid_payroll(clean_payroll(lines_df(spark, PAY)))
    keys = tagged_keys(emp, pay)
    for df in (keys, quality.missing_employees(keys), quality.employees_without_payroll(keys), quality.key_census(keys)):
        plan = _plan(df)
        assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Union") == 1
        assert "Join" not in plan and "Sort" not in plan
    assert quality.key_census(keys).first().asDict() == {"keys_processed": 3, "missing_employee_records": 1, "no_payroll_records": 0}
    assert {(r.employee_id, r.has_employee, r.n_payroll) for r in keys.collect()} == {("E0", None, 20), ("E1", True, 20), ("E2", True, 20)}


def test_ordered_broadcast_path_shuffles_narrow_rows_only(spark, tmp_dir):
    _, _, keys, valid = _inputs(spark, tmp_dir)
    plan = _plan(payroll_report(None, valid, keys=keys, ordered=True, order_partitions=4))
    lines = plan.splitlines()
    bhj = next(i for i, l in enumerate(lines) if "BroadcastHashJoin" in l)
    rng = next(i for i, l in enumerate(lines) if "rangepartitioning" in l)
    assert rng > bhj                     # range exchange sits below the join
    assert plan.count("Exchange") == 2   # the range exchange and the broadcast exchange
    assert "full_name" not in lines[rng]


def test_salted_path_one_exchange_per_side(spark, tmp_dir):
    _, _, keys, valid = _inputs(spark, tmp_dir)
    plan = _plan(payroll_report(None, valid, keys=keys, max_broadcast_bytes=0, rows_per_task=5,
                                join_partitions=6))
    assert plan.count("Exchange hashpartitioning") == 2
    assert "SortMergeJoin" in plan and "_salt" in plan
    assert "Window" not in plan
