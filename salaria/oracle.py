"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the Spark code: the employee choice is a
``row_number`` window, the per-employee maximum a window ``max``, the census a
tagged union. Tables ``customer`` and ``orders`` are registered views.
DuckDB notes: lists are 1-based and out-of-range access is NULL; ``concat``
skips NULL, so ``||`` is used where NULL must propagate; ``try_cast('8000.5'
as integer)`` rounds, hence the regex guard; ``sum`` of integers is HUGEINT,
hence the casts.
"""

from __future__ import annotations

# Strip code points U+0000..U+0020 at both ends (Java String.trim).
_TRIM = r"regexp_replace({x}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"
_INT = r"case when regexp_full_match({x}, '[+-]?[0-9]+') then try_cast({x} as integer) end"


def _trim(x: str) -> str:
    return _TRIM.format(x=x)


def _int(x: str) -> str:
    return _INT.format(x=x)


EMPLOYEE_LINES = """
select unnest(case when c_custkey % 20 = 4 then [line, second] else [line] end) as line
from (
  select c_custkey,
         case c_custkey % 20
           when 0 then '   '
           when 1 then concat('EMP', e, ',OnlyFirst,HR')
           when 2 then concat('EMP', e, ',First,Last,  ')
           when 3 then concat(chr(9), 'EMP', e, ' , First ,Last', k, chr(9), ',', c_mktsegment, ' ')
           when 5 then concat('EMX', e, ',First,Last', k, ',', c_mktsegment)
           else concat('EMP', e, ',First,Last', k, ',', c_mktsegment) end as line,
         concat('EMP', e, ',Second,Last', k, ',ZDEPT') as second
  from (select c_custkey, c_mktsegment, cast(c_custkey as varchar) as k,
               lpad(cast(c_custkey as varchar), 6, '0') as e from customer) t
) u
"""

PAYROLL_LINES = """
select case o_orderkey % 50
         when 0 then ''
         when 1 then concat('PR', k, ',EMP', e, ',', m, ',', b)
         when 2 then concat('PR', k, ',EMP', e, ', ,', b, ',', x)
         when 3 then concat('PR', k, ',EMP', e, ',', m, ',INVALID,', x)
         when 4 then concat('PR', k, ',EMP', e, ',', m, ',-', b, ',', x)
         when 5 then concat('PR', k, ',EMP', e, ',', m, ',8000.5,', x)
         when 6 then concat('PR', k, ',EMP', e, ',', m, ',+,', x)
         when 7 then concat('PR', k, ',EMP', e, ',', m, ',2147483648,', x)
         when 8 then concat('PR', k, ',EMP', e, ',', m, ',INVALID,-1')
         when 9 then concat(chr(9), 'PR', k, ' , EMP', e, ' ,', m, chr(9), ', +00', b, ' , ', x, ' ')
         when 10 then concat('PR', k, ',EMP', e, ',', m, ',2147483647,', x)
         else concat('PR', k, ',EMP', e, ',', m, ',', b, ',', x) end as line
from (select o_orderkey, cast(o_orderkey as varchar) as k,
             lpad(cast(case when o_orderkey % 3 = 0 then 7 else o_custkey end as varchar), 6, '0') as e,
             concat('M', cast(month(o_orderdate) as varchar)) as m,
             cast(cast(floor(o_totalprice) as bigint) as varchar) as b,
             cast(o_orderkey % 1000 as varchar) as x
      from orders) t
"""

_EMP_FIELDS = ("employee_id", "first_name", "last_name", "department")
_PAY_FIELDS = ("payroll_id", "employee_id", "month", "sal_raw", "bon_raw")

_CTES = f"""
with emp_lines as ({EMPLOYEE_LINES}),
pay_lines as ({PAYROLL_LINES}),
emp_t as (select line, {_trim('line')} as t from emp_lines),
emp_s as (select line, t, string_split(t, ',') as f from emp_t),
emp_p as (select line, t, len(f) as nf,
  {', '.join(f"{_trim(f'f[{i + 1}]')} as {n}" for i, n in enumerate(_EMP_FIELDS))}
  from emp_s),
emp_c as (select line, employee_id, first_name, last_name, department,
  case when t = '' then 'BLANK'
       when nf <> 4 then 'MALFORMED'
       when employee_id = '' or first_name = '' or last_name = '' or department = '' then 'INCOMPLETE'
       else 'OK' end as status
  from emp_p),
emp_ok as (select employee_id, first_name, last_name, department from emp_c where status = 'OK'),
emp_one as (select employee_id, first_name, last_name, department from (
  select *, row_number() over (partition by employee_id
                               order by first_name desc, last_name desc, department desc) as rn
  from emp_ok) z where rn = 1),
pay_t as (select line, {_trim('line')} as t from pay_lines),
pay_s as (select line, t, string_split(t, ',') as f from pay_t),
pay_p as (select line, t, len(f) as nf,
  {', '.join(f"{_trim(f'f[{i + 1}]')} as {n}" for i, n in enumerate(_PAY_FIELDS))}
  from pay_s),
pay_n as (select *, {_int('sal_raw')} as base_salary, {_int('bon_raw')} as bonus from pay_p),
pay_c as (select line, payroll_id, employee_id, month, base_salary, bonus,
  case when t = '' then 'BLANK'
       when nf <> 5 then 'MALFORMED'
       when payroll_id = '' or employee_id = '' or month = '' or sal_raw = '' or bon_raw = '' then 'INCOMPLETE'
       when base_salary is null or bonus is null then 'INVALID_NUMERIC'
       when base_salary < 0 or bonus < 0 then 'NEGATIVE'
       else 'OK' end as status
  from pay_n),
pay_ok as (select payroll_id, employee_id, month, base_salary, bonus from pay_c where status = 'OK'),
pay_tot as (select payroll_id, employee_id, month, cast(base_salary as bigint) + bonus as total_pay from pay_ok),
pay_wrap as (select payroll_id, employee_id, month,
  case when total_pay > 2147483647 then total_pay - 4294967296 else total_pay end as total_pay from pay_tot),
rep as (select p.employee_id,
  coalesce(e.first_name || ' ' || e.last_name, 'UNKNOWN EMPLOYEE') as full_name,
  coalesce(e.department, 'UNKNOWN') as department, p.month, p.total_pay,
  max(p.total_pay) over (partition by p.employee_id) as max_pay
  from pay_tot p left join emp_one e on p.employee_id = e.employee_id),
rep_wrap as (select p.employee_id,
  coalesce(e.first_name || ' ' || e.last_name, 'UNKNOWN EMPLOYEE') as full_name,
  coalesce(e.department, 'UNKNOWN') as department, p.month, p.total_pay,
  max(p.total_pay) over (partition by p.employee_id) as max_pay
  from pay_wrap p left join emp_one e on p.employee_id = e.employee_id),
keys as (select employee_id, max(from_emp) as from_emp, max(from_pay) as from_pay from (
  select employee_id, 1 as from_emp, 0 as from_pay from emp_ok
  union all select employee_id, 0, 1 from pay_ok) u group by employee_id)
"""


def _q(select: str) -> str:
    return _CTES + select


_COUNT = "cast(count(*) as bigint)"


def _count_status(status: str) -> str:
    return f"cast(count(*) filter (where status = '{status}') as bigint)"


ORACLE_SQL: dict[str, str] = {
    "employee_lines": _q("select line from emp_lines"),
    "payroll_lines": _q("select line from pay_lines"),
    "employee_status": _q("select line, status from emp_c"),
    "payroll_status": _q("select line, status from pay_c"),
    "employee_status_counts": _q(f"select status, {_COUNT} as lines from emp_c group by status"),
    "payroll_status_counts": _q(f"select status, {_COUNT} as lines from pay_c group by status"),
    "employees_clean": _q("select employee_id, first_name, last_name, department from emp_ok"),
    "payroll_clean": _q("select payroll_id, employee_id, month, base_salary, bonus from pay_ok"),
    "employees_one_per_key": _q("select employee_id, first_name, last_name, department from emp_one"),
    "payroll_total_pay": _q("select payroll_id, employee_id, month, total_pay from pay_tot"),
    "payroll_total_pay_wrapped": _q("select payroll_id, employee_id, month, total_pay from pay_wrap"),
    "max_pay_by_employee": _q("select employee_id, max(total_pay) as max_pay from pay_tot group by employee_id"),
    "payroll_report": _q("select employee_id, full_name, department, month, total_pay, max_pay from rep"),
    "payroll_report_salted": _q("select employee_id, full_name, department, month, total_pay, max_pay from rep"),
    "payroll_report_ordered": _q("select employee_id, full_name, department, month, total_pay, max_pay from rep"),
    "job_counters": _q(
        "select e.*, p.*, k.* from "
        f"(select {_COUNT} as emp_lines_read, {_count_status('OK')} as emp_records_emitted, "
        f"{_count_status('BLANK')} as emp_blank_lines_skipped, "
        f"{_count_status('MALFORMED')} as emp_malformed_records_skipped, "
        f"{_count_status('INCOMPLETE')} as emp_incomplete_records_skipped from emp_c) e, "
        f"(select {_COUNT} as pay_lines_read, {_count_status('OK')} as pay_records_emitted, "
        f"{_count_status('BLANK')} as pay_blank_lines_skipped, "
        f"{_count_status('MALFORMED')} as pay_malformed_records_skipped, "
        f"{_count_status('INCOMPLETE')} as pay_incomplete_records_skipped, "
        f"{_count_status('INVALID_NUMERIC')} as pay_invalid_numeric_fields_skipped, "
        f"{_count_status('NEGATIVE')} as pay_negative_value_records_skipped from pay_c) p, "
        f"(select {_COUNT} as keys_processed, "
        "cast(count(*) filter (where from_emp = 0) as bigint) as missing_employee_records, "
        "cast(count(*) filter (where from_pay = 0) as bigint) as no_payroll_records from keys) k"
    ),
    "payroll_report_wrapped": _q(
        "select employee_id, full_name, department, month, total_pay, max_pay from rep_wrap"
    ),
    "report_lines": _q(
        "select employee_id || chr(9) || full_name || ',' || department || ',' || month || ',' "
        "|| cast(total_pay as varchar) || ',' || cast(max_pay as varchar) as value from rep"
    ),
    "missing_employees": _q("select employee_id from keys where from_emp = 0"),
    "employees_without_payroll": _q("select employee_id from keys where from_pay = 0"),
    "employee_quality": _q(
        f"select {_COUNT} as lines_read, {_count_status('OK')} as records_emitted, "
        f"{_count_status('BLANK')} as blank_lines_skipped, "
        f"{_count_status('MALFORMED')} as malformed_records_skipped, "
        f"{_count_status('INCOMPLETE')} as incomplete_records_skipped from emp_c"
    ),
    "payroll_quality": _q(
        f"select {_COUNT} as lines_read, {_count_status('OK')} as records_emitted, "
        f"{_count_status('BLANK')} as blank_lines_skipped, "
        f"{_count_status('MALFORMED')} as malformed_records_skipped, "
        f"{_count_status('INCOMPLETE')} as incomplete_records_skipped, "
        f"{_count_status('INVALID_NUMERIC')} as invalid_numeric_fields_skipped, "
        f"{_count_status('NEGATIVE')} as negative_value_records_skipped from pay_c"
    ),
    "key_census": _q(
        f"select {_COUNT} as keys_processed, "
        "cast(count(*) filter (where from_emp = 0) as bigint) as missing_employee_records, "
        "cast(count(*) filter (where from_pay = 0) as bigint) as no_payroll_records from keys"
    ),
    "report_quality": _q(
        "select (select cast(count(*) as bigint) from rep) as records_emitted, "
        "(select cast(count(*) as bigint) from pay_ok) as valid_payroll_records"
    ),
}
# Other ways to the same rows: through text files and the text job, or by another join.
ORACLE_SQL |= {
    "employee_text_scan": ORACLE_SQL["employee_lines"],
    "payroll_text_scan": ORACLE_SQL["payroll_lines"],
    "payroll_gzip_scan": ORACLE_SQL["payroll_lines"],
    "job_rejected_lines": _q("select line as value, 'employee' as input, status from emp_c where status <> 'OK' "
                             "union all select line, 'payroll', status from pay_c where status <> 'OK'"),
    "job_report_lines": ORACLE_SQL["report_lines"],
    "job_report_lines_salted": ORACLE_SQL["report_lines"],
    "job_report_replaced": ORACLE_SQL["report_lines"],
    "payroll_report_salted_ordered": ORACLE_SQL["payroll_report"],
    "job_summary": ORACLE_SQL["job_counters"].replace(
        "select e.*, p.*, k.* from", f"select e.*, p.*, k.*, (select {_COUNT} from rep) as lines_written from"),
}
