"""Benchmark: the end-to-end text job and headline queries at one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line. The headline is the text job (text files in, ordered text
report out) and the operators over the same text files; the registered queries,
which also build their lines from the tables, follow. Everything is warmed up twice
at the scale that is timed, and the median of three runs counts. Queries are forced
with a ``noop`` write (all rows computed, nothing collected).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salaria.catalog import QUERIES  # noqa: E402
from salaria.operators import (clean_employees, clean_payroll, employee_quality, payroll_quality, payroll_report,  # noqa: E402
                               valid_employees, valid_payroll)
from salaria.plans.job import run_payroll_report  # noqa: E402
from salaria.plans.scratch import scratch_scope  # noqa: E402
from salaria.plans.session import local_session  # noqa: E402
from salaria.sources.fixtures import testdata_lines  # noqa: E402
from salaria.sources.text import read_lines  # noqa: E402

HEADLINE = (
    "payroll_report",
    "payroll_report_salted",
    "payroll_report_salted_ordered",
    "report_lines",
    "payroll_quality",
    "employee_quality",
    "key_census",
    "max_pay_by_employee",
    "employees_one_per_key",
)
WARM_UPS, RUNS = 2, 3


def _force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _median_seconds(run) -> float:
    for _ in range(WARM_UPS):
        run()
    times = []
    for _ in range(RUNS):
        t0 = time.perf_counter()
        run()
        times.append(time.perf_counter() - t0)
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = local_session(cores=cpus, shuffle_partitions=max(cpus, 8), app="salaria-bench")

    scratch = tempfile.mkdtemp(prefix="salaria-bench-")
    emp_path, pay_path, out_path = (os.path.join(scratch, n) for n in ("employees", "payroll", "report"))
    emp_lines, pay_lines = testdata_lines(spark, sf_dir)
    emp_lines.write.mode("overwrite").text(emp_path)
    pay_lines.select("line").write.mode("overwrite").text(pay_path)
    payroll_rows = spark.read.text(pay_path).count()

    summary = None

    def job() -> None:
        nonlocal summary
        summary = run_payroll_report(spark, emp_path, pay_path, out_path)

    def text_report() -> None:
        with scratch_scope(spark, "bench") as folder:
            emp = valid_employees(clean_employees(read_lines(spark, emp_path)))
            pay = valid_payroll(clean_payroll(read_lines(spark, pay_path, with_line_id=True)), keep=("line_id",))
            _force(payroll_report(emp, pay, scratch=folder))

    timings = {
        "job_text_report": _median_seconds(job),
        "text_payroll_report": _median_seconds(text_report),
        "text_payroll_quality": _median_seconds(lambda: _force(payroll_quality(clean_payroll(read_lines(spark, pay_path))))),
        "text_employee_quality": _median_seconds(lambda: _force(employee_quality(clean_employees(read_lines(spark, emp_path))))),
    }
    for name in HEADLINE:
        timings[name] = _median_seconds(lambda: _force(QUERIES[name](spark, sf_dir)))

    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": sf,
        "payroll_lines": payroll_rows,
        "job_payroll_lines_per_sec": round(payroll_rows / timings["job_text_report"], 1),
        "job_join_strategy": summary.join_strategy,
        "cpus": cpus,
        "spark": spark.version,
        "registered_queries": len(QUERIES),
        "runs": f"median of {RUNS} after {WARM_UPS} warm-ups",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
