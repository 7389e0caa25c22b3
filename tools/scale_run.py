"""Throughput of the text job on k-times replicated test tables.

Usage: python tools/scale_run.py [sf_dir] [k] [cpus]

Each replica of ``customer`` and ``orders`` gets its own key range, so employees
and payroll grow together; one order in three still books on the single hot
employee, which therefore holds a third of all payroll rows at any k. The
derived lines are written as text once, then the job runs on the broadcast path
and on the salted shuffle path.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from salaria.plans.job import run_payroll_report  # noqa: E402
from salaria.plans.session import local_session  # noqa: E402
from salaria.sources.fixtures import employee_lines, payroll_lines  # noqa: E402


def replicated(spark, sf_dir: str, k: int):
    cust = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_mktsegment")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"
    )
    c_stride = cust.agg(F.max("c_custkey")).first()[0] + 1
    o_stride = orders.agg(F.max("o_orderkey")).first()[0] + 1
    rep = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("rep")
    cust = cust.select("*", rep).select(
        (F.col("c_custkey") + F.col("rep") * c_stride).alias("c_custkey"), "c_mktsegment"
    )
    orders = orders.select("*", rep).select(
        (F.col("o_orderkey") + F.col("rep") * o_stride).alias("o_orderkey"),
        (F.col("o_custkey") + F.col("rep") * c_stride).alias("o_custkey"),
        "o_totalprice",
        "o_orderdate",
    )
    return employee_lines(cust), payroll_lines(orders)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    k = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    cpus = int(sys.argv[3]) if len(sys.argv) > 3 else 8
    spark = local_session(cores=cpus, shuffle_partitions=4 * cpus, app="salaria-scale")
    scratch = tempfile.mkdtemp(prefix="salaria-scale-")
    emp_path, pay_path = os.path.join(scratch, "employees"), os.path.join(scratch, "payroll")
    emp, pay = replicated(spark, sf_dir, k)
    emp.write.text(emp_path)
    pay.select("line").write.text(pay_path)
    n_pay = spark.read.text(pay_path).count()
    n_emp = spark.read.text(emp_path).count()
    result = {"sf_dir": sf_dir, "k": k, "payroll_lines": n_pay, "employee_lines": n_emp, "cpus": cpus}
    # Warm-up (JIT, codegen cache) on one replica of the smallest tables; not measured.
    w_emp, w_pay = replicated(spark, os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001"), 1)
    w_emp.write.text(os.path.join(scratch, "warm_emp"))
    w_pay.select("line").write.text(os.path.join(scratch, "warm_pay"))
    for kw in ({}, {"max_broadcast_bytes": 0}):
        run_payroll_report(spark, os.path.join(scratch, "warm_emp"), os.path.join(scratch, "warm_pay"),
                           os.path.join(scratch, f"warm_out{len(kw)}"), **kw)
    for label, kw in (("broadcast", {}), ("salted", {"max_broadcast_bytes": 0})):
        t0 = time.perf_counter()
        summary = run_payroll_report(spark, emp_path, pay_path, os.path.join(scratch, f"out-{label}"), **kw)
        dt = time.perf_counter() - t0
        result[label] = {
            "seconds": round(dt, 2),
            "lines_per_sec": round((n_pay + n_emp) / dt),
            "strategy": summary.join_strategy,
            "records_emitted": summary.records_emitted,
        }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
