"""Largest task of the report: key-partitioned window vs aggregate + join back.

Usage: python tools/skew_window_vs_join.py [sf_dir]
The fixture books a third of all payroll rows on one employee. The window needs
all rows of a key in one task; the library's plan does not.
"""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F, Window
from salaria.plans.session import local_session
from salaria.catalog import _valid
from salaria.operators import report
from salaria import schema as S
spark = local_session(extra={"spark.sql.adaptive.coalescePartitions.enabled": "false"})
emp, pay = _valid(spark, sys.argv[1] if len(sys.argv) > 1 else '/root/testdata/sf0.1')
pay = report.with_total_pay(pay)
win = pay.join(report.one_per_key(emp), S.EMPLOYEE_ID, "left").withColumn(
    S.MAX_PAY, F.max(S.TOTAL_PAY).over(Window.partitionBy(S.EMPLOYEE_ID)))
def task_rows(df):
    c = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("count"), F.max(S.MAX_PAY)).collect()
    return max(r["count"] for r in c), sum(r["count"] for r in c), len(c)
print("window   (largest task rows, total, tasks):", task_rows(win))
ours = report.payroll_report(emp, pay.drop(S.TOTAL_PAY), ordered=True, order_partitions=8)
print("agg+join ordered (largest task rows, total, tasks):", task_rows(ours))
