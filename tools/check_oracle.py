"""Run every registered query in Spark and its DuckDB oracle; compare row multisets.

Usage: python tools/check_oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import collections
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salaria.catalog import QUERIES  # noqa: E402
from salaria.oracle import ORACLE_SQL  # noqa: E402
from salaria.plans.session import local_session  # noqa: E402

TABLES = ("customer", "orders")
SPARK_TO_DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "boolean": "BOOLEAN"}


def duck(sf_dir: str):
    import duckdb  # of the test extra: tests are collected without it

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    cols = df.columns
    rel = con.sql(ORACLE_SQL[name])
    ocols = rel.columns
    orows = rel.fetchall()
    if sorted(cols) != sorted(ocols):
        return False, f"columns {cols} vs {ocols}"
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    duck_types = {c: str(t) for c, t in zip(ocols, rel.types)}
    if spark_types != duck_types:
        return False, f"types {spark_types} vs {duck_types}"
    idx = [ocols.index(c) for c in cols]
    orows = [tuple(r[i] for i in idx) for r in orows]
    a, b = collections.Counter(rows), collections.Counter(orows)
    if a != b:
        diff = list((a - b).items())[:3], list((b - a).items())[:3]
        return False, f"rows {len(rows)} vs {len(orows)}; spark-only/oracle-only {diff}"
    return True, f"{len(rows)} rows"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session()
    con = duck(sf_dir)
    bad = 0
    for name in names:
        t = time.time()
        ok, msg = compare(spark, con, name, sf_dir)
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {name:28s} {time.time() - t:6.2f}s {msg}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
