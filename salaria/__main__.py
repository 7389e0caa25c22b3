"""Command line: ``python -m salaria EMPLOYEES PAYROLL OUTPUT [options]``.

Runs the report job on the active (or a new) Spark session, as with
``spark-submit``, and prints the counters as one JSON object. Exit status 0 on
success; an error raises (non-zero exit).
"""

from __future__ import annotations

import argparse
import dataclasses
import json
import sys

from pyspark import SparkConf
from pyspark.sql import SparkSession

from salaria import schema as S
from salaria.plans import keyjoin
from salaria.plans.job import run_payroll_report


# Spark builds no broadcast table above 8 GB.
_MAX_BROADCAST_MB = 8 << 10


def _broadcast_mb(text: str) -> int:
    value = int(text)
    if not 0 <= value < _MAX_BROADCAST_MB:
        raise argparse.ArgumentTypeError(f"must be from 0 to {_MAX_BROADCAST_MB - 1}")
    return value


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="salaria", description="Employee payroll report on Spark.")
    parser.add_argument("employees", help="employee directory: text file or folder of text files")
    parser.add_argument("payroll", help="payroll transactions: text file or folder of text files")
    parser.add_argument("output", help="output folder (replaced; must not overlap an input)")
    parser.add_argument("--overflow", choices=(S.OVERFLOW_WIDEN, S.OVERFLOW_WRAP), default=S.OVERFLOW_WIDEN,
                        help="total pay as BIGINT (widen) or wrapped to 32 bits (wrap)")
    parser.add_argument("--unordered", action="store_true", help="skip the global order by employee id")
    parser.add_argument("--compression", default=None, help="text codec of the output, e.g. gzip or bzip2")
    parser.add_argument("--max-broadcast-mb", type=_broadcast_mb, default=keyjoin.DEFAULT_MAX_BROADCAST_BYTES >> 20,
                        help="largest estimated key table to broadcast; above it a salted shuffle join is used")
    parser.add_argument("--rows-per-output-file", type=int, default=None,
                        help="report rows per part file of the ordered output (default: sized by bytes)")
    parser.add_argument("--rows-per-task", type=int, default=None,
                        help="payroll rows per task before a key is split over salt buckets (default: sized by bytes)")
    parser.add_argument("--rejects", default=None, metavar="FOLDER", help="write the text of rejected lines to this folder (replaced), by input and status")
    parser.add_argument("--resume", action="store_true",
                        help="keep staged tables if the run fails, and begin with those that an earlier run over the same files finished")
    parser.add_argument("--keep-scratch", action="store_true", help="keep the staged tables in the checkpoint folder")
    args = parser.parse_args(argv)

    builder = SparkSession.builder.appName("salaria-payroll-report")
    if SparkConf().get("spark.ui.enabled", None) is None:
        # No web UI unless the submitter asks for one (--conf spark.ui.enabled=true).
        builder = builder.config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    summary = run_payroll_report(
        spark, args.employees, args.payroll, args.output,
        overflow=args.overflow, ordered=not args.unordered, compression=args.compression,
        max_broadcast_bytes=args.max_broadcast_mb << 20, rows_per_output_file=args.rows_per_output_file,
        rows_per_task=args.rows_per_task, keep_scratch=args.keep_scratch,
        rejects_path=args.rejects, resume=args.resume,
    )
    print(json.dumps(dataclasses.asdict(summary), sort_keys=True))
    return 0


if __name__ == "__main__":
    sys.exit(main())
