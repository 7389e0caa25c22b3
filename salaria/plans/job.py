"""The report job: two text inputs in, one ordered text report out.

Stages (``PLANS.md`` shows their physical plans):

1. scan + classify both inputs (narrow, codegen); the payroll's narrow parsed
   columns are staged as Parquet in the checkpoint folder, so the text is parsed
   once; where rejected lines are wanted, the same pass puts them, with their text, into a folder of
   their own;
2. ``key_info_with_counts``: partial/final aggregates per employee id (rejected
   lines under one marker key per status, so every line is counted) and their full outer join
   (one exchange per side), written to the checkpoint folder;
3. one small aggregate over the key table: counters, census and the size of the
   join's key side, which fix the join strategy and the partition counts;
4. payroll rows joined to the key table (size-checked broadcast, else salted
   shuffle join; ``plans.keyjoin``), totally ordered by employee id and the line's place in the
   input, by file name and offset (``sources.text.number_lines``): a unique composite key, so a hot employee
   or a mass of identical lines is split over many tasks, into part files in key
   order (the reference's single reducer gave one ordered file);
5. text sink into a sibling of the output folder. The lines are counted as they are
   written; if they are as many as the key table says, the folder takes the
   output's place (``sources.publish``), else the run fails and the old output stays.
   Refused when the output overlaps an input. The scratch folder is removed.

Parts and splits are sized by bytes (``plans.sizing``), and grow with the input.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from salaria import schema as S
from salaria.operators import ingest, quality, report
from salaria.plans import keyjoin, sizing
from salaria.plans.scratch import default_parallelism, materialize
from salaria.plans.staging import Staging, fingerprint
from salaria.sources.paths import check_paths, input_bytes
from salaria.sources.publish import publishing
from salaria.sources.text import number_lines, read_lines, write_lines

# Bytes of a narrow payroll row (key, month, total, line id) in a shuffle, and of a
# report line besides the employee's name and department.
ROW_BYTES = 48
LINE_BYTES = 40


@dataclass
class ReportSummary:
    """Counts of one run (the reference's job counters)."""

    employee: dict = field(default_factory=dict)
    payroll: dict = field(default_factory=dict)
    keys: dict = field(default_factory=dict)
    records_emitted: int = 0
    join_strategy: str = ""
    # Ours (no reference counter): employee ids with more than one valid record;
    # one of them is used (the greatest first name, last name, department).
    duplicate_employee_ids: int = 0
    # Lines written to the folder of rejects, if one was asked for, and tables taken from an earlier run.
    records_rejected: int | None = None
    resumed: list = field(default_factory=list)


@contextmanager
def _sized_session(spark: SparkSession, total: int) -> Iterator[None]:
    """Splits and shuffle parts for ``total`` bytes of input while the block runs."""
    conf = {
        "spark.sql.shuffle.partitions": str(sizing.partitions(total, default_parallelism(spark))),
        "spark.sql.files.maxPartitionBytes": str(sizing.split_bytes(
            total, int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()))),
        # Folders by status (at most this many) are written side by side, without a sort.
        "spark.sql.maxConcurrentOutputFileWriters": str(len(S.EMPLOYEE_STATUSES) + len(S.PAYROLL_STATUSES)),
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_payroll_report(
    spark: SparkSession,
    employee_path: str,
    payroll_path: str,
    output_path: str,
    *,
    overflow: str = S.OVERFLOW_WIDEN,
    ordered: bool = True,
    compression: str | None = None,
    max_broadcast_bytes: int = keyjoin.DEFAULT_MAX_BROADCAST_BYTES,
    rows_per_task: int | None = None,
    rows_per_output_file: int | None = None,
    stage_parsed_payroll: bool = True,
    keep_scratch: bool = False,
    rejects_path: str | None = None,
    resume: bool = False,
) -> ReportSummary:
    """Build the payroll report from two text inputs and write it as text lines.

    ``stage_parsed_payroll``: parse the payroll text once and keep the narrow
    parsed columns as Parquet in the checkpoint folder (roughly a quarter of the
    text's size); the key table, the range sampling and the final pass then read
    two to five columns of it instead of parsing the text three times. Off, the
    text is re-parsed by each pass and nothing but the key table is stored.
    Shuffle parts, the ordered report's part files and the salted join's buckets are
    sized by bytes (``plans.sizing``); ``rows_per_output_file`` and ``rows_per_task``
    (rows of a bucket) override the last two. The session's split size and shuffle
    partition count are set while the job runs and put back at its end.
    The run's scratch folder is deleted at the end unless ``keep_scratch``.

    ``rejects_path``: a folder, replaced as the report is, for the text of every rejected line, by
    ``input=`` and ``status=``; its files can be mended and read as inputs again. Both inputs are then staged, in one pass each.
    ``resume``: keep the staged tables if the run fails or its driver is lost, and begin with those that an
    earlier run over the same files with the same options finished (``plans.staging``). It needs a checkpoint folder
    that outlives the driver, and one run at a time.
    """
    check_paths(spark, employee_path, payroll_path, output_path, *([rejects_path] if rejects_path else []))
    total = input_bytes(spark, employee_path) + input_bytes(spark, payroll_path)
    if rows_per_task is None:
        rows_per_task = max(keyjoin.DEFAULT_ROWS_PER_TASK, sizing.part_bytes(total) // ROW_BYTES)
    manifest = None
    if resume:
        manifest = {"employees": fingerprint(spark, employee_path), "payroll": fingerprint(spark, payroll_path), "overflow": overflow,
                    "ordered": ordered, "rejects": rejects_path is not None, "staged": stage_parsed_payroll}
    staging = Staging(spark, "report", manifest)
    done = False
    try:
        with _sized_session(spark, total):
            summary = _run(spark, employee_path, payroll_path, output_path, staging, overflow=overflow, ordered=ordered,
                           compression=compression, max_broadcast_bytes=max_broadcast_bytes,
                           rows_per_task=rows_per_task, rows_per_output_file=rows_per_output_file,
                           stage_parsed_payroll=stage_parsed_payroll, rejects_path=rejects_path)
        done = True
        return summary
    finally:
        if not keep_scratch and (done or not resume):
            staging.drop()


def _narrow(classified: DataFrame, fields: tuple[str, ...], keep: tuple[str, ...], with_text: bool) -> DataFrame:
    """Status, the ``fields`` of valid lines, ``keep``, and the text of rejected lines if asked."""
    ok = F.col(S.STATUS) == S.OK
    out = [S.STATUS, *(F.when(ok, F.col(c)).alias(c) for c in fields), *keep]
    if with_text:
        out += [F.when(~ok, F.col(S.LINE)).alias(S.LINE), F.when(ok, 0).otherwise(1).alias(S.REJECTED)]
    return classified.select(*out)


def _rejects(name: str, classified: DataFrame) -> DataFrame:
    return classified.where(F.col(S.REJECTED) == 1).select(F.lit(name).alias("input"), S.STATUS, S.LINE)


def _run(spark, employee_path, payroll_path, output_path, staging, *, overflow, ordered, compression,
         max_broadcast_bytes, rows_per_task, rows_per_output_file, stage_parsed_payroll, rejects_path) -> ReportSummary:
    rejecting = rejects_path is not None
    by = (S.REJECTED,) if rejecting else ()
    origin = (S.FILE, S.START) if ordered else ()
    employees = ingest.clean_employees(read_lines(spark, employee_path))
    lines = read_lines(spark, payroll_path, with_line_id=True, with_origin=ordered)
    payroll = _narrow(ingest.clean_payroll(lines), (S.EMPLOYEE_ID, S.MONTH, S.BASE_SALARY, S.BONUS), (S.LINE_ID, *origin), rejecting)
    if rejecting:
        employees = staging(_narrow(employees, S.EMPLOYEE_FIELDS, (), True), "employees_parsed", by)
    if stage_parsed_payroll or rejecting:
        payroll = staging(payroll, "payroll_parsed", by)
        lines = payroll
    valid_pay = payroll.filter(F.col(S.STATUS) == S.OK)
    if rejecting:
        valid_pay = valid_pay.filter(F.col(S.REJECTED) == 0)  # reads the folder of valid rows only
    valid_pay = valid_pay.select(S.EMPLOYEE_ID, S.MONTH, S.BASE_SALARY, S.BONUS, S.LINE_ID, *origin)
    if ordered:
        # Not taken up by a resumed run: the scan's ids may differ where the payroll is not staged.
        valid_pay = number_lines(valid_pay, lines.select(S.LINE_ID, *origin), lambda df, name: materialize(df, f"{staging.folder}/{name}"))

    # Stage 2: the key table, with every line's status counted in it (exact under
    # task and stage retries, unlike accumulators), written to the checkpoint folder.
    table = staging(report.key_info_with_counts(employees, payroll, overflow), "key_info")
    is_key = report.is_employee_key(F.col(S.EMPLOYEE_ID))
    keys = table.filter(is_key)
    attrs = table.select(S.EMPLOYEE_ID, S.FULL_NAME, S.DEPARTMENT, S.MAX_PAY, S.N_PAYROLL)
    # Counters, census and the size of the join's key side: one small job over the table.
    stats = table.agg(
        *quality.counts_from_key_table_exprs(),
        *quality.key_census_exprs(where=is_key),
        F.count_if(is_key & (F.col("n_employee") > 1)).alias("duplicate_employee_ids"),
        *keyjoin.size_exprs(attrs, S.N_PAYROLL, where=is_key & F.col(S.N_PAYROLL).isNotNull(),
                            key=S.EMPLOYEE_ID, rows_per_task=rows_per_task),
    ).first().asDict()
    attrs_size = keyjoin.size_from_row(stats)
    cores = default_parallelism(spark)
    rows = attrs_size.total_rows
    if rows_per_output_file is None:
        line_bytes = LINE_BYTES + attrs_size.payload_bytes // max(1, attrs_size.keys)
        partitions = sizing.partitions(rows * line_bytes, cores)
    else:
        partitions = max(cores, math.ceil(rows / max(rows_per_output_file, 1)))
    # Exchange size of the salted join (only used when the key table is too big to
    # broadcast): about rows_per_task payroll rows per task.
    join_partitions = max(cores, math.ceil(rows / max(rows_per_task, 1)))

    rep = report.payroll_report(
        None, valid_pay, overflow, keys=keys, scratch=staging.folder, keep_line_id=True,
        ordered=ordered, order_partitions=partitions, join_partitions=join_partitions,
        max_broadcast_bytes=max_broadcast_bytes, rows_per_task=rows_per_task,
        key_size=attrs_size,
    )
    rejected = None
    with publishing(spark, output_path) as folder:
        emitted = _write_counted(report.report_lines(rep).select(S.REPORT_LINE), folder, compression)
        if emitted != rows:
            raise RuntimeError(f"{emitted} report lines were written for {rows} valid payroll records")
        if rejecting:
            refused = stats["emp_" + S.LINES_READ] - stats["emp_" + S.RECORDS_EMITTED] + stats["pay_" + S.LINES_READ] - stats["pay_" + S.RECORDS_EMITTED]
            with publishing(spark, rejects_path) as rejects_folder:
                both = _rejects("employee", employees).unionAll(_rejects("payroll", payroll))
                rejected = _write_counted(both, rejects_folder, compression, by=("input", S.STATUS))
                if rejected != refused:
                    raise RuntimeError(f"{rejected} lines were written for {refused} rejected ones")

    def counters(prefix: str) -> dict:
        return {k[len(prefix):]: v for k, v in stats.items() if k.startswith(prefix)}

    return ReportSummary(
        employee=counters("emp_"),
        payroll=counters("pay_"),
        keys={k: stats[k] for k in (S.KEYS_PROCESSED, S.MISSING_EMPLOYEE_RECORDS, S.NO_PAYROLL_RECORDS)},
        records_emitted=emitted,
        join_strategy=keyjoin.choose_strategy(attrs_size, max_broadcast_bytes),
        duplicate_employee_ids=stats["duplicate_employee_ids"],
        records_rejected=rejected,
        resumed=staging.resumed,
    )


def _write_counted(lines: DataFrame, folder: str, compression: str | None, by: tuple[str, ...] = ()) -> int:
    """Write text lines; their number is counted in the write's own tasks: each part counts once, however often its task was tried."""
    written = Observation("written")
    write_lines(lines.observe(written, F.count(F.lit(1)).alias("lines")), folder, compression=compression, by=by)
    return written.get["lines"]
