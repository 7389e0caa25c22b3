"""Lines of files that cannot be split, line numbers by file and offset, and rejected lines."""

import bz2
import gzip
import os
import random
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F
from test_job import EMPLOYEES, GOLDEN_TEXT, PAYROLL, _read_output, _write

from salaria import run_payroll_report
from salaria import schema as S
from salaria.operators import clean_payroll, status_counts
from salaria.plans.scratch import materialize
from salaria.sources import read_lines
from salaria.sources.text import number_lines

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _payroll(rng, lines, mark):
    """Valid, bad and blank lines; the month tells file and line apart."""
    out = []
    for i in range(lines):
        who = "EMP01" if i % 3 == 0 else f"EMP{rng.randint(2, 9):02d}"
        out.append(rng.choice((f"P{i},{who},{mark}{i},{i},1",) * 8 + (f"P{i},{who},,1,1", f"P{i},{who},{mark}{i},x,1", "", "P,1")))
    return out


def _files(folder, seed=0, lines=3000):
    """Files in two folders, two of them packed; their lines in order of file name."""
    rng = random.Random(seed)
    texts = {"a/part-2": "b", "a/part-1.gz": "a", "b/part 1": "c", "c.gz": "d", "d.bz2": "e"}
    out = {}
    for name, mark in texts.items():
        out[name] = _payroll(rng, rng.choice((lines, lines // 7)), mark)
        data = "".join(l + "\n" for l in out[name]).encode()
        _write(os.path.join(folder, name), gzip.compress(data) if name.endswith("gz") else bz2.compress(data) if name.endswith("bz2") else data)
    return [l for name in sorted(out) for l in out[name]]


def _counts(lines):
    return {r.status: r.lines for r in status_counts(clean_payroll(lines)).collect()}


def test_a_gzip_file_is_parsed_by_many_tasks(spark, tmp_dir):
    lines = _payroll(random.Random(1), 20_000, "m")
    data = "".join(l + "\n" for l in lines).encode()
    _write(os.path.join(tmp_dir, "gz", "pay.gz"), gzip.compress(data))
    _write(os.path.join(tmp_dir, "plain", "pay"), data)
    plain = _counts(read_lines(spark, f"{tmp_dir}/plain"))

    def tasks(df):
        return clean_payroll(df).select(F.spark_partition_id().alias("p")).distinct().count()

    dealt = read_lines(spark, f"{tmp_dir}/gz", with_line_id=True, deal_bytes=1)
    assert tasks(dealt) >= 8 and tasks(read_lines(spark, f"{tmp_dir}/gz")) == 1
    assert _counts(dealt) == plain and sum(plain.values()) == 20_000 and len(plain) == 5
    assert dealt.select(S.LINE_ID).distinct().count() == 20_000
    assert [r.line for r in dealt.orderBy(S.LINE_ID).collect()] == lines
    # By default a file is dealt out once its text is longer than a split.
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        assert tasks(read_lines(spark, f"{tmp_dir}/gz")) >= 8
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("collected", [50_000, 0])
def test_numbers_follow_file_names_and_offsets(spark, tmp_dir, collected):
    lines = _files(os.path.join(tmp_dir, "pay"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split in ("3000", "200000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            read = read_lines(spark, f"{tmp_dir}/pay", with_line_id=True, with_origin=True)
            read = materialize(read, f"{tmp_dir}/read-{split}-{collected}")
            assert read.select(S.LINE_ID).distinct().count() == len(lines)
            some = read.filter(F.col(S.LINE) != "")
            out = number_lines(some, read, lambda df, name: materialize(df, f"{tmp_dir}/{name}-{split}-{collected}"), max_collected=collected)
            assert out.columns == [S.LINE, S.LINE_ID]
            assert sorted((r.line_id, r.line) for r in out.collect()) == [(i, l) for i, l in enumerate(lines) if l]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


SCRIPT = textwrap.dedent("""
    import sys, tempfile
    sys.path.insert(0, {repo!r})
    from salaria import run_payroll_report
    from salaria.plans.session import local_session
    spark = local_session(cores=3, shuffle_partitions=3, extra={{"spark.sql.files.maxPartitionBytes": "9000"}})
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="salaria-cores-ckpt-"))
    run_payroll_report(spark, {emp!r}, {pay!r}, {out!r})
""")


def test_equal_bytes_for_other_splits_and_cores(spark, tmp_dir):
    emp, pay = os.path.join(tmp_dir, "emp.csv"), os.path.join(tmp_dir, "pay")
    _write(emp, EMPLOYEES)
    lines = _files(pay, seed=3)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    reports = []
    try:
        for k, (split, options) in enumerate((("2000", {}), ("500000", {}), ("7000", {"max_broadcast_bytes": 0, "rows_per_task": 50}),
                                              ("20000", {"stage_parsed_payroll": False}))):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            run_payroll_report(spark, emp, pay, os.path.join(tmp_dir, f"out{k}"), **options)
            reports.append(_read_output(os.path.join(tmp_dir, f"out{k}")))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    out = os.path.join(tmp_dir, "out-cores")
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=REPO, emp=emp, pay=pay, out=out)], capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    reports.append(_read_output(out))
    assert len(set(reports)) == 1
    # Within an employee the lines keep their order in the files, by file name and offset.
    good = [l.split(",") for l in lines if l.count(",") == 4 and ",," not in l and ",x," not in l]
    want = [(f[1], f[2]) for f in sorted(good, key=lambda f: f[1])]
    assert [(l.split("\t")[0], l.split(",")[-3]) for l in reports[0].splitlines()] == want and len(want) > 2000


def _reject_files(folder):
    found = {}
    for d, _, names in os.walk(folder):
        for n in names:
            if n.startswith("part-"):
                found.setdefault(os.path.relpath(d, folder), []).extend(open(os.path.join(d, n), encoding="utf-8").read().splitlines())
    return {k: sorted(v) for k, v in found.items()}


BAD_EMPLOYEES = EMPLOYEES + b"\nEMP05,Only,Three\nEMP06,,X,Y\n"
BAD_PAYROLL = PAYROLL + b"  \nPR7,EMP01\nPR8,EMP01,,1,1\nPR9,EMP02,Mar,-5,1\nPR9,EMP02,Mar,-5,1\n"
REJECTS = {
    "input=employee/status=BLANK": [""], "input=employee/status=MALFORMED": ["EMP05,Only,Three"], "input=employee/status=INCOMPLETE": ["EMP06,,X,Y"],
    "input=payroll/status=BLANK": ["  "], "input=payroll/status=MALFORMED": ["PR7,EMP01"], "input=payroll/status=INCOMPLETE": ["PR8,EMP01,,1,1"],
    "input=payroll/status=INVALID_NUMERIC": ["PR006,EMP02,Feb,INVALID,300"], "input=payroll/status=NEGATIVE": ["PR9,EMP02,Mar,-5,1"] * 2,
}


@pytest.mark.parametrize("options", [{}, {"ordered": False}, {"max_broadcast_bytes": 0, "rows_per_task": 1}])
def test_rejected_lines_are_kept(spark, tmp_dir, options):
    emp, pay, out, rejects = (os.path.join(tmp_dir, n) for n in ("emp.csv", "pay.csv", "out", "rejects"))
    _write(emp, BAD_EMPLOYEES)
    _write(pay, BAD_PAYROLL)
    _write(os.path.join(rejects, "status=old", "part-0"), b"stale\n")
    summary = run_payroll_report(spark, emp, pay, out, rejects_path=rejects, **options)
    assert sorted(_read_output(out).splitlines()) == sorted(GOLDEN_TEXT.splitlines())
    assert _reject_files(rejects) == REJECTS
    counters = [v for side in (summary.employee, summary.payroll) for k, v in side.items() if k not in ("lines_read", "records_emitted")]
    assert summary.records_rejected == sum(counters) == sum(map(len, REJECTS.values())) == 9
    # The files are inputs again: what was invalid still is, for the same reason.
    again = {r.status: r.lines for r in status_counts(clean_payroll(read_lines(spark, f"{rejects}/input=payroll"))).collect()}
    assert again == {"BLANK": 1, "MALFORMED": 1, "INCOMPLETE": 1, "INVALID_NUMERIC": 1, "NEGATIVE": 2}
    with pytest.raises(ValueError):
        run_payroll_report(spark, emp, pay, out, rejects_path=f"{out}/rejects")


def test_valid_rows_are_read_without_the_rejected(spark, tmp_dir):
    """The staging pass has two outputs, and later passes read the one of valid rows."""
    import glob

    from salaria.plans.scratch import checkpoint_root

    emp, pay = os.path.join(tmp_dir, "emp.csv"), os.path.join(tmp_dir, "pay.csv")
    _write(emp, BAD_EMPLOYEES)
    _write(pay, BAD_PAYROLL)
    root = os.path.join(checkpoint_root(spark).replace("file:", ""), "salaria")
    before = set(glob.glob(f"{root}/report-*"))
    run_payroll_report(spark, emp, pay, f"{tmp_dir}/out", rejects_path=f"{tmp_dir}/rejects", keep_scratch=True)
    (folder,) = set(glob.glob(f"{root}/report-*")) - before
    staged = spark.read.parquet(f"{folder}/payroll_parsed")
    assert sorted(os.path.basename(d) for d in glob.glob(f"{folder}/payroll_parsed/*=*")) == ["_rejected=0", "_rejected=1"]
    valid = staged.filter(F.col(S.REJECTED) == 0)
    assert valid.count() == 5 and valid.filter(f"{S.LINE} is not null").count() == 0 and staged.count() == 11
    assert all("_rejected=0" in f for f in valid.inputFiles()) or "PartitionFilters: [isnotnull(_rejected" in valid._jdf.queryExecution().toString()


def test_lost_rejects_leave_both_outputs_untouched(spark, tmp_dir, monkeypatch):
    from salaria.plans import job

    emp, pay, out, rejects = (os.path.join(tmp_dir, n) for n in ("emp.csv", "pay.csv", "out", "rejects"))
    _write(emp, BAD_EMPLOYEES)
    _write(pay, BAD_PAYROLL)
    run_payroll_report(spark, emp, pay, out, rejects_path=rejects)
    before = {f: os.path.getmtime(os.path.join(d, f)) for top in (out, rejects) for d, _, fs in os.walk(top) for f in fs}
    whole = job._rejects
    monkeypatch.setattr(job, "_rejects", lambda *a: whole(*a).filter("status <> 'NEGATIVE'"))
    with pytest.raises(RuntimeError, match="7 lines were written for 9 rejected"):
        run_payroll_report(spark, emp, pay, out, rejects_path=rejects)
    assert {f: os.path.getmtime(os.path.join(d, f)) for top in (out, rejects) for d, _, fs in os.walk(top) for f in fs} == before
    assert sorted(os.listdir(tmp_dir)) == ["emp.csv", "out", "pay.csv", "rejects"]


def test_command_line_with_rejects_and_resume(spark, tmp_dir, capsys):
    import json

    from salaria.__main__ import main

    emp, pay, out, rejects = (os.path.join(tmp_dir, n) for n in ("emp.csv", "pay.csv", "out", "rejects"))
    _write(emp, BAD_EMPLOYEES)
    _write(pay, BAD_PAYROLL)
    assert main([emp, pay, out, "--rejects", rejects, "--resume"]) == 0
    printed = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert printed["records_rejected"] == 9 and printed["resumed"] == []
    assert _read_output(out) == GOLDEN_TEXT and _reject_files(rejects) == REJECTS
