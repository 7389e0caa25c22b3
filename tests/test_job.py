import glob
import os

import pytest

from salaria import run_payroll_report
from salaria.sources.paths import check_paths

EMPLOYEES = b"EMP01,Nour,Hassan,Engineering\nEMP02,Ali,Mahmoud,HR\nEMP03,Sara,Khaled,Finance\n"
PAYROLL = (
    b"PR001,EMP01,Jan,8000,500\nPR002,EMP01,Feb,8200,500\nPR003,EMP02,Jan,7000,300\n"
    b"PR004,EMP03,Jan,9000,700\nPR005,EMP04,Jan,7500,400\nPR006,EMP02,Feb,INVALID,300\n"
)
GOLDEN_TEXT = (
    "EMP01\tNour Hassan,Engineering,Jan,8500,8700\n"
    "EMP01\tNour Hassan,Engineering,Feb,8700,8700\n"
    "EMP02\tAli Mahmoud,HR,Jan,7300,7300\n"
    "EMP03\tSara Khaled,Finance,Jan,9700,9700\n"
    "EMP04\tUNKNOWN EMPLOYEE,UNKNOWN,Jan,7900,7900\n"
)


def _write(path, data: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def _read_output(out):
    parts = sorted(glob.glob(os.path.join(out, "part-*")))
    return "".join(open(p, encoding="utf-8").read() for p in parts)


def test_sample_end_to_end_byte_exact_and_ordered(spark, tmp_dir):
    emp, pay, out = (os.path.join(tmp_dir, n) for n in ("emp.csv", "pay.csv", "out"))
    _write(emp, EMPLOYEES)
    _write(pay, PAYROLL)
    summary = run_payroll_report(spark, emp, pay, out)
    assert _read_output(out) == GOLDEN_TEXT
    assert summary.employee == {"lines_read": 3, "records_emitted": 3, "blank_lines_skipped": 0,
                                "malformed_records_skipped": 0, "incomplete_records_skipped": 0}
    assert summary.payroll["lines_read"] == 6
    assert summary.payroll["records_emitted"] == 5
    assert summary.payroll["invalid_numeric_fields_skipped"] == 1
    assert summary.keys == {"keys_processed": 4, "missing_employee_records": 1, "no_payroll_records": 0}
    assert summary.records_emitted == 5
    assert summary.join_strategy == "broadcast"


def test_salted_job_gives_same_bytes(spark, tmp_dir):
    emp, pay, out = (os.path.join(tmp_dir, n) for n in ("emp.csv", "pay.csv", "out"))
    _write(emp, EMPLOYEES)
    _write(pay, PAYROLL)
    summary = run_payroll_report(spark, emp, pay, out, max_broadcast_bytes=0, rows_per_task=1)
    assert summary.join_strategy == "salted-shuffle"
    assert _read_output(out) == GOLDEN_TEXT


def test_line_endings_bom_blank_and_invalid_utf8(spark, tmp_dir):
    emp_dir = os.path.join(tmp_dir, "emp")
    # BOM, CRLF, lone CR, blank and whitespace-only lines, invalid byte, no final newline,
    # spread over two part files of one input folder.
    _write(os.path.join(emp_dir, "part-0"), b"\xef\xbb\xbfEMP01,Nour,Hassan,Engineering\r\n\r\n   \rEMP02,Al\xff,M,HR")
    _write(os.path.join(emp_dir, "part-1"), b"EMP03,Sara,Khaled,Finance\n\t\n")
    pay = os.path.join(tmp_dir, "pay.csv")
    _write(pay, b"PR1,EMP01,Jan,1,2\r\nPR2,EMP02,Jan,3,4\rPR3,EMP03,Jan,5,6")
    out = os.path.join(tmp_dir, "out")
    summary = run_payroll_report(spark, emp_dir, pay, out)
    assert summary.employee["lines_read"] == 6
    assert summary.employee["blank_lines_skipped"] == 3
    assert summary.employee["records_emitted"] == 3
    assert summary.payroll["records_emitted"] == 3
    assert summary.keys["missing_employee_records"] == 0
    assert _read_output(out) == (
        "EMP01\tNour Hassan,Engineering,Jan,3,3\n"
        "EMP02\tAl� M,HR,Jan,7,7\n"
        "EMP03\tSara Khaled,Finance,Jan,11,11\n"
    )


def test_existing_output_is_replaced(spark, tmp_dir):
    emp, pay, out = (os.path.join(tmp_dir, n) for n in ("emp.csv", "pay.csv", "out"))
    _write(emp, EMPLOYEES)
    _write(pay, PAYROLL)
    _write(os.path.join(out, "part-99999-old.txt"), b"stale\n")
    run_payroll_report(spark, emp, pay, out)
    assert _read_output(out) == GOLDEN_TEXT
    assert not os.path.exists(os.path.join(out, "part-99999-old.txt"))


@pytest.mark.parametrize("target", ["same", "parent", "inside"])
def test_overlapping_output_refused_and_input_intact(spark, tmp_dir, target):
    emp_dir = os.path.join(tmp_dir, "in", "emp")
    emp = os.path.join(emp_dir, "emp.csv")
    pay = os.path.join(tmp_dir, "in2", "pay.csv")
    _write(emp, EMPLOYEES)
    _write(pay, PAYROLL)
    out = {"same": emp_dir, "parent": os.path.join(tmp_dir, "in"), "inside": os.path.join(emp_dir, "out")}[target]
    with pytest.raises(ValueError):
        run_payroll_report(spark, emp_dir, pay, out)
    assert open(emp, "rb").read() == EMPLOYEES


def _folders(tmp_dir, *names):
    for n in names:
        _write(os.path.join(tmp_dir, n, "part-0"), PAYROLL)
    return [os.path.join(tmp_dir, n) for n in names]


def test_check_paths_rules(spark, tmp_dir):
    emp, pay = _folders(tmp_dir, "emp", "pay")
    check_paths(spark, emp, pay, os.path.join(tmp_dir, "out"))
    check_paths(spark, emp, pay, os.path.join(tmp_dir, "pay2"))
    for bad in ((emp, emp, os.path.join(tmp_dir, "out")), (emp, pay, f"{pay}/../pay"), (emp, "file:" + pay, tmp_dir), (emp, pay, "/")):
        with pytest.raises(ValueError):
            check_paths(spark, *bad)
    with pytest.raises(FileNotFoundError):
        check_paths(spark, os.path.join(tmp_dir, "none"), pay, os.path.join(tmp_dir, "out"))


def test_wildcard_input_over_output_is_refused(spark, tmp_dir):
    emp, pay1, pay2 = _folders(tmp_dir, "emp", "pay1", "pay2")
    for out in (pay1, os.path.join(pay2, "x"), tmp_dir):
        with pytest.raises(ValueError):
            run_payroll_report(spark, emp, os.path.join(tmp_dir, "pay*"), out)
    assert open(os.path.join(pay1, "part-0"), "rb").read() == PAYROLL
    s = run_payroll_report(spark, emp, os.path.join(tmp_dir, "pay*"), os.path.join(tmp_dir, "out"))
    assert s.payroll["lines_read"] == 12


def test_relative_paths_are_taken_as_spark_takes_them(spark, tmp_dir):
    emp, pay = _folders(tmp_dir, "emp", "pay")
    jvm = spark.sparkContext._jvm
    here = jvm.org.apache.hadoop.fs.FileSystem.get(spark.sparkContext._jsc.hadoopConfiguration()).getWorkingDirectory().toUri().getPath()
    relative = os.path.relpath(pay, here)
    with pytest.raises(ValueError):
        check_paths(spark, emp, relative, pay)
    with pytest.raises(ValueError):
        check_paths(spark, emp, pay, relative + "/x")


def test_link_and_mount_of_one_folder(spark, tmp_dir):
    """A remote name, a mount point and a local link that lead to one folder."""
    emp, pay = _folders(tmp_dir, "emp", "d/pay")
    os.symlink(os.path.join(tmp_dir, "d"), os.path.join(tmp_dir, "lnk"))
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.paths.link./mnt", "file://" + os.path.join(tmp_dir, "d"))
    conf.set("fs.viewfs.mounttable.paths.link." + os.path.join(tmp_dir, "lnk"), "file://" + os.path.join(tmp_dir, "d"))
    for inp, out in ((f"viewfs://paths/mnt/pay", pay), (pay, "viewfs://paths/mnt/pay/sub"), (f"viewfs://paths{tmp_dir}/lnk/pay", f"{tmp_dir}/lnk/pay"),
                     (pay, f"{tmp_dir}/lnk/pay/x/y")):
        with pytest.raises(ValueError):
            run_payroll_report(spark, emp, inp, out)
        assert open(os.path.join(pay, "part-0"), "rb").read() == PAYROLL


def test_nested_input_folders_are_read_whole(spark, tmp_dir):
    emp, pay = os.path.join(tmp_dir, "emp.csv"), os.path.join(tmp_dir, "pay")
    _write(emp, EMPLOYEES)
    lines = PAYROLL.splitlines(keepends=True)
    _write(os.path.join(pay, "part-0"), lines[0])
    _write(os.path.join(pay, "2024", "01", "part-0"), b"".join(lines[1:]))
    s = run_payroll_report(spark, emp, pay, os.path.join(tmp_dir, "out"))
    assert s.payroll["lines_read"] == 6 and s.records_emitted == 5
    assert sorted(_read_output(os.path.join(tmp_dir, "out")).splitlines()) == sorted(GOLDEN_TEXT.splitlines())


def test_a_row_lost_before_the_write_fails_the_run(spark, tmp_dir, monkeypatch):
    from salaria.operators import report

    emp, pay = os.path.join(tmp_dir, "emp.csv"), os.path.join(tmp_dir, "pay.csv")
    _write(emp, EMPLOYEES)
    _write(pay, PAYROLL)
    whole = report.report_lines
    monkeypatch.setattr(report, "report_lines", lambda r: whole(r).filter("value not like 'EMP04%'"))
    with pytest.raises(RuntimeError, match="4 report lines were written for 5"):
        run_payroll_report(spark, emp, pay, os.path.join(tmp_dir, "out"))


def test_job_sizes_its_shuffles_and_restores_the_session(spark, tmp_dir, monkeypatch):
    from salaria.plans import job, sizing

    emp, pay = os.path.join(tmp_dir, "emp.csv"), os.path.join(tmp_dir, "pay.csv")
    _write(emp, EMPLOYEES)
    _write(pay, PAYROLL)
    seen = {}
    real = job.report.key_info_with_counts

    def spy(*args):
        seen["parts"] = int(spark.conf.get("spark.sql.shuffle.partitions"))
        table = real(*args)
        import contextlib
        import io

        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            table.explain("simple")
        seen["plan"] = buf.getvalue()
        return table

    monkeypatch.setattr(job.report, "key_info_with_counts", spy)
    monkeypatch.setattr(sizing, "MIN_BYTES", 16)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        run_payroll_report(spark, emp, pay, os.path.join(tmp_dir, "out"))
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = sizing.partitions(len(EMPLOYEES) + len(PAYROLL), spark.sparkContext.defaultParallelism)
    assert seen["parts"] == want != 200
    assert f"hashpartitioning(employee_id" in seen["plan"] and f", {want})" in seen["plan"] and ", 200)" not in seen["plan"]


def test_sizes_at_100_tb():
    from salaria.plans import sizing

    total = 100 * 10**12
    parts, splits = sizing.partitions(total, 8000), -(-total // sizing.split_bytes(total))
    assert parts == 25_000 and 10**9 <= sizing.part_bytes(total) <= 4 << 30
    assert splits <= 100_000 and parts * splits <= 2.5e9
    assert sizing.partitions(10**9, 8) == 8 and sizing.part_bytes(10**9) == 128 << 20


def test_job_on_testdata_matches_registered_queries(spark, tmp_dir):
    """Text round trip of the derived fixture: counters and report equal the query results."""
    from salaria.catalog import QUERIES
    from salaria.sources.fixtures import testdata_lines

    sf_dir = "/root/testdata/sf0.001"
    emp_lines, pay_lines = testdata_lines(spark, sf_dir)
    emp, pay, out = (os.path.join(tmp_dir, n) for n in ("emp", "pay", "out"))
    emp_lines.write.text(emp)
    pay_lines.select("line").write.text(pay)
    summary = run_payroll_report(spark, emp, pay, out, max_broadcast_bytes=0, rows_per_task=50)
    assert summary.join_strategy == "salted-shuffle"
    assert summary.employee == QUERIES["employee_quality"](spark, sf_dir).first().asDict()
    assert summary.payroll == QUERIES["payroll_quality"](spark, sf_dir).first().asDict()
    assert summary.keys == QUERIES["key_census"](spark, sf_dir).first().asDict()
    text = _read_output(out).splitlines()
    expected = sorted(r.value for r in QUERIES["report_lines"](spark, sf_dir).collect())
    assert sorted(text) == expected
    ids = [t.split("\t")[0] for t in text]
    assert ids == sorted(ids)
    assert summary.records_emitted == len(text)
    assert summary.duplicate_employee_ids == 8  # FIXTURES.md: ids with duplicates at sf0.001


def test_scratch_folder_is_removed(spark, tmp_dir):
    from salaria.plans.scratch import checkpoint_root

    emp, pay, out = (os.path.join(tmp_dir, n) for n in ("emp.csv", "pay.csv", "out"))
    _write(emp, EMPLOYEES)
    _write(pay, PAYROLL)
    root = checkpoint_root(spark).replace("file:", "")
    before = set(glob.glob(os.path.join(root, "salaria", "report-*")))
    run_payroll_report(spark, emp, pay, out)
    assert set(glob.glob(os.path.join(root, "salaria", "report-*"))) == before
    run_payroll_report(spark, emp, pay, out, keep_scratch=True)
    kept = set(glob.glob(os.path.join(root, "salaria", "report-*"))) - before
    assert len(kept) == 1
    assert os.path.isdir(os.path.join(kept.pop(), "payroll_parsed"))


def test_command_line(spark, tmp_dir, capsys):
    import json

    from salaria.__main__ import main

    emp, pay, out = (os.path.join(tmp_dir, n) for n in ("emp.csv", "pay.csv", "out"))
    _write(emp, EMPLOYEES)
    _write(pay, PAYROLL)
    assert main([emp, pay, out]) == 0
    printed = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert printed["records_emitted"] == 5
    assert printed["join_strategy"] == "broadcast"
    assert _read_output(out) == GOLDEN_TEXT
    assert main([emp, pay, out, "--max-broadcast-mb", "0", "--rows-per-task", "1"]) == 0
    printed = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert printed["join_strategy"] == "salted-shuffle"
    assert _read_output(out) == GOLDEN_TEXT


def test_checkpoint_root_required_on_a_cluster(monkeypatch):
    from salaria.plans import scratch

    class Ctx:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext = Ctx()
        conf = Conf()

    with pytest.raises(RuntimeError):
        scratch.checkpoint_root(Session())

    class ConfSet(Conf):
        def get(self, key, default=None):
            return "hdfs://nn/ckpt/" if key == "spark.checkpoint.dir" else default

    Session.conf = ConfSet()
    assert scratch.checkpoint_root(Session()) == "hdfs://nn/ckpt"

    class Local(Conf):
        def get(self, key, default=None):
            return "file:///tmp/own" if key == "spark.checkpoint.dir" else default

    Session.conf = Local()
    with pytest.raises(RuntimeError, match="do not share"):
        scratch.checkpoint_root(Session())


def test_no_temporary_folder_without_a_context():
    from salaria.plans import scratch

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

        @property
        def sparkContext(self):
            raise RuntimeError("none here")

    with pytest.raises(RuntimeError):
        scratch.checkpoint_root(Session())


def test_shared_folder_is_proven_by_the_executors(spark, tmp_dir):
    from salaria.plans.scratch import seen_by_executors

    assert seen_by_executors(spark, f"file://{tmp_dir}")
    assert os.listdir(os.path.join(tmp_dir, "salaria")) in ([], [".crc"]) or not any(
        f.startswith("probe") for f in os.listdir(os.path.join(tmp_dir, "salaria")))


def test_report_scratch_is_deleted_with_its_scope(spark):
    from helpers import lines_df
    from salaria.operators import clean_employees, clean_payroll, payroll_report, valid_employees, valid_payroll
    from salaria.plans.scratch import checkpoint_root, drop_session_scratch, scratch_scope

    emp = valid_employees(clean_employees(lines_df(spark, EMPLOYEES.decode().splitlines())))
    pay = valid_payroll(clean_payroll(lines_df(spark, PAYROLL.decode().splitlines())))
    root = os.path.join(checkpoint_root(spark).replace("file:", ""), "salaria")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    with scratch_scope(spark, "scope") as folder:
        for ordered in (False, True):
            assert payroll_report(emp, pay, scratch=folder, ordered=ordered, max_broadcast_bytes=0, rows_per_task=1).count() == 5
    assert set(os.listdir(root)) == before
    payroll_report(emp, pay).count()
    assert len(set(os.listdir(root)) - before) == 1
    drop_session_scratch()
    assert not set(os.listdir(root)) - before


def test_empty_inputs(spark, tmp_dir):
    emp, pay, empty = (os.path.join(tmp_dir, n) for n in ("emp.csv", "pay.csv", "empty.csv"))
    _write(emp, EMPLOYEES)
    _write(pay, PAYROLL)
    _write(empty, b"")
    s = run_payroll_report(spark, emp, empty, os.path.join(tmp_dir, "out1"))
    assert _read_output(os.path.join(tmp_dir, "out1")) == ""
    assert s.records_emitted == 0 and s.payroll["lines_read"] == 0
    assert s.keys == {"keys_processed": 3, "missing_employee_records": 0, "no_payroll_records": 3}
    s = run_payroll_report(spark, empty, pay, os.path.join(tmp_dir, "out2"))
    assert s.records_emitted == 5 and s.employee["lines_read"] == 0
    text = _read_output(os.path.join(tmp_dir, "out2"))
    assert text.count("UNKNOWN EMPLOYEE,UNKNOWN") == 5


@pytest.mark.parametrize(
    "options",
    [
        {"stage_parsed_payroll": False},
        {"ordered": False},
        {"compression": "gzip"},
        {"stage_parsed_payroll": False, "max_broadcast_bytes": 0, "rows_per_task": 1},
    ],
)
def test_job_options_give_the_same_report(spark, tmp_dir, options):
    emp, pay, out = (os.path.join(tmp_dir, n) for n in ("emp.csv", "pay.csv", "out"))
    _write(emp, EMPLOYEES)
    _write(pay, PAYROLL)
    run_payroll_report(spark, emp, pay, out, **options)
    text = "".join(r.value + "\n" for r in spark.read.text(out).collect())
    if options.get("ordered", True) and "compression" not in options:
        assert _read_output(out) == GOLDEN_TEXT
    assert sorted(text.splitlines()) == sorted(GOLDEN_TEXT.splitlines())


def test_job_wrap_overflow(spark, tmp_dir):
    emp, pay, out = (os.path.join(tmp_dir, n) for n in ("emp.csv", "pay.csv", "out"))
    _write(emp, EMPLOYEES)
    _write(pay, b"P1,EMP01,Jan,2147483647,1\nP2,EMP01,Feb,5,5\n")
    run_payroll_report(spark, emp, pay, out, overflow="wrap")
    assert _read_output(out) == (
        "EMP01\tNour Hassan,Engineering,Jan,-2147483648,10\n"
        "EMP01\tNour Hassan,Engineering,Feb,10,10\n"
    )


def test_identical_copies_of_one_key_are_split_over_part_files(spark, tmp_dir):
    emp, pay, out = (os.path.join(tmp_dir, n) for n in ("emp.csv", "pay.csv", "out"))
    _write(emp, EMPLOYEES)
    copies = b"PR9,EMP01,Jan,100,1\n" * 3000
    others = b"".join(f"PR{i},EMP{2 + i % 2:02d},M{i % 12},{i},1\n".encode() for i in range(6000))
    _write(pay, copies + others)
    summary = run_payroll_report(spark, emp, pay, out, rows_per_output_file=500)
    assert summary.records_emitted == 9000
    parts = sorted(glob.glob(os.path.join(out, "part-*")))
    holding = [p for p in parts if "EMP01\t" in open(p).read()]
    assert len(holding) > 1                                  # the copies were split
    text = _read_output(out).splitlines()
    assert len(text) == 9000
    assert [t.split("\t")[0] for t in text] == sorted(t.split("\t")[0] for t in text)
    assert text.count("EMP01\tNour Hassan,Engineering,Jan,101,101") == 3000


def test_job_without_aqe(spark, tmp_dir):
    emp, pay, out = (os.path.join(tmp_dir, n) for n in ("emp.csv", "pay.csv", "out"))
    _write(emp, EMPLOYEES)
    _write(pay, PAYROLL)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        run_payroll_report(spark, emp, pay, out)
        run_payroll_report(spark, emp, pay, out + "2", max_broadcast_bytes=0, rows_per_task=1)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert _read_output(out) == GOLDEN_TEXT
    assert _read_output(out + "2") == GOLDEN_TEXT


def test_symlinked_output_to_an_input_is_refused(spark, tmp_dir):
    emp_dir = os.path.join(tmp_dir, "emp")
    emp = os.path.join(emp_dir, "emp.csv")
    pay = os.path.join(tmp_dir, "pay.csv")
    _write(emp, EMPLOYEES)
    _write(pay, PAYROLL)
    link = os.path.join(tmp_dir, "looks_separate")
    os.symlink(emp_dir, link)
    with pytest.raises(ValueError):
        run_payroll_report(spark, emp_dir, pay, link)
    with pytest.raises(ValueError):
        check_paths(spark, "file://" + emp_dir, pay, link + "/sub")
    assert open(emp, "rb").read() == EMPLOYEES


def test_job_with_ansi_off(spark, tmp_dir):
    emp, pay, out = (os.path.join(tmp_dir, n) for n in ("emp.csv", "pay.csv", "out"))
    _write(emp, EMPLOYEES)
    _write(pay, PAYROLL + b"P9,EMP03,Mar,2147483647,2147483647\n")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        s1 = run_payroll_report(spark, emp, pay, out)
        text_widen = _read_output(out)
        s2 = run_payroll_report(spark, emp, pay, out + "w", overflow="wrap", max_broadcast_bytes=0, rows_per_task=1)
        text_wrap = _read_output(out + "w")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert s1.records_emitted == s2.records_emitted == 6
    assert "EMP03\tSara Khaled,Finance,Mar,4294967294,4294967294\n" in text_widen
    assert "EMP03\tSara Khaled,Finance,Mar,-2,9700\n" in text_wrap
