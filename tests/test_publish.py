"""The output is replaced whole, after it has been checked, or not at all; stores are told apart."""

import os

import pytest
from test_job import EMPLOYEES, GOLDEN_TEXT, PAYROLL, _folders, _read_output, _write

from salaria import run_payroll_report
from salaria.sources import publish
from salaria.sources.paths import check_paths, overlap, store_names


def _inputs(tmp_dir):
    emp, pay = os.path.join(tmp_dir, "emp.csv"), os.path.join(tmp_dir, "pay.csv")
    _write(emp, EMPLOYEES)
    _write(pay, PAYROLL)
    return emp, pay


def _tree(folder):
    return {os.path.relpath(os.path.join(d, f), folder): open(os.path.join(d, f), "rb").read() for d, _, fs in os.walk(folder) for f in fs}


def test_a_failed_run_leaves_the_old_output_untouched(spark, tmp_dir, monkeypatch):
    from salaria.operators import report

    emp, pay = _inputs(tmp_dir)
    out = os.path.join(tmp_dir, "out")
    run_payroll_report(spark, emp, pay, out)
    before = _tree(tmp_dir)
    whole = report.report_lines
    monkeypatch.setattr(report, "report_lines", lambda r: whole(r).filter("value not like 'EMP04%'"))
    with pytest.raises(RuntimeError, match="4 report lines were written for 5"):
        run_payroll_report(spark, emp, pay, out)
    assert _tree(tmp_dir) == before
    with pytest.raises(RuntimeError):
        run_payroll_report(spark, emp, pay, os.path.join(tmp_dir, "fresh"))
    assert _tree(tmp_dir) == before and not os.path.exists(os.path.join(tmp_dir, "fresh"))


def test_a_failed_swap_puts_the_old_output_back(spark, tmp_dir, monkeypatch):
    emp, pay = _inputs(tmp_dir)
    out = os.path.join(tmp_dir, "out")
    _write(os.path.join(out, "part-0"), b"old\n")
    before, move = _tree(tmp_dir), publish._move

    def fails(fs, source, to):
        if ".next-" in source.getName():
            raise OSError("store is away")
        move(fs, source, to)

    monkeypatch.setattr(publish, "_move", fails)
    with pytest.raises(OSError, match="store is away"):
        run_payroll_report(spark, emp, pay, out)
    assert _tree(tmp_dir) == before


def test_a_driver_lost_within_the_swap_loses_nothing(spark, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    _write(os.path.join(tmp_dir, "_out.old-1", "part-0"), b"old\n")
    _write(os.path.join(tmp_dir, "_out2.old-1", "part-0"), b"other\n")
    publish.recover(spark, out)
    assert _tree(out) == {"part-0": b"old\n"} and sorted(os.listdir(tmp_dir)) == ["_out2.old-1", "out"]
    publish.recover(spark, out)  # nothing to do
    with publish.publishing(spark, out) as folder:
        _write(os.path.join(folder.removeprefix("file:"), "part-0"), b"new\n")
        assert _tree(out) == {"part-0": b"old\n"}
    assert _tree(out) == {"part-0": b"new\n"} and sorted(os.listdir(tmp_dir)) == ["_out2.old-1", "out"]


def test_output_behind_a_link_and_below_missing_folders(spark, tmp_dir):
    emp, pay = _inputs(tmp_dir)
    _write(os.path.join(tmp_dir, "real", "part-0"), b"old\n")
    os.symlink(os.path.join(tmp_dir, "real"), os.path.join(tmp_dir, "lnk"))
    run_payroll_report(spark, emp, pay, os.path.join(tmp_dir, "lnk"))
    assert os.path.islink(os.path.join(tmp_dir, "lnk")) and _read_output(os.path.join(tmp_dir, "real")) == GOLDEN_TEXT
    run_payroll_report(spark, emp, pay, os.path.join(tmp_dir, "a", "b", "out"))
    assert _read_output(os.path.join(tmp_dir, "a", "b", "out")) == GOLDEN_TEXT and os.listdir(os.path.join(tmp_dir, "a", "b")) == ["out"]


@pytest.fixture
def two_stores(spark, tmp_dir):
    """Mount file systems ``one`` and ``two``: stores of their own that hold the same paths."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    name = os.path.basename(tmp_dir).replace("_", "-").lower()
    names = [f"{name}-one", f"{name}-two"]
    for store in names:
        os.makedirs(os.path.join(tmp_dir, store))
        conf.set(f"fs.viewfs.mounttable.{store}.link./data", "file://" + os.path.join(tmp_dir, store))
    return [f"viewfs://{n}" for n in names], [os.path.join(tmp_dir, n) for n in names]


def test_one_path_in_two_stores_is_two_places(spark, tmp_dir, two_stores):
    (one, two), (one_dir, two_dir) = two_stores
    _write(os.path.join(one_dir, "emp", "part-0"), EMPLOYEES)
    _write(os.path.join(one_dir, "pay", "part-0"), PAYROLL)
    run_payroll_report(spark, f"{one}/data/emp", f"{one}/data/pay", f"{two}/data/pay")
    assert _read_output(os.path.join(two_dir, "pay")) == GOLDEN_TEXT
    assert open(os.path.join(one_dir, "pay", "part-0"), "rb").read() == PAYROLL
    check_paths(spark, f"{one}/data/emp", f"{two}/data/pay", f"{two}/data/emp")


def test_a_whole_store_as_input_overlaps_only_what_it_holds(spark, tmp_dir, two_stores):
    (one, two), (one_dir, two_dir) = two_stores
    emp, pay = _folders(tmp_dir, "emp", f"{os.path.basename(one_dir)}/pay")
    check_paths(spark, emp, f"{one}/", os.path.join(tmp_dir, "out"))
    check_paths(spark, emp, f"{one}/", f"{two}/data/pay")
    for out in (f"{one}/data/out", os.path.join(one_dir, "out"), one_dir, f"{one}/"):
        with pytest.raises(ValueError):
            check_paths(spark, emp, f"{one}/", out)


def test_root_and_overlapping_outputs_are_refused(spark, tmp_dir):
    emp, pay = _folders(tmp_dir, "emp", "pay")
    for outs in (["/"], [f"{tmp_dir}/o", f"{tmp_dir}/o/x"], [f"{tmp_dir}/o", f"{tmp_dir}/o"]):
        with pytest.raises(ValueError):
            check_paths(spark, emp, pay, *outs)
    check_paths(spark, emp, pay, f"{tmp_dir}/o", f"{tmp_dir}/p")


def test_names_of_stores():
    conf = {"dfs.ha.namenodes.prod": "a, b", "dfs.namenode.rpc-address.prod.a": "NN1.example:8020", "dfs.namenode.rpc-address.prod.b": "nn2.example:8020"}
    same = [(("s3a", "raw"), ("s3", "raw")), (("hdfs", "nn1:8020"), ("webhdfs", "NN1:9870")), ((None, None), ("file", "")),
            (("hdfs", "prod"), ("hdfs", "nn2.example:8020")), (("abfs", "c@acc"), ("abfss", "c@acc"))]
    for a, b in same:
        assert store_names(*a, conf.get) & store_names(*b, conf.get), (a, b)
    for a, b in [(("s3a", "raw"), ("s3a", "curated")), (("hdfs", "nn1:8020"), ("hdfs", "nn3:8020")), (("s3a", "x"), ("gs", "x")),
                 (("hdfs", "prod"), ("hdfs", "test")), (("file", None), ("hdfs", "nn1")), (("abfs", "a@acc"), ("abfs", "b@acc"))]:
        assert not store_names(*a, conf.get) & store_names(*b, conf.get), (a, b)


def test_overlap_needs_store_and_path():
    raw, curated = store_names("s3a", "raw"), store_names("s3a", "curated")
    assert overlap({(raw, ("pay",))}, {(raw, ("pay", "2024"))}) and overlap({(raw, ())}, {(raw, ("x",))})
    assert not overlap({(raw, ("pay",))}, {(curated, ("pay",))}) and not overlap({(raw, ())}, {(curated, ("x",))})
    assert not overlap({(raw, ("pay",))}, {(raw, ("pay2",))})
