"""The payroll part stands alone: entry module and tests work without the optional folders."""

import os
import shutil
import subprocess
import sys

from salaria.catalog import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _copy(to, pipeline):
    for name in ("salaria", "tests", "tools"):
        shutil.copytree(f"{ROOT}/{name}", f"{to}/{name}", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "pyproject.toml", *(["corpus_pipeline.py"] if pipeline else [])):
        if os.path.exists(f"{ROOT}/{name}"):
            shutil.copy(f"{ROOT}/{name}", to)


def _run(folder, *args):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, *args], cwd=folder, env=env, capture_output=True, text=True, timeout=300)


def test_entry_without_the_optional_folders(tmp_path):
    for pipeline in (True, False):  # the pipeline's file may be left behind
        folder = tmp_path / f"copy{pipeline}"
        folder.mkdir()
        _copy(folder, pipeline)
        got = _run(folder, "-c", "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))")
        assert got.returncode == 0, got.stderr
        queries, oracles = (line.split() for line in got.stdout.splitlines())
        assert queries == sorted(QUERIES) and set(oracles) <= set(queries)
        collected = _run(folder, "-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider")
        assert collected.returncode == 0, collected.stdout + collected.stderr


def test_oracle_tests_are_collected_without_duckdb():
    got = _run(ROOT, "-c", "import sys; sys.modules['duckdb'] = None; import pytest; "
               "sys.exit(pytest.main(['tests/test_oracle.py', '--collect-only', '-q', '-p', 'no:cacheprovider']))")
    assert got.returncode == 0, got.stdout + got.stderr
