"""The library without the training-data subpackage: entry point and queries still work."""

import os
import shutil
import subprocess
import sys

from conftest import ROOT


def test_entry_without_the_subpackage(tmp_path):
    shutil.copytree(os.path.join(ROOT, "actiflow"), tmp_path / "actiflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = ("import __spark_entry__ as e; from actiflow.plans.catalog import QUERIES; "
            "assert set(e.queries()) == set(QUERIES) == set(e.oracle_sql())")
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True,
                   env={**os.environ, "PYTHONPATH": str(tmp_path)})
