"""The entry file with and without the text operators' folders."""

import os
import shutil
import subprocess
import sys

from .conftest import ROOT


def test_entry_imports_without_the_text_operators(tmp_path):
    for name in ("fieldkit", "__spark_entry__.py"):
        source = os.path.join(ROOT, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    code = ("import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); "
            "assert 'trips' in q and set(s) <= set(q) and not any(k == 'pipeline' or k.startswith('op1_') for k in q)")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_library_does_not_import_the_text_operators():
    for folder, _, files in os.walk(os.path.join(ROOT, "fieldkit")):
        if os.path.basename(folder) == "llm":
            continue
        for f in files:
            if f.endswith(".py"):
                with open(os.path.join(folder, f)) as h:
                    assert "fieldkit.llm" not in h.read(), f
