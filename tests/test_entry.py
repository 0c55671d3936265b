"""The entry module without the optional operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = ("import __spark_entry__ as e; q = e.queries(); "
        "print('KEYS', len(q), any(k.startswith('op') for k in q), 'pipeline' in q, set(e.oracle_sql()) <= set(q))")


def _keys(tmp, *without):
    for name in ("strata", "__spark_entry__.py", "corpus_pipeline.py"):
        src = os.path.join(ROOT, name)
        if os.path.isdir(src):
            shutil.copytree(src, os.path.join(tmp, name), ignore=lambda d, names: [
                n for n in names if n == "__pycache__" or os.path.relpath(os.path.join(d, n), ROOT) in without])
        elif os.path.exists(src) and name not in without:
            shutil.copy(src, tmp)
    return subprocess.run([sys.executable, "-B", "-c", CODE], cwd=tmp, capture_output=True, text=True, timeout=120)


def test_without_the_operators(tmp_path):
    p = _keys(str(tmp_path), "strata/llm", "corpus_pipeline.py")
    assert p.returncode == 0, p.stderr[-1500:]
    n, ops, pipeline, oracle = p.stdout.split("KEYS ")[1].split()
    assert int(n) > 70 and (ops, pipeline, oracle) == ("False", "False", "True")


def test_an_import_error_inside_the_operators_is_not_hidden(tmp_path):
    if not os.path.isdir(os.path.join(ROOT, "strata", "llm")):
        pytest.skip("operators not installed")
    _keys(str(tmp_path))
    with open(tmp_path / "strata" / "llm" / "queries.py", "a") as fh:
        fh.write("\nimport no_such_module\n")
    p = subprocess.run([sys.executable, "-B", "-c", CODE], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert p.returncode != 0 and "no_such_module" in p.stderr
