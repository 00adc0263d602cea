"""The library without its optional parts."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_the_rest_works_without_the_corpus_operators(tmp_path):
    ignore = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", "tests")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=ignore)
    code = (
        "import __spark_entry__ as e; names = set(e.queries()); assert set(e.oracle_sql()) <= names and len(names) > 80; "
        "assert not [n for n in names if n.startswith('op') and n[2].isdigit()] and 'pipeline' not in names"
    )
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, env=os.environ | {"PYTHONPATH": ""})
    assert done.returncode == 0, done.stderr[-2000:]


def test_other_import_errors_are_not_swallowed(tmp_path):
    ignore = shutil.ignore_patterns(".git", "__pycache__", "tests")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=ignore)
    if not (tmp_path / "repo" / "relweave" / "llm").exists():
        return
    (tmp_path / "repo" / "relweave" / "llm" / "registry.py").write_text("import a_library_that_is_missing\n")
    done = subprocess.run([sys.executable, "-B", "-c", "import __spark_entry__"], cwd=tmp_path / "repo", capture_output=True, text=True)
    assert done.returncode and "a_library_that_is_missing" in done.stderr
