"""The driver contract holds with and without the optional text subpackage."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as entry

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_imports_without_the_text_subpackage(tmp_dir):
    copy = os.path.join(tmp_dir, "repo")
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "tests"))
    code = ("import __spark_entry__ as e, sys; q = e.queries(); "
            "print(len(q), any(n.startswith('op') or n == 'pipeline' for n in q), set(e.oracle_sql()) <= set(q))")
    out = subprocess.run([sys.executable, "-B", "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    count, text_queries, covered = out.stdout.split()
    assert int(count) > 40 and text_queries == "False" and covered == "True"


def test_a_faulty_import_within_the_subpackage_raises(tmp_dir):
    copy = os.path.join(tmp_dir, "repo")
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "tests"))
    os.makedirs(os.path.join(copy, "ratingsmith", "llm"))
    for name, text in (("__init__.py", ""), ("queries.py", "import no_such_module_anywhere\n")):
        with open(os.path.join(copy, "ratingsmith", "llm", name), "w") as f:
            f.write(text)
    out = subprocess.run([sys.executable, "-B", "-c", "import __spark_entry__ as e; e.queries()"], cwd=copy,
                         capture_output=True, text=True, timeout=120)
    assert out.returncode != 0 and "no_such_module_anywhere" in out.stderr
