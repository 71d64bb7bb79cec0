"""The entry keeps the library's queries when the training-data package is gone or broken."""

import shutil
import subprocess
import sys

from regionledger import registry

COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"


def copy(tmp_path, with_llm):
    root = tmp_path / "repo"
    shutil.copytree("regionledger", root / "regionledger", ignore=shutil.ignore_patterns("__pycache__", *([] if with_llm else ["llm"])))
    shutil.copy("__spark_entry__.py", root)
    if with_llm:
        shutil.copy("corpus_pipeline.py", root)
    return root


def count(root, *front):
    path = ":".join([*map(str, front), str(root)])
    out = subprocess.run([sys.executable, "-c", COUNT], cwd=root, env={"PYTHONPATH": path, "PATH": "/usr/bin:/bin"}, capture_output=True, text=True, check=True)
    return tuple(int(x) for x in out.stdout.split())


def test_empty_llm_folder_leaves_the_library(tmp_path):
    root = copy(tmp_path, with_llm=False)
    (root / "regionledger" / "llm" / "__pycache__").mkdir(parents=True)
    assert count(root) == (len(registry.queries()), len(registry.oracle_sql()))


def test_missing_dependency_leaves_the_library(tmp_path):
    root = copy(tmp_path, with_llm=True)
    fake = tmp_path / "fake"
    fake.mkdir()
    (fake / "zstandard.py").write_text("raise ImportError('not installed')\n")
    assert count(root, fake) == (len(registry.queries()), len(registry.oracle_sql()))
