"""The training-data subpackage can be removed: nothing outside it imports it."""

import pathlib
import shutil
import subprocess
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
CODE = "import __spark_entry__ as e; q = e.queries(); assert q and 'pipeline' not in q and not any(n.startswith('op') for n in q); assert set(e.oracle_sql()) <= set(q)"


@pytest.mark.parametrize("leftover", [False, True])
def test_the_rest_works_without_the_training_data_package(tmp_path, leftover):
    """Also where the package's folder stays behind, empty. The other tests are collected and the quick ones run."""
    repo = tmp_path / "repo"
    shutil.copytree(ROOT, repo, ignore=shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse"))
    shutil.rmtree(repo / "docquarry/llm")
    shutil.rmtree(repo / "tests/llm")
    (repo / "corpus_pipeline.py").unlink()
    if leftover:
        (repo / "docquarry/llm/__pycache__").mkdir(parents=True)
    subprocess.run([sys.executable, "-c", CODE], cwd=repo, check=True, timeout=120)
    subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "-x", "-k", "names_are_unique or schedule"], cwd=repo, check=True, timeout=300)
