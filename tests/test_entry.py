"""The entry works without the llm subpackage, with or without the pipeline's file."""

import json
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from brindle.plans.oracle import ORACLE
from brindle.plans.queries import QUERIES

ROOT = Path(__file__).resolve().parents[1]
ASK = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


@pytest.mark.parametrize("gone", [("brindle/llm", "tests/llm"), ("brindle/llm", "tests/llm", "corpus_pipeline.py")])
def test_without_the_llm_folders(tmp_path, gone):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", *[Path(g).name for g in gone if g.endswith(".py")], "llm"))
    assert not any((copy / g).exists() for g in gone)
    run = subprocess.run([sys.executable, "-c", ASK], cwd=copy, capture_output=True, text=True, check=True)
    assert json.loads(run.stdout) == [sorted(QUERIES), sorted(ORACLE)]
    collected = subprocess.run(
        [sys.executable, "-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider"],
        cwd=copy, capture_output=True, text=True,
    )
    assert collected.returncode == 0, collected.stdout
