"""The library without its corpus operators."""

import json
import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]
SCRIPT = """
import json, sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as contract
print(json.dumps([sorted(contract.queries()), sorted(contract.oracle_sql()), contract.__file__]))
"""


def names(folder):
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(folder)], cwd=folder, check=True, capture_output=True, text=True, timeout=120
    )
    return json.loads(run.stdout)


def test_entry_imports_without_the_corpus_operators(tmp_path):
    ignored = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(REPO / "cleargrist", tmp_path / "cleargrist", ignore=ignored)
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    queries, sql, path = names(tmp_path)
    assert path.startswith(str(tmp_path))
    assert queries == sql and "curated_category_stats" in queries
    assert not any(q.startswith("op") or q == "pipeline" for q in queries)


def test_nothing_else_imports_the_corpus_operators():
    for path in (REPO / "cleargrist").rglob("*.py"):
        if "llm" not in path.parts:
            assert "cleargrist.llm" not in path.read_text(), path
