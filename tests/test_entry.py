"""The entry module with the optional parts present and absent."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; q = e.queries(); print(len(q), len(e.oracle_sql()), sum(k.startswith('op') for k in q), 'pipeline' in q)"


@pytest.mark.parametrize("absent", [[], ["vigiframe/llm", "tests/llm", "corpus_pipeline.py"], ["vigiframe/llm", "tests/llm"], ["corpus_pipeline.py"]])
def test_entry_imports_without_the_optional_parts(tmp_path, absent):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: [n for n in names if n in (".git", "__pycache__", ".pytest_cache") or
                                                              os.path.relpath(os.path.join(folder, n), ROOT) in absent])
    env = {**os.environ, "PYTHONPATH": str(copy)}
    done = subprocess.run([sys.executable, "-c", SHOW], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    queries, oracles, operators, pipeline = done.stdout.split()
    has = os.path.exists(os.path.join(ROOT, "vigiframe", "llm")) and "vigiframe/llm" not in absent
    assert int(queries) >= 100 and int(oracles) >= 100
    assert (int(operators) > 0) == has and (pipeline == "True") == (has and os.path.exists(os.path.join(ROOT, "corpus_pipeline.py")) and "corpus_pipeline.py" not in absent)
