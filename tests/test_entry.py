"""The entry works without the corpus operators."""

import os
import shutil
import subprocess
import sys

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAY = "import __spark_entry__ as e; q = e.queries(); print(len(q), sorted(n for n in q if n.startswith('op') and n[2].isdigit() or n == 'pipeline'), set(e.oracle_sql()) <= set(q))"


@pytest.mark.parametrize("gone", [(), ("matchloom/llm",), ("matchloom/llm", "corpus_pipeline.py")])
def test_without_the_corpus_part(tmp_path, gone):
    if gone and not os.path.isdir(f"{HERE}/matchloom/llm"):
        pytest.skip("it is gone already")
    for name in ("__spark_entry__.py", "corpus_pipeline.py", "matchloom"):
        if os.path.isdir(f"{HERE}/{name}"):
            shutil.copytree(f"{HERE}/{name}", tmp_path / name, ignore=shutil.ignore_patterns("__pycache__", "llm" if "matchloom/llm" in gone else "-"))
        elif os.path.exists(f"{HERE}/{name}") and name not in gone:
            shutil.copy(f"{HERE}/{name}", tmp_path / name)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-c", SAY], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr
    number, names = said.stdout.split(maxsplit=1)
    assert int(number) > 100 and names.strip().endswith("True") and (names.startswith("[]") or "matchloom/llm" not in gone)
