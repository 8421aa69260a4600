"""The entry module with and without the optional corpus operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


def names(folder):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", NAMES], cwd=folder, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    queries, texts = done.stdout.splitlines()
    return set(queries.split()), set(texts.split())


def test_the_rest_works_without_the_corpus_operators(tmp_path):
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{ROOT}/tidemark", tmp_path / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    queries, texts = names(tmp_path)
    assert "feature_join" in queries and texts == queries
    assert not any(n.startswith("op") or n == "pipeline" for n in queries)


def test_nothing_else_imports_the_corpus_operators():
    for folder, _, files in os.walk(f"{ROOT}/tidemark"):
        if "llm" not in folder.split(os.sep):
            for name in files:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name), encoding="utf-8") as file:
                        assert "tidemark.llm" not in file.read(), name
