"""The library without its corpus part: entry file and registry still work."""

import os
import shutil
import subprocess
import sys
import tempfile

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("gone", [["tidemark/llm"], ["tidemark/llm", "corpus_pipeline.py"],
                                  ["corpus_pipeline.py"]])
def test_entry_imports_without_the_corpus_part(gone):
    copy = tempfile.mkdtemp(prefix="tidemark-copy-")
    left_out = {os.path.join(REPO, g) for g in gone}

    def skip(folder, names):
        return [n for n in names if n in (".git", "tests", "__pycache__", ".hypothesis", ".pytest_cache")
                or os.path.join(folder, n) in left_out]

    shutil.copytree(REPO, copy, ignore=skip, dirs_exist_ok=True)
    code = ("import __spark_entry__ as e; q = e.queries(); "
            "assert set(e.oracle_sql()) <= set(q); "
            "print(len(q), sum(n.startswith('op') or n == 'pipeline' for n in q))")
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True,
                         env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONPATH": copy})
    assert out.returncode == 0, out.stderr
    total, corpus = map(int, out.stdout.split())
    assert corpus == 0 and total >= 46


def test_nothing_else_imports_the_corpus_part():
    for folder, _, names in os.walk(os.path.join(REPO, "tidemark")):
        if os.path.basename(folder) == "llm":
            continue
        for name in names:
            if name.endswith(".py"):
                with open(os.path.join(folder, name), encoding="utf-8") as f:
                    text = f.read()
                assert ".llm" not in text and "import llm" not in text, name
