"""The driver contract, with and without the optional corpus operators."""
import os
import shutil
import subprocess
import sys

import pytest

from conftest import ROOT

CHECK = """
import __spark_entry__ as entry
names = entry.queries()
print(len([n for n in names if not n.startswith("op") and n != "pipeline"]), "pipeline" in names,
      len([n for n in names if n[2:3].isdigit()]), set(entry.oracle_sql()) <= set(names))
"""


def contract(folder, code=CHECK, **env):
    found = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=600,
                           env={**os.environ, "PYTHONPATH": str(folder), **env})
    assert found.returncode == 0, found.stderr[-2000:]
    return found.stdout.split()


@pytest.fixture(scope="module")
def without_corpus(tmp_path_factory):
    """A copy of the library without the optional folders."""
    copy = tmp_path_factory.mktemp("run") / "repo"
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: [n for n in names if n in ("llm", ".git", "__pycache__")])
    assert not (copy / "trafficwatch" / "llm").exists() and (copy / "corpus_pipeline.py").exists()
    return copy


def test_entry_with_the_corpus_operators():
    if not os.path.isdir(os.path.join(ROOT, "trafficwatch", "llm")):
        pytest.skip("the corpus operators are not installed")
    from trafficwatch.catalog import QUERIES

    assert contract(ROOT) == [str(len(QUERIES)), "True", "13", "True"]


def test_entry_without_the_corpus_operators(without_corpus):
    from trafficwatch.catalog import QUERIES

    assert contract(without_corpus) == [str(len(QUERIES)), "False", "0", "True"]
    os.remove(without_corpus / "corpus_pipeline.py")
    assert contract(without_corpus)[1:3] == ["False", "0"]


def test_the_flagship_query_runs_without_them(without_corpus):
    code = """
import __spark_entry__ as entry
from trafficwatch.session import get_session
print(entry.entry(get_session("local[2]")).count())
"""
    assert int(contract(without_corpus, code)[-1]) > 0


def test_a_missing_library_leaves_the_rest(tmp_path):
    """The corpus operators need libraries of their own."""
    (tmp_path / "public_tokenizers.py").write_text("raise ImportError('not installed')\n")
    (tmp_path / "sitecustomize.py").write_text(f"import sys\nsys.path.insert(0, {str(tmp_path)!r})\n")
    code = f"import sys; sys.path.insert(0, {str(tmp_path)!r})\n" + CHECK
    found = contract(ROOT, code)
    assert found[1:] == ["False", "0", "True"]
