"""The entry module with and without the optional part."""

import os
import shutil
import subprocess
import sys

from tests.conftest import ROOT

COUNT = ("import __spark_entry__ as e; from tickforge.plans import registry; "
         "q, o = set(e.queries()), set(e.oracle_sql()); assert q >= set(registry.QUERIES) and o >= set(registry.ORACLES); "
         "print(len(q), len(registry.QUERIES))")


def _count(folder):
    out = subprocess.run([sys.executable, "-c", COUNT], cwd=folder, capture_output=True, text=True, check=True,
                         env={**os.environ, "PYTHONPATH": "", "PYTHONDONTWRITEBYTECODE": "1"})
    return tuple(map(int, out.stdout.split()[-2:]))


def _copy(folder, *left_out):
    keep = shutil.ignore_patterns("__pycache__")
    shutil.copytree(os.path.join(ROOT, "tickforge"), folder / "tickforge", ignore=keep)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(os.path.join(ROOT, name)) and name not in left_out:
            shutil.copy(os.path.join(ROOT, name), folder)
    if "llm" in left_out and (folder / "tickforge" / "llm").exists():
        shutil.rmtree(folder / "tickforge" / "llm")
    return folder


def test_core_queries_without_the_optional_package(tmp_path):
    """Without ``llm``, whether or not the pipeline file is there, the time-series queries are all registered."""
    for i, gone in enumerate((("llm",), ("llm", "corpus_pipeline.py"))):
        queries, core = _count(_copy(tmp_path / str(i), *gone))
        assert queries == core >= 58


def test_pipeline_file_alone_may_be_missing(tmp_path):
    queries, core = _count(_copy(tmp_path / "all", "corpus_pipeline.py"))
    assert queries >= core
