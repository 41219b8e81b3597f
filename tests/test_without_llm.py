"""The library imports and registers its queries where the document operators are left out."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

from tests.conftest import ROOT


def test_entry_without_document_operators(tmp_path):
    shutil.copytree(f"{ROOT}/hearthline", tmp_path / "hearthline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    for beside in (False, True):  # without and with the pipeline's file
        if beside:
            (tmp_path / "corpus_pipeline.py").write_text("raise ImportError('not here')\n")
        code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and 'pipeline' not in q and not any(n.startswith('op') for n in [*q, *e.oracle_sql()])"
        run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
        assert run.returncode == 0, run.stderr
