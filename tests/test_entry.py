"""The driver's entry point, with the training-data package and without it."""

from __future__ import annotations

import shutil
import subprocess
import sys

import pytest
from conftest import ROOT

COUNT = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); print(*q); assert set(s) <= set(q)"


def names(folder) -> set[str]:
    run = subprocess.run(
        [sys.executable, "-c", COUNT], cwd=folder, capture_output=True, text=True, timeout=120,
        env={"PATH": "/usr/bin:/bin"},
    )
    assert run.returncode == 0, run.stderr
    return set(run.stdout.split())


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_the_training_data_package(tmp_path, pipeline):
    for name in ("__spark_entry__.py", *["corpus_pipeline.py"] * pipeline):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    hidden = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(ROOT / "reelstar", tmp_path / "reelstar", ignore=hidden)
    found = names(tmp_path)
    assert "channel_comparison" in found
    assert "pipeline" not in found and not any(n.startswith("op") and "_" in n and n[2].isdigit() for n in found)


def test_entry_as_it_is():
    assert "channel_comparison" in names(ROOT)
