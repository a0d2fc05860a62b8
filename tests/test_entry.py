"""The driver contract holds in a copy of the tree without the optional subpackage."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

from textgraph.queries import registered

ROOT = Path(__file__).resolve().parent.parent


def test_rest_lives_without_the_subpackage(tmp_path):
    for folder in ("textgraph", "tests"):
        shutil.copytree(ROOT / folder, tmp_path / folder, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for script in ROOT.glob("*.py"):
        if script.name != "corpus_pipeline.py":
            shutil.copy(script, tmp_path / script.name)
    alone = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    told = "import __spark_entry__ as e; print(*sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"
    found = subprocess.run([sys.executable, "-c", told], cwd=tmp_path, env=alone, capture_output=True, text=True)
    assert found.returncode == 0, found.stderr
    assert found.stdout.split() == sorted(registered())
    listed = subprocess.run(
        [sys.executable, "-m", "pytest", "--collect-only", "-q", "-p", "no:cacheprovider", "tests"],
        cwd=tmp_path,
        env=alone,
        capture_output=True,
        text=True,
    )
    assert listed.returncode == 0, listed.stdout
