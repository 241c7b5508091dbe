"""The entry module with and without the optional training-data package."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
COUNT = "import __spark_entry__ as e; q = e.queries(); print('lead_rows' in q, any(k.startswith('op') and k[2].isdigit() for k in q), 'pipeline' in q)"


def registered(root):
    done = subprocess.run([sys.executable, "-c", COUNT], cwd=root, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": ":".join(p for p in sys.path if p and str(ROOT) not in p)})
    assert done.returncode == 0, done.stderr
    return done.stdout.split()


@pytest.mark.parametrize("drop_pipeline", [False, True])
def test_imports_without_the_training_data_package(tmp_path, drop_pipeline):
    ignored = [".git", "__pycache__", "llm"] + ["corpus_pipeline.py"] * drop_pipeline
    shutil.copytree(ROOT, tmp_path / "copy", ignore=shutil.ignore_patterns(*ignored))
    assert registered(tmp_path / "copy") == ["True", "False", "False"]


def test_broken_module_is_not_swallowed(tmp_path):
    shutil.copytree(ROOT, tmp_path / "copy", ignore=shutil.ignore_patterns(".git", "__pycache__", "llm"))
    (tmp_path / "copy/leadloom/llm").mkdir()
    (tmp_path / "copy/leadloom/llm/__init__.py").write_text("")
    (tmp_path / "copy/leadloom/llm/queries.py").write_text("import no_such_module\n")
    with pytest.raises(AssertionError, match="no_such_module"):
        registered(tmp_path / "copy")
