"""The entry with and without the optional folders."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"


@pytest.fixture
def copy(tmp_path):
    for name in ("quotarium", "__spark_entry__.py", "corpus_pipeline.py"):
        at = os.path.join(ROOT, name)
        if os.path.isdir(at):
            shutil.copytree(at, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__"))
        elif os.path.exists(at):
            shutil.copy(at, tmp_path / name)
    return tmp_path


def count(folder):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-c", COUNT], cwd=folder, env=env, capture_output=True, text=True)


def test_without_the_optional_folders(copy):
    whole = count(copy)
    assert whole.returncode == 0, whole.stderr
    shutil.rmtree(copy / "quotarium" / "llm", ignore_errors=True)
    (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    left = count(copy)
    assert left.returncode == 0, left.stderr
    from quotarium.plans import catalog

    assert left.stdout.split() == [str(len(catalog.QUERIES)), str(len(catalog.ORACLES))]


def test_a_fault_inside_is_raised(copy):
    folder = copy / "quotarium" / "llm"
    if not folder.exists():
        pytest.skip("the optional folder isn't here")
    (folder / "queries.py").write_text("import quotarium.llm.no_such_module\n")
    assert "no_such_module" in count(copy).stderr
    (folder / "queries.py").write_text("from quotarium.storage import no_such_name\n")
    assert "no_such_name" in count(copy).stderr
