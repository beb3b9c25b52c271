"""The entry without the documents part: everything else is registered and runs."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]

RUN = """
import __spark_entry__ as entry
from landstrata.session import local_session
names = entry.queries()
assert len(names) >= 90 and set(entry.oracle_sql()) <= set(names), len(names)
assert "pipeline" not in names and not any(n.startswith("op") and n[2].isdigit() for n in names)
print("rows", names["partition_values"](local_session(2, 2), "/root/testdata/sf0.001").count())
"""


@pytest.mark.parametrize("pipeline", [True, False], ids=["pipeline stays", "pipeline deleted"])
def test_without_the_documents_part(tmp_path, pipeline):
    gone = shutil.ignore_patterns("llm", ".git", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, tmp_path / "copy", ignore=gone)
    done = subprocess.run([sys.executable, "-c", RUN], cwd=tmp_path / "copy", capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout.split("rows")[-1]) > 0


def test_other_import_errors_are_raised(monkeypatch):
    import __spark_entry__ as entry

    def missing(name):
        raise ModuleNotFoundError("No module named 'numpy'", name="numpy")

    monkeypatch.setattr(entry.importlib, "import_module", missing)
    with pytest.raises(ModuleNotFoundError):
        entry._optional("landstrata.llm.queries")
    monkeypatch.setattr(entry.importlib, "import_module", lambda name: (_ for _ in ()).throw(ModuleNotFoundError(name="landstrata.llm.pii")))
    assert entry._optional("corpus_pipeline") is None
