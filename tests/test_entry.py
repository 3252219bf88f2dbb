"""The registered queries without the text operators."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest

from airlag.session import checkpoint_folder

ROOT = Path(__file__).resolve().parents[1]


def test_entry_without_the_text_operators(tmp_path):
    """In a copy without both of their folders the rest is registered."""
    left_out = shutil.ignore_patterns("llm", ".git", "__pycache__")
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=left_out)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"
    run = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True)
    queries, twins, pipeline = run.stdout.split()
    assert int(queries) >= 64 and int(twins) >= 64 and pipeline == "False"


@pytest.mark.parametrize("master, named", [("local[8]", False), ("local", False), ("yarn", True), ("local-cluster[3,2,1024]", True)])
def test_clusters_need_a_shared_folder(master, named):
    def session(**conf):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        conf = {"spark.sql.warehouse.dir": "/w/", **conf}
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, *d: conf.get(key, *d)))

    assert checkpoint_folder(session(**{"spark.checkpoint.dir": "s3://shared/x/"})) == "s3://shared/x"
    if named:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_folder(session())
    else:
        assert checkpoint_folder(session()) == "/w/_scratch"
