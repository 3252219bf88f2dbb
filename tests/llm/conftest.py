from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from conftest_llm import ODD  # noqa: E402

from airlag.llm.common import let_workers_import  # noqa: E402


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    let_workers_import(spark)


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents with extra columns whose names the operators use too."""
    rows = [(i, t, "en", 0.5, 1, f"r{n}") for n, (i, t) in enumerate(ODD)]
    schema = "doc_id long, text string, lang string, score double, part int, removed string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
