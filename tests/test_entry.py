import importlib
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry


def test_contract(spark):
    df = entry.entry(spark)
    assert df.columns == ["target_id", "info_id"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(f"p{i}_found" in entry.queries() for i in (1, 2, 3, 5))


def test_core_works_without_the_corpus_package(monkeypatch):
    monkeypatch.setitem(sys.modules, "minespark.llm", None)
    again = importlib.reload(entry)
    try:
        assert "p1_found" in again.queries() and not any(q.startswith(("p4", "p6", "p7", "p8")) for q in again.queries())
    finally:
        monkeypatch.undo()
        importlib.reload(entry)


@pytest.mark.skipif(not (Path(entry.__file__).parent / "minespark/llm/registry.py").exists(), reason="no corpus package")
def test_a_library_that_the_corpus_package_lacks_is_an_error(monkeypatch):
    monkeypatch.setitem(sys.modules, "tiktoken", None)
    for name in [m for m in sys.modules if m.startswith("minespark.llm")]:
        monkeypatch.delitem(sys.modules, name)
    try:
        with pytest.raises(ImportError, match="tiktoken"):
            importlib.reload(entry)
    finally:
        monkeypatch.undo()
        importlib.reload(entry)
