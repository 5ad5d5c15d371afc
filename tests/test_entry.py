"""The driver contract where the corpus operators cannot be imported."""

import importlib
import sys

import pytest

import __spark_entry__ as entry
from trackwise.plans.registry import QUERIES


def test_core_queries_survive_a_missing_library(monkeypatch):
    for name in [n for n in sys.modules if n.startswith("trackwise.llm") or n in ("corpus_pipeline", "xxhash")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "xxhash", None)        # importing it raises ImportError
    if importlib.util.find_spec("trackwise.llm") is None:
        assert set(entry.queries()) == set(QUERIES)
    else:
        with pytest.warns(UserWarning, match="left out"):
            assert set(entry.queries()) == set(QUERIES)


def test_every_core_query_has_a_twin():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())
