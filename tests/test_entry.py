"""The entry points with and without the training-data operators."""

import sys

import pytest

import __spark_entry__ as entry
from stratalens.catalog import load


class Blocked:
    """An import hook that refuses modules by name."""

    def __init__(self, *names):
        self.names = names

    def find_spec(self, name, path=None, target=None):
        if name in self.names:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)


@pytest.mark.parametrize("blocked", [("stratalens.llm", "corpus_pipeline"), ("corpus_pipeline",), ("sentencepiece",), ("tokenizers",)])
def test_catalog_is_there_without_the_rest(monkeypatch, blocked):
    for name in list(sys.modules):
        if name.partition(".")[0] in ("corpus_pipeline", *blocked) or name.startswith("stratalens.llm"):
            monkeypatch.delitem(sys.modules, name)
    if "stratalens" in sys.modules:
        monkeypatch.delattr(sys.modules["stratalens"], "llm", raising=False)
    monkeypatch.setattr(sys, "meta_path", [Blocked(*blocked), *sys.meta_path])
    names = entry.queries()
    assert set(load()) <= set(names) and "pipeline" not in names
    assert set(entry.oracle_sql()) <= set(names)


def test_no_name_is_used_twice():
    added, _ = entry._added()
    assert not set(load()) & set(added)
