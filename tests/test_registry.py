import pytest

from findery.plans import registry
from tests.compare import same

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_agrees_with_sql(spark, name):
    same(registry.queries()[name](spark, SMALL), registry.oracle_sql()[name], SMALL)


def test_entry_imports_without_the_corpus_operators(monkeypatch):
    import importlib
    import sys

    class Missing:
        def find_spec(self, name, path=None, target=None):
            if name in ("corpus_pipeline", "findery.llm"):
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    for name in [n for n in sys.modules if n in ("corpus_pipeline", "__spark_entry__") or n.startswith("findery.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(sys, "meta_path", [Missing(), *sys.meta_path])
    entry = importlib.import_module("__spark_entry__")
    assert set(entry.queries()) == set(registry.queries())
    monkeypatch.delitem(sys.modules, "__spark_entry__")


def test_entry(spark):
    import __spark_entry__

    rows = __spark_entry__.entry(spark)
    assert rows.columns == ["question_id", "chunk_id", "rrf_score", "retrievers", "rrf_rank"]
    assert rows.count() > 0
