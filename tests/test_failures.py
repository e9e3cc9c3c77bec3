"""A query whose rows can't tell that a search failed fails with it."""

import pytest

from findery.operators import neighbours, retrieval
from findery.plans import registry

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["hybrid_retrieve_indexed", "rrf_two_lists", "seed_documents", "notice_lookups", "ask"])
def test_a_failing_dense_search_is_no_result(spark, monkeypatch, name):
    def failing(*_):
        def run(batches):
            raise OSError("no vectors")

        return run

    monkeypatch.setattr(retrieval, "_dense", failing)
    monkeypatch.setattr(neighbours, "_scan", failing)
    with pytest.raises(Exception, match="no vectors"):
        registry.queries()[name](spark, SMALL).collect()
