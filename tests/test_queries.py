"""Every registered query against its SQL, and the shape of its plan."""

import sys

import pytest
from compare import compare
from conftest import SF

from __spark_entry__ import entry, queries
from sylvatab.queries.registry import QUERIES

# Operators that no plan may hold: quadratic joins and Python per row.
REFUSED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


def test_every_query_has_sql():
    assert all(sql for _, sql in QUERIES.values())


@pytest.mark.parametrize("missing", ["zstandard", "sylvatab.llm", "public_tokenizers"])
def test_library_works_without_the_text_operators(missing, monkeypatch):
    for module in [m for m in sys.modules if m.startswith("sylvatab.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, module)
    monkeypatch.setitem(sys.modules, missing, None)
    with pytest.warns(UserWarning, match="left out"):
        assert set(queries()) >= set(QUERIES)


def test_flagship(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    seen = {}

    def run(s, sf_dir):
        seen["df"] = QUERIES[name][0](s, sf_dir)
        return seen["df"]

    ok, note = compare(spark, sql, run, QUERIES[name][1], SF)
    assert ok, note
    plan = seen["df"]._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in REFUSED if x in plan]
