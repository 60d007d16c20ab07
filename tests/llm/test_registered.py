"""Registered queries: names, and SQL oracles over whole tables."""

import pytest

import __spark_entry__ as entry
from harness import compare
from riskfeat.llm import queries


def test_every_operator_is_registered_once():
    names = list(queries.QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(names) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    res = compare(queries.QUERIES[name](spark, sf_dir), queries.ORACLES[name], duck)
    assert res["ok"] and res["spark_rows"] > 0, res
