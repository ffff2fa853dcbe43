"""Registered queries of this package against their SQL at sf0.001."""

import pytest

import __spark_entry__ as E
from scriptorium.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_harness import compare, duck


def test_all_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    r = compare(spark, duck(SF_SMALL), name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert r["match"] and r["rows"], r
