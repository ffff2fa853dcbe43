"""Every registered query against its DuckDB oracle at sf0.001."""

import pytest

import __spark_entry__ as E
from scriptorium.plans import registry
from tests.oracle_harness import compare, duck
from tests.conftest import SF_SMALL

registry.load_all()
QUERIES, ORACLE = registry.QUERIES, registry.ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle_or_is_rows_only():
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only == {"tokenize_bpe", "cpt_packed_bpe", "sft_examples_bpe", "sft_examples_dictionary_bpe"}
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE.get(name), SF_SMALL)
    assert r["rows"] >= 0
    if name in ORACLE:
        assert r["match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["seq_id", "n_tokens", "ids_md5", "labels_md5"]
    assert df.count() > 0
