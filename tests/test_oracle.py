"""Every registered query against its SQL form; queries of the corpus subpackage have tests of their own."""

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, difference

CORPUS = {*entry.corpus.QUERIES, "pipeline"} if entry.corpus else set()
QUERIES = {k: v for k, v in entry.queries().items() if k not in CORPUS}
ORACLES = {k: v for k, v in entry.oracle_sql().items() if k not in CORPUS}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(name, spark, sf_dir, con):
    assert difference(con, QUERIES[name](spark, sf_dir), ORACLES[name]) is None


def test_entry_returns_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
