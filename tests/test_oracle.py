"""Every registered query against its SQL on the smallest data set."""

import pytest
from compare import compare, connection

from polyspark.queries import QUERIES

SF = "/root/testdata/sf0.001"
# learn merges over the whole corpus in many rounds; tests/test_vocab.py checks them by brute force
SLOW = {"learn_bpe", "tokenize_bpe", "tokenizer_compare"}


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query(spark, con, name):
    assert compare(spark, con, SF, *QUERIES[name]) is None


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) < set(entry.queries())
