"""Every registered query against its SQL text, and the driver contract."""

import pytest

import __spark_entry__ as contract
from catalog import ORACLES, QUERIES
from compare import differences, oracle_connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF)


def test_contract():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) == set(ORACLES)


def test_planted_errors_occur(connection):
    """The checks of the error paths are not empty."""
    for name, where in (("behaviour_words", "word = 'word_error'"), ("scored_records", "score = -1")):
        rows = connection.execute(f"SELECT count(*) FROM ({ORACLES[name]}) WHERE {where}").fetchall()
        assert rows[0][0] > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, connection, name):
    assert differences(QUERIES[name](spark, SF), connection, ORACLES[name]) == ""


def test_entry(spark):
    result = contract.entry(spark)
    assert result.count() > 0 and result.columns[-2:] == ["word", "score"]
