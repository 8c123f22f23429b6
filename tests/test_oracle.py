"""Every registered query against its SQL check on the smallest data."""

import check
import pytest

from quern.plans import ORACLES, QUERIES

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.duck(DIRECTORY)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    frame = QUERIES[name](spark, DIRECTORY)
    if name in ORACLES:
        result = check.compare(frame, con, ORACLES[name])
        assert result.startswith(("ok", "EMPTY")), result
    else:
        assert frame.count() > 0


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() == 6
    assert set(contract.oracle_sql()) <= set(contract.queries())
