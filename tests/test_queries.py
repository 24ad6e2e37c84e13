from pathlib import Path

import pytest

from checks.compare import connect, differences
from checks.oracles import ORACLES
from checks.queries import QUERIES, UNCHECKED

SMALLEST = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    if not Path(SMALLEST).exists():
        pytest.skip("the given tables are not here")
    return connect(SMALLEST)


def test_every_query_has_its_check():
    assert set(QUERIES) - UNCHECKED == set(ORACLES)


@pytest.mark.parametrize("name", sorted(UNCHECKED))
def test_unchecked_query_runs(spark, duck, name):
    assert not QUERIES[name](spark, SMALLEST).isEmpty()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_check(spark, duck, name):
    assert differences(duck, name, QUERIES[name](spark, SMALLEST)) is None
