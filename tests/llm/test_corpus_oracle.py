import pytest

from oracle_compare import connect, difference
from tradeloom.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, sf, name):
    assert difference(name, QUERIES[name](spark, sf), connect(sf), ORACLE[name]) is None
