"""The dealt queries equal their DuckDB SQL, and all can be called on a given folder."""

import pytest

from mailframe.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    ok, message = compare(QUERIES[name](spark, SF_SMALL), duck(SF_SMALL), ORACLE_SQL[name])
    assert ok, message


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_entry_registers_everything():
    import __spark_entry__ as e

    assert set(QUERIES) | {"pipeline"} <= set(e.queries())
    assert set(ORACLE_SQL) <= set(e.oracle_sql())
