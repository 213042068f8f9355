"""Every registered query equals its DuckDB oracle at sf0.01 (the driver's gate, run locally)."""

import pytest

from mailframe.plans import ORACLE_SQL, QUERIES
from tests.conftest import SF_ORACLE
from tests.oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_ORACLE)
    if name not in ORACLE_SQL:
        assert df.count() >= 0
        return
    ok, msg = compare(df, con, ORACLE_SQL[name])
    assert ok, msg


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert set(QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
    assert set(ORACLE_SQL) <= set(e.oracle_sql())


SPARK_TO_DUCK = {"LongType": "BIGINT", "IntegerType": "INTEGER", "StringType": "VARCHAR", "BooleanType": "BOOLEAN",
                 "DoubleType": "DOUBLE", "TimestampNTZType": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(set(ORACLE_SQL) - {"store_after_stream"}))
def test_column_types_match_oracle(spark, name):
    from tests.conftest import SF_SMALL

    df = QUERIES[name](spark, SF_SMALL)
    spark_types = {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__, str(f.dataType)) for f in df.schema.fields}
    duck_types = {r[0]: r[1] for r in duck(SF_SMALL).execute("DESCRIBE " + ORACLE_SQL[name]).fetchall()}
    assert spark_types == duck_types
